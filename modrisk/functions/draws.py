"""Repeatable pseudo-random draws derived from a key, not from row order."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def draw(seed: object, *keys: Column) -> Column:
    """A number in [0, 1) that depends only on the seed and the key values."""
    text = F.concat_ws(":", F.lit(str(seed)), *[k.cast("string") for k in keys])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)
