"""What the operators share: the work folder, written tables and word rules."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from modrisk.session import checkpoint_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
# A word is a run of other characters than these (Java pattern).
WORD = r"[^\x20\x09-\x0D]+"


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder that the driver and all executors see, below ``spark.checkpoint.dir``."""
    base = spark.conf.get("spark.checkpoint.dir", None) or checkpoint_dir(spark)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


_FREE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Jobs in here give their shuffle files back when they end; for results that are read from where they were written."""
    before = spark.conf.get(_FREE, None)
    if before is not None:  # since Spark 4.1
        spark.conf.set(_FREE, "true")
    try:
        yield
    finally:
        if before is not None:
            spark.conf.set(_FREE, before)


def written(frame: DataFrame, path: str, partition_by: list[str] | None = None, codec: str = "snappy") -> DataFrame:
    """Write a table and read it back: cuts the lineage, survives lost executors.

    The schema is given on reading, so an empty table comes back empty.
    """
    with freed_shuffles(frame.sparkSession):
        frame.write.option("compression", codec).parquet(path, partitionBy=partition_by)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def numbered(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """The rows with columns named c0, c1, ... so that no column clashes with inner names, and the new name of each old one."""
    return docs.toDF(*[f"c{i}" for i in range(len(docs.columns))]), {name: f"c{i}" for i, name in enumerate(docs.columns)}


def renamed(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """Numbered columns of ``rows`` under the names that ``docs`` has."""
    return rows.select(*[F.col(f"c{i}").alias(name) for i, name in enumerate(docs.columns)])


def whole_text(column: str | Column) -> Column:
    """The text as a string; null counts as empty."""
    c = F.col(column) if isinstance(column, str) else column
    return F.coalesce(c.cast("string"), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased and nothing else.

    ``lower`` is the fast way for pure ASCII; other letters must stay, so the rest is translated.
    """
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def byte_length(text: Column) -> Column:
    return F.octet_length(text)


def is_integral(frame: DataFrame, name: str) -> bool:
    return isinstance(frame.schema[name].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))
