"""Connected components by alternating large-star and small-star steps, in DataFrame operations only.

Each round replaces the links by links to smaller nodes until every component is a star around its smallest node; the
number of rounds grows with the logarithm of the component size. Links stay distributed: the driver sees a count and a
checksum a round. A node with very many links is a skewed join key on one side only, which Spark splits; the minimum
of its neighbours is combined on the map side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from modrisk.llm.shared import work_folder, written


def _stars(links: DataFrame) -> DataFrame:
    """One large-star and one small-star step over links with u > v."""
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    lowest = large.groupBy("u").agg(F.min("v").alias("m"))
    small = large.join(lowest, "u").select(
        F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("l")
    )
    return small.select("l.u", "l.v").filter("u > v").distinct()


def _sum(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(links: DataFrame) -> DataFrame:
    """(node, component) for each node with a link to another; component is the smallest node reachable.

    ``links`` has the long columns u and v in any order and direction; loops and repeats are ignored, null ends too.
    No links give no rows.
    """
    folder = work_folder(links.sparkSession, "components")
    start = links.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    current = written(start, f"{folder}/0")
    state, step = _sum(current), 0
    while state[0]:
        step += 1
        following = written(_stars(current), f"{folder}/{step}")
        new = _sum(following)
        current, same = following, new == state
        state = new
        if same:
            break
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
