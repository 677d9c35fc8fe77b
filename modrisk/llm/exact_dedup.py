"""Exact dedup by distributed most-significant-byte radix partitioning.

Each round takes the next block of bytes of every document that is still open and splits its group by that block. A group
of one document, or one whose documents have ended, is final; the rest goes on with the next, longer block. Two texts
are equal when they took the same way to the end; no digest decides.

Rounds: block widths grow by ``growth``, so a text of n bytes needs about log(n / width, growth) rounds. In each round
the groups are counted with a map-side combine (one row per group and task is shuffled, however large the group), then
every row is joined with its group; a large group is a skewed join key on the row side only, which Spark splits.

Defined results: a null text counts as empty and all empty texts are one group. A null id ranks below all others. Rows
that repeat id and text are copies like any other: each is returned, each counts in ``group_size``, exactly one row of a
group is kept. An empty table gives an empty result. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from modrisk.llm.shared import ascii_lower, numbered, renamed, whole_text, work_folder, written

WIDTH = 32  # bytes of the first block
GROWTH = 8  # each block is so many times longer than the one before


def normalised(text):
    return ascii_lower(whole_text(text))


def _bytes(text):
    return text.cast("binary")


def _first_block(width: int):
    """The first bytes straight from the text, so that counting groups never normalises whole texts.

    So many characters have at least so many bytes, and lower-casing A-Z keeps their number.
    """
    return F.substring(_bytes(ascii_lower(F.substring("text", 1, width))), 1, width)


def exact_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, growth: int = GROWTH
) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256 (of the normalised text)."""
    spark = docs.sparkSession
    folder = work_folder(spark, "radix")
    rows = docs.select(
        F.col(id_col).alias("id"), F.monotonically_increasing_id().alias("row"), whole_text(text_col).alias("text")
    )
    keys = rows.select(
        "id", "row", F.lit(0).cast("long").alias("gid"), _first_block(width).alias("head"),
        (F.octet_length("text") > width).alias("more"),
    )
    full = _bytes(ascii_lower(F.col("text")))
    state = rows.select(
        "id", "row", F.lit(0).cast("long").alias("gid"), F.sha2(full, 256).alias("sha"), full.alias("rest")
    )
    done, step = [], 0
    while True:
        step_state = state.select(
            "id", "row", "gid", "sha",
            F.substring("rest", 1, width).alias("head"),
            (F.length("rest") > width).alias("more"),
            F.expr(f"substring(rest, {width + 1})").alias("tail"),
        )
        if keys is None:
            keys = step_state.select("id", "row", "gid", "head", "more")
        groups = keys.groupBy("gid", "head", "more").agg(
            F.count(F.lit(1)).alias("n"),
            F.max("id").alias("keep_id"),
            F.coalesce(F.max_by("row", "id"), F.max("row")).alias("keep_row"),
        )
        # Written first: a join of two plain exchanges is one that Spark splits where a group is large.
        groups = written(groups, f"{folder}/groups-{step}")
        final = (F.col("n") == 1) | ~F.col("more")
        split = step_state.join(groups, ["gid", "head", "more"]).select(
            "id", "row", "sha", "n", "keep_id",
            (F.col("row") == F.col("keep_row")).alias("kept"),
            F.col("keep_row").alias("gid"),
            F.when(~final, F.col("tail")).alias("rest"),
            final.alias("final"),
        )
        table = written(split, f"{folder}/{step}", ["final"])
        done.append(table.filter("final"))
        state, keys = table.filter("not final"), None
        if state.isEmpty():
            break
        step, width = step + 1, width * growth
    result = done[0]
    for more in done[1:]:
        result = result.unionByName(more)
    return result.select(
        F.col("id").alias(id_col), "keep_id", F.col("n").alias("group_size"), "kept", F.col("sha").alias("text_sha256")
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The input rows that stay, with all their columns: of equal texts the row with the largest id.

    Rows that repeat both id and text are told apart by nothing; one of them stays.
    """
    rows, at = numbered(docs)
    ident, text = at[id_col], at[text_col]
    kept = exact_groups(rows, ident, text).filter("kept")

    def key(ident, sha):
        return F.concat_ws(":", F.coalesce(ident.cast("string"), F.lit("null")), sha)

    keys = kept.select(key(F.col(ident), F.col("text_sha256")).alias("_radix_key"))
    sha = F.sha2(_bytes(normalised(text)), 256)
    marked = rows.withColumn("_radix_key", key(F.col(ident), sha)).join(keys, "_radix_key", "left_semi")
    # Spark keeps one row a key on each side of the exchange (WindowGroupLimit), so repeated rows never meet in one task.
    nth = F.row_number().over(Window.partitionBy("_radix_key").orderBy(F.col(text).asc_nulls_last()))
    return renamed(marked.withColumn("_radix_nth", nth).filter("_radix_nth = 1"), docs)
