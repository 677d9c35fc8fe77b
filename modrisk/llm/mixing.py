"""Mixing sources to target weights by temperature, in DataFrame operations only.

Each source's token share p becomes p^a / Z. The exponent a lies in [0, 1]: 1 keeps the natural shares, 0 makes all
sources equal. It is found by section search: an aggregate over the source table tries many exponents in one job, and a
few rounds narrow the interval to the wanted precision. The largest flattening that keeps every limit wins: entropy no
higher than the target, and no source repeated more often than the limit.

The weights are realised against a token budget. A source of T tokens with a quota of q tokens is read in whole passes
as long as they fit; the last, partial pass takes its documents in a keyed order: hash blocks of bounded size come in
the order of their number, and inside the block where the quota ends, documents in the order of their hash. Totals per
block are aggregated first, so a source with a third of all rows is spread over as many tasks as it has blocks, and no
window holds more than the blocks of a source or the documents of one block.

Defined results: a null source is a source of its own. A null or empty text has no tokens; a document without tokens goes
with every whole pass, and with the last pass by its place. Rows that repeat have the same place and may be taken in
either order. No budget means the smallest budget at which every source is read in full at least once, so no document
is lost; with a budget the last document may exceed the quota, by less than its own length. An empty table or one without
tokens keeps every document once. Other columns pass through where ``mixed`` is used.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from modrisk.llm.shared import WORD, numbered, renamed, whole_text, work_folder, written

BLOCK_ROWS = 4096  # documents of a block, about
SEED = 17
SECTIONS = 32
ROUNDS = 6  # the exponent is right to 32^-6


@dataclass(frozen=True)
class Target:
    """Limits that the flattened shares keep."""

    entropy: float = 0.97  # of the entropy of equal shares, at most
    repetition: float = 4.0  # passes over any source, at most, at the budget
    budget: int | None = None  # tokens; None: the smallest that reads every source in full once


def tokens_of(text_col: str) -> Column:
    return F.regexp_count(whole_text(text_col), F.lit(WORD)).cast("long")


def source_totals(docs: DataFrame, source_col: str, tokens: Column) -> DataFrame:
    return docs.groupBy(F.col(source_col).alias("source")).agg(
        F.sum(tokens).alias("tokens"), F.count(F.lit(1)).alias("docs")
    )


def _facts(shares: DataFrame, exponents: list[float], total: int, target: Target) -> list[tuple[float, float, float]]:
    """(entropy, highest pass count, Z) of each exponent, all in one aggregate.

    With w = p^a / Z, a source is passed w * budget / tokens = p^(a-1) / Z * budget / total times.
    """
    log_p = F.ln(F.col("tokens") / F.lit(float(total)))
    columns = []
    for i, a in enumerate(exponents):
        power = F.exp(F.lit(float(a)) * log_p)
        columns += [
            F.sum(power).alias(f"z{i}"), F.sum(power * log_p).alias(f"e{i}"),
            F.max(F.exp(F.lit(float(a - 1)) * log_p)).alias(f"h{i}"),
            F.min(F.exp(F.lit(float(a - 1)) * log_p)).alias(f"l{i}"),
        ]
    row = shares.agg(*columns).first()
    facts = []
    for i, a in enumerate(exponents):
        z = row[f"z{i}"]
        entropy = math.log(z) - a * row[f"e{i}"] / z
        scale = target.budget / total / z if target.budget is not None else 1 / row[f"l{i}"]
        facts.append((entropy, row[f"h{i}"] * scale, z))
    return facts


def exponent(shares: DataFrame, total: int, sources: int, target: Target) -> tuple[float, float]:
    """The smallest exponent that keeps the limits, and its Z; 1.0 where even the natural shares break one.

    Entropy and repetition both fall as the exponent grows, so the exponents that keep the limits are an interval up to 1.
    """
    most = target.entropy * math.log(sources) if sources > 1 else 0.0

    def keeps(fact) -> bool:
        return fact[0] <= most + 1e-12 and fact[1] <= target.repetition * (1 + 1e-12)

    low, high = 0.0, 1.0
    z = 1.0
    for _ in range(ROUNDS):
        tried = [low + (high - low) * i / SECTIONS for i in range(SECTIONS + 1)]
        facts = _facts(shares, tried, total, target)
        good = next((i for i, f in enumerate(facts) if keeps(f)), SECTIONS)
        low, high, z = tried[max(0, good - 1)], tried[good], facts[good][2]
        if good == 0:
            break
    return high, z


def _plan(rows: DataFrame, target: Target, block_rows: int, folder: str) -> DataFrame:
    """One row per source: weight, passes, and where its last pass ends.

    ``rows`` has id, source and n_tokens. A document is in the last pass if its block comes before ``cut_block``, or is that
    block and its place is not beyond ``cut_place``.
    """
    totals = written(source_totals(rows, "source", F.col("n_tokens")), f"{folder}/sources")
    shares = totals.filter("tokens > 0")
    total, sources = shares.agg(F.coalesce(F.sum("tokens"), F.lit(0)), F.count(F.lit(1))).first()
    if not total:
        return totals.select(
            F.col("source").alias("_source"), F.lit(None).cast("double").alias("_weight"), F.lit(1).cast("long").alias("_passes"),
            F.lit(1).cast("long").alias("_blocks"), *[F.lit(None).cast("long").alias(c) for c in ("_cut_block", "_cut_place")],
        )
    a, z = exponent(shares, total, sources, target)
    share = F.col("tokens") / F.lit(float(total))
    weight = F.when(F.col("tokens") > 0, F.exp(F.lit(float(a)) * F.ln(share)) / F.lit(float(z)))
    weights = totals.withColumn("weight", weight).withColumn("per_token", F.col("weight") / F.col("tokens"))
    if target.budget is None:
        # Every source in full once: the one with the fewest passes decides.
        budget = 1.0 / weights.agg(F.min("per_token")).first()[0]
    else:
        budget = float(target.budget)
    # Rounded so that a quota of whole passes does not fall short by the last bits of a double.
    quota = F.round(F.coalesce(F.col("weight"), F.lit(0.0)) * F.lit(budget), 3)
    passes = F.when(F.col("tokens") > 0, F.floor(quota / F.col("tokens"))).otherwise(1).cast("long")
    plan = weights.select(
        F.col("source").alias("_source"), F.col("weight").alias("_weight"), passes.alias("_passes"),
        F.greatest(F.ceil(F.col("docs") / F.lit(block_rows)), F.lit(1)).cast("long").alias("_blocks"),
        (quota - passes * F.col("tokens")).alias("_rest"),
    )
    plan = written(plan, f"{folder}/plan")
    # Only sources that have a last, partial pass need a cut.
    placed = rows.join(plan.filter("_rest > 0"), F.col("source").eqNullSafe(F.col("_source"))).select(
        "id", "_source", "n_tokens", "_rest", _block().alias("_block"), _place().alias("_place")
    )
    before = Window.partitionBy("_source").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    sums = placed.groupBy("_source", "_block").agg(F.sum("n_tokens").alias("n"), F.first("_rest").alias("_rest"))
    starts = sums.withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0)))
    cuts = starts.filter("start < _rest and _rest <= start + n").select(
        F.col("_source").alias("s"), F.col("_block").alias("cut_block"), (F.col("_rest") - F.col("start")).alias("left")
    )
    cuts = written(cuts, f"{folder}/cuts")
    in_cut = placed.join(cuts, F.col("_source").eqNullSafe(F.col("s")) & (F.col("_block") == F.col("cut_block")))
    inside = Window.partitionBy("_source").orderBy("_place", "id").rowsBetween(Window.unboundedPreceding, -1)
    taken = in_cut.withColumn("so_far", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))).filter("so_far < left")
    ends = taken.groupBy("s", "cut_block").agg(F.max("_place").alias("_cut_place"))
    return plan.join(ends, F.col("_source").eqNullSafe(F.col("s")), "left").select(
        "_source", "_weight", "_passes", "_blocks", F.col("cut_block").alias("_cut_block"), "_cut_place"
    )


def _block(ident: str = "id") -> Column:
    return F.pmod(F.xxhash64(F.lit(SEED), F.lit("block"), F.col(ident), F.col("_passes")), F.col("_blocks"))


def _place(ident: str = "id") -> Column:
    return F.xxhash64(F.lit(SEED), F.lit("place"), F.col(ident), F.col("_passes"))


def _n_copies(ident: str) -> Column:
    last = (_block(ident) < F.col("_cut_block")) | (
        (_block(ident) == F.col("_cut_block")) & (_place(ident) <= F.col("_cut_place"))
    )
    return F.col("_passes") + F.coalesce(last, F.lit(False)).cast("long")


def _counted(docs: DataFrame, id_col: str, text_col: str, source_col: str, target: Target, block_rows: int):
    folder = work_folder(docs.sparkSession, "mixing")
    rows = docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), tokens_of(text_col).alias("n_tokens"))
    rows = written(rows, f"{folder}/rows")
    # Written: a small table of sources, so Spark may broadcast it when its size allows.
    return rows, written(_plan(rows, target, block_rows, folder), f"{folder}/mix")


def copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    target: Target = Target(), block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """One row per input row: id, source, n_tokens, weight (of its source), n_copies (times it is read)."""
    rows, plan = _counted(docs, id_col, text_col, source_col, target, block_rows)
    return rows.join(plan, F.col("source").eqNullSafe(F.col("_source"))).select(
        F.col("id").alias(id_col), F.col("source").alias(source_col), "n_tokens", F.col("_weight").alias("weight"),
        _n_copies("id").alias("n_copies"),
    )


def mixed(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    target: Target = Target(), block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """The input rows with all their columns, each as often as it is read."""
    rows, at = numbered(docs)
    _, plan = _counted(rows, at[id_col], at[text_col], at[source_col], target, block_rows)
    counted = rows.join(plan, rows[at[source_col]].eqNullSafe(plan["_source"])).withColumn("_n_copies", _n_copies(at[id_col]))
    counted = counted.filter("_n_copies > 0")
    return renamed(counted.withColumn("_n", F.explode(F.sequence(F.lit(1).cast("long"), "_n_copies"))), docs)
