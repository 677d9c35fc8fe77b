"""Attribution tables: (row_id, model, feature, value, contribution) and what follows from them."""

from __future__ import annotations

import json
import math
import random
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, Window as Win, functions as F

from modrisk.functions.bands import band
from modrisk.functions.draws import draw
from modrisk.functions.ordered import ROWS_PER_RANGE, exact_quantiles, ranked
from modrisk.operators.boxes import Boxes, boxes
from modrisk.operators.cleaning import col

# Sizes of backgrounds, samples and reports.
LINEAR_BACKGROUND, PERMUTATION_BACKGROUND = 100, 50
SURROGATE_SAMPLES = 500
SURROGATE_QUARTILES = 4
QUARTILE_SHARES = 16
KERNEL_FACTOR = 0.75
GLOBAL_TOP, WATERFALL_TOP, HEATMAP_TOP, HEATMAP_SAMPLES = 15, 12, 10, 200
COMPARISON_TOP, BREAKDOWN_TOP, SURROGATE_TOP, NARRATIVE_TOP = 10, 8, 10, 5


def background(rows: DataFrame, columns: list[str], key: str, size: int, seed: int = 42) -> list[list[float]]:
    """A small repeatable sample: the ``size`` rows with the smallest draws."""
    values = F.array(*[F.coalesce(col(c).cast("double"), F.lit(0.0)) for c in columns])
    picked = rows.select(values.alias("x"), F.xxhash64(F.lit(seed), col(key)).alias("h"), col(key).alias("k"))
    return [r["x"] for r in picked.orderBy("h", "k").limit(size).collect()]


def linear_attribution(
    rows: DataFrame, key: str, coefficients: dict[str, float], means: dict[str, float], model: str
) -> DataFrame:
    """coefficient x (value - background mean); sums to the difference in log odds."""
    parts = [
        F.struct(
            F.lit(c).alias("feature"),
            col(c).cast("double").alias("value"),
            (F.lit(float(w)) * (col(c) - F.lit(float(means[c])))).alias("contribution"),
        )
        for c, w in coefficients.items()
    ]
    return rows.select(col(key).alias("row_id"), F.lit(model).alias("model"), F.inline(F.array(*parts)))


def explain_linear(model, rows: DataFrame, key: str, columns: list[str], base_rows: DataFrame, name: str) -> DataFrame:
    """Attribution of a fitted logistic regression against a background sample."""
    sample = np.array(background(base_rows, columns, key, LINEAR_BACKGROUND))
    means = dict(zip(columns, sample.mean(axis=0)))
    return linear_attribution(rows, key, dict(zip(columns, model.coefficients.toArray())), means, name)


def permutation_attribution(
    model, rows: DataFrame, key: str, columns: list[str], base: list[list[float]], name: str,
    permutations: int = 10, seed: int = 42,
) -> DataFrame:
    """Shapley attribution of any classifier by feature permutations.

    Along an order, features are switched from a background value to the row's
    own, one after the other; a feature is credited with the change of the
    probability. Orders that have switched the same features share their
    variants: each (set of features, background row) is scored once a row, the
    row as it is once, and the background rows once altogether. A variant's
    probability then counts for the features that led to its set and against
    those that follow, so plain sums a row give the result, made where the row
    was scored. The number of variants is fixed by the arguments, not by the
    data. ``model`` is anything with ``transform``, a ``models.Formula`` too.
    """
    n = len(columns)
    orders = permutation_orders(n, permutations, seed)
    credit: dict[frozenset, list[int]] = {}
    for order in orders:
        for step in range(n + 1):
            counts = credit.setdefault(frozenset(order[:step]), [0] * n)
            if step:
                counts[order[step - 1]] += 1
            if step < n:
                counts[order[step]] -= 1
    whole, none = frozenset(range(n)), frozenset()
    sets = sorted((s for s in credit if s not in (whole, none)), key=lambda s: (len(s), sorted(s)))

    def probability(frame: DataFrame, *keep: str) -> DataFrame:
        return model.transform(frame).select(*keep, F.get(vector_to_array("probability"), F.lit(1)).alias("_p"))

    spark = rows.sparkSession
    grounds = spark.createDataFrame([([float(v) for v in b],) for b in base], "x array<double>")
    ground = probability(grounds.select(array_to_vector("x").alias("features"))).agg(F.avg("_p")).first()[0]
    # Every variant of a row: what its probability counts for each feature, what is switched on, and the rest's values.
    listed = [{"credit": [c / len(base) for c in credit[s]], "on": [i in s for i in range(n)], "base": [float(v) for v in b]} for s in sets for b in base]
    listed = json.dumps([*listed, {"credit": credit[whole], "on": [True] * n, "base": [0.0] * n}])
    listed = F.from_json(F.lit(listed), "array<struct<credit: array<double>, on: array<boolean>, base: array<double>>>")
    own = rows.select(col(key).alias("row_id"), *[F.coalesce(col(c).cast("double"), F.lit(0.0)).alias(f"_x{i}") for i, c in enumerate(columns)])
    # Each of these small rows is scored many times: they are dealt by a given number, which is not cut down by their size,
    # and the sums below find them together. Plain columns, since sums that carry arrays along are made by sorting.
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    variants = own.repartition(tasks, "row_id").select("*", F.inline(listed).alias("_credit", "_on", "_base"))
    mixed = F.array(*[F.when(F.get("_on", F.lit(i)), F.col(f"_x{i}")).otherwise(F.get("_base", F.lit(i))) for i in range(n)])
    own_columns = [f"_x{i}" for i in range(n)]
    scored = probability(variants.select("row_id", *own_columns, "_credit", array_to_vector(mixed).alias("features")), "row_id", *own_columns, "_credit")
    sums = scored.groupBy("row_id").agg(
        *[F.any_value(x).alias(x) for x in own_columns],
        *[F.sum(F.get("_credit", F.lit(i)) * F.col("_p")).alias(f"_s{i}") for i in range(n)],
    )
    parts = [
        F.struct(
            F.lit(c).alias("feature"), F.col(f"_x{i}").alias("value"),
            ((F.col(f"_s{i}") + F.lit(float(credit[none][i] * ground))) / F.lit(float(len(orders)))).alias("contribution"),
        )
        for i, c in enumerate(columns)
    ]
    return sums.select("row_id", F.lit(name).alias("model"), F.inline(F.array(*parts)))


def permutation_orders(n: int, permutations: int, seed: int = 42) -> list[list[int]]:
    """Seeded orders of n features, each with its reverse."""
    rng = random.Random(seed)
    orders: list[list[int]] = []
    while len(orders) < permutations:
        order = rng.sample(range(n), n)
        orders += [order, order[::-1]]
    return orders[:permutations]


def global_importance(attributions: DataFrame, top: int | None = GLOBAL_TOP) -> DataFrame:
    """Mean absolute contribution per model and feature; the best per model."""
    means = attributions.groupBy("model", "feature").agg(F.avg(F.abs("contribution")).alias("importance"))
    if top is None:
        return means
    order = Win.partitionBy("model").orderBy(F.desc("importance"), "feature")
    return means.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)


def distribution_rows(attributions: DataFrame, top: int = GLOBAL_TOP) -> DataFrame:
    """Values and contributions of the most important features."""
    best = global_importance(attributions, top).select("model", "feature", "rank")
    return attributions.join(F.broadcast(best), ["model", "feature"])  # at most ``top`` rows a model


def heatmap(
    attributions: DataFrame, top: int = HEATMAP_TOP, samples: int = HEATMAP_SAMPLES, rows_per_range: int = ROWS_PER_RANGE
) -> DataFrame:
    """Top features of rows in the order of their total contribution, evenly thinned.

    Works on one model; rows of equal totals stand in the order of a draw by
    their id. Ranks come from range-partitioned windows, and the draw spreads a
    total that many rows share over several of them.
    """
    rows = distribution_rows(attributions, top)
    totals = rows.groupBy("row_id").agg(F.sum("contribution").alias("_total"))
    totals = totals.withColumn("_draw", draw("heatmap", F.col("row_id"))).persist()
    order = ranked(totals, [], "_total", ["_draw", "row_id"], "_rank", rows_per_range=rows_per_range, spread="_draw")
    n = totals.agg(F.count(F.lit(1)).alias("n")).first()["n"]
    at = F.col("_rank") - 1
    kept = order.select("row_id", "_rank")
    if n > samples:
        # Sample i sits at rank floor(i (n - 1) / (samples - 1)).
        i = F.ceil(at * (samples - 1) / F.lit(n - 1)).cast("long")
        kept = order.filter(F.floor(i * F.lit(n - 1) / F.lit(samples - 1)) == at).select("row_id", "_rank")
    position = Win.orderBy("_rank")
    # At most ``samples`` rows are left here.
    placed = kept.withColumn("sample", F.row_number().over(position)).drop("_rank")
    return rows.join(F.broadcast(placed), "row_id").select("sample", "row_id", "rank", "feature", "contribution")


def waterfall(attributions: DataFrame, base_value: float = 0.5, top: int = WATERFALL_TOP) -> DataFrame:
    """Per model and row: top contributions, the rest as one step, and the running total."""
    order = Win.partitionBy("model", "row_id").orderBy(F.desc(F.abs("contribution")), "feature")
    marked = attributions.withColumn("_n", F.row_number().over(order))
    rest = F.col("_n") > top
    steps = marked.groupBy("model", "row_id", F.when(rest, top + 1).otherwise(F.col("_n")).alias("step")).agg(
        F.any_value("feature").alias("_feature"),
        F.count(F.lit(1)).alias("_count"),
        F.sum("contribution").alias("contribution"),
    )
    name = F.when(
        F.col("step") == top + 1, F.concat(F.lit("other "), F.col("_count").cast("string"), F.lit(" features"))
    ).otherwise(F.col("_feature"))
    run = Win.partitionBy("model", "row_id").orderBy("step").rowsBetween(Win.unboundedPreceding, 0)
    return steps.select(
        "model", "row_id", "step", name.alias("feature"), "contribution",
        (F.lit(base_value) + F.sum("contribution").over(run)).alias("running_total"),
    )


def dependency(attributions: DataFrame, feature: str, colour: str | None = None) -> DataFrame:
    """Value and contribution of one feature, coloured by the value of another."""
    names = [feature] + ([colour] if colour else [])
    wide = attributions.filter(F.col("feature").isin(*names)).groupBy("model", "row_id").agg(
        F.max(F.when(F.col("feature") == feature, F.col("value"))).alias("value"),
        F.max(F.when(F.col("feature") == feature, F.col("contribution"))).alias("contribution"),
        F.max(F.when(F.col("feature") == colour, F.col("value"))).alias("_colour") if colour else F.lit(None).cast("double").alias("_colour"),
    )
    shade = F.col("_colour") if colour else F.col("contribution")
    return wide.select("model", "row_id", "value", "contribution", shade.alias("colour"))


def model_comparison(attributions: list[DataFrame], top: int = COMPARISON_TOP) -> DataFrame:
    """Most important features of several models side by side."""
    return global_importance(_together(attributions), top)


def breakdown(attributions: list[DataFrame], row_id=None, top: int = BREAKDOWN_TOP) -> DataFrame:
    """Largest contributions per model and row, for one row or for all."""
    rows = _together(attributions)
    if row_id is not None:
        rows = rows.filter(F.col("row_id") == row_id)
    order = Win.partitionBy("model", "row_id").orderBy(F.desc(F.abs("contribution")), "feature")
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)


def _together(frames: list[DataFrame]) -> DataFrame:
    whole = frames[0]
    for frame in frames[1:]:
        whole = whole.unionByName(frame)
    return whole


def surrogate_draws(samples: int, features: int, seed: int = 42) -> list[list[float]]:
    """Seeded numbers in [0, 1), one a feature for each perturbed row; all rows share them."""
    rng = random.Random(seed)
    return [[rng.random() for _ in range(features)] for _ in range(samples)]


def _kernel(apart, k: int):
    """The exponent of a perturbed row's weight, by the number of features that moved."""
    return -apart / (KERNEL_FACTOR * math.sqrt(k)) ** 2


def _scored_sums(model, own: DataFrame, listed: list[dict], pairs: list[tuple[int, int]]) -> DataFrame:
    """(row_id, sums) of a local surrogate: every perturbed row is scored. Columns, not array functions, which are not compiled."""
    k = len(listed[0]["pick"])
    drawn = F.from_json(F.lit(json.dumps(listed)), "array<struct<n: double, pick: array<int>, level: array<double>>>")
    # Each of these small rows is scored many times: they are dealt by a given number, which is not cut down by their size,
    # and the sums below find them together.
    tasks = int(own.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = own.repartition(tasks, "row_id").select("*", F.inline(drawn).alias("_n", "_pick", "_level"))
    z = [F.col(f"_z{j}") for j in range(k)]
    stays = [(F.get("_pick", F.lit(j)) == -1) | (F.get("_pick", F.lit(j)) == F.col(f"_own{j}")) for j in range(k)]
    moved = F.array(*[F.when(stays[j], F.col(f"_x{j}")).otherwise(F.get("_level", F.lit(j))) for j in range(k)])
    scored = model.transform(
        placed.select("row_id", "_n", *[stays[j].cast("double").alias(f"_z{j}") for j in range(k)], array_to_vector(moved).alias("features"))
    ).select("row_id", "_n", *z, F.get(vector_to_array("probability"), F.lit(1)).alias("_p"))
    apart = F.lit(float(k))
    for same in z:
        apart = apart - same
    weighed = scored.withColumn("_w", F.col("_n") * F.sqrt(F.exp(_kernel(apart, k))))
    return weighed.groupBy("row_id").agg(
        F.array(
            F.sum("_w"), F.sum(F.col("_w") * F.col("_p")), *[F.sum(F.col("_w") * z[j] * F.col("_p")) for j in range(k)],
            *[F.sum(F.col("_w") * z[i] * z[j]) for i, j in pairs],
        ).alias("sums")
    )


def _boxed_sums(held: Boxes, own: DataFrame, listed: list[dict], pairs: list[tuple[int, int]]) -> DataFrame:
    """The same sums for a forest: rows with the same own quartiles share one table of what their perturbed rows add up to.

    They are dealt by these quartiles, in ``QUARTILE_SHARES`` shares each, since many rows may have the same.
    """
    k = len(listed[0]["pick"])
    n, pick = np.array([float(v["n"]) for v in listed]), np.array([v["pick"] for v in listed])
    fixed = held.holding(np.array([v["level"] for v in listed]))
    kept = np.arange(2**k)[:, None] >> np.arange(k) & 1
    weight = np.sqrt(np.exp(_kernel(k - kept.sum(axis=1), k)))
    factors = weight[:, None] * np.column_stack([np.ones(2**k), kept])

    def of(quartiles):
        stays = (pick == -1) | (pick == quartiles)
        bits = stays @ (1 << np.arange(k))
        w = n * weight[bits]
        return held.table(bits, fixed, n, factors), w.sum(), [w[stays[:, i] & stays[:, j]].sum() for i, j in pairs]

    columns = ["row_id", *[f"_s{i}" for i in range(2 + k + len(pairs))]]

    def summed(batches):
        last, made = None, None
        for batch in batches:
            values, cells = (np.column_stack([batch.column(f"{c}{j}").to_numpy() for j in range(k)]) for c in ("_x", "_own"))
            out = np.empty((len(values), len(columns) - 1))
            starts = [0, *(np.flatnonzero((cells[1:] != cells[:-1]).any(axis=1)) + 1)]
            for begin, end in zip(starts, [*starts[1:], len(values)]):
                if begin == end:
                    continue
                if last is None or (cells[begin] != last).any():
                    last, made = cells[begin].copy(), of(cells[begin])
                table, total, plain = made
                out[begin:end, 0], out[begin:end, 2 + k :] = total, plain
                out[begin:end, 1 : 2 + k] = held.sums(values[begin:end], table)
            yield pa.RecordBatch.from_arrays([batch.column("row_id"), *[pa.array(s) for s in out.T]], names=columns)

    kind = own.select("row_id").schema.simpleString().removeprefix("struct<").removesuffix(">")
    cell = [f"_own{j}" for j in range(k)]
    tasks = int(own.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = own.repartition(tasks, *cell, F.pmod(F.xxhash64("row_id"), F.lit(QUARTILE_SHARES))).sortWithinPartitions(*cell)
    each = placed.mapInArrow(summed, f"{kind}, " + ", ".join(f"{c} double" for c in columns[1:]))
    return each.groupBy("row_id").agg(F.array(*[F.sum(c) for c in columns[1:]]).alias("sums"))


def local_surrogate(
    model, rows: DataFrame, key: str, columns: list[str], training: DataFrame,
    samples: int = SURROGATE_SAMPLES, top: int = SURROGATE_TOP, seed: int = 42,
) -> DataFrame:
    """Weights of a local linear model around each row.

    Features are cut at training quartiles. A perturbed row takes, per feature,
    the training mean of a quartile drawn by its training frequency; where that
    is the row's own quartile, its value stays. The surrogate sees only which
    quartiles stayed. Besides the row itself there are ``samples`` - 1 perturbed
    rows; all rows share the draws, and equal draws are scored once and count as
    often as they came. The weighted sums that a ridge regression needs are
    plain sums a row, made where the row was scored, or for a forest of few
    features from its boxes; a k x k system is then solved for each row. Null
    values count as 0; of equal weights the feature named first leads, where
    weights are compared to nine decimals.
    """
    k = len(columns)
    quartiles = exact_quantiles(training, columns, [0.25, 0.5, 0.75])
    cuts = [sorted({q for q in quartiles[c] if q is not None}) for c in columns]

    def cell(value: Column, points: list[float]) -> Column:
        number = F.lit(0)
        for p in points:
            number = number + F.when(value > F.lit(p), 1).otherwise(0)
        return number

    bins = [(j, b) for j in range(k) for b in range(len(cuts[j]) + 1)]
    value = [col(c).cast("double") for c in columns]
    held = {(j, b): F.when(value[j].isNotNull() & (cell(value[j], cuts[j]) == b), value[j]) for j, b in bins}
    facts = training.agg(*[f(held[i]).alias(f"{n}{i[0]}_{i[1]}") for i in bins for n, f in (("m", F.avg), ("n", F.count))]).first()
    levels = [[facts[f"m{j}_{b}"] or 0.0 for b in range(len(cuts[j]) + 1)] for j in range(k)]
    counts = [[facts[f"n{j}_{b}"] for b in range(len(cuts[j]) + 1)] for j in range(k)]
    ends = [[sum(n[: b + 1]) / max(sum(n), 1) for b in range(len(n) - 1)] for n in counts]
    picks = Counter(
        tuple(sum(u >= end for end in ends[j]) for j, u in enumerate(draws)) for draws in surrogate_draws(samples - 1, k, seed)
    )
    # The row itself picks its own quartile of every feature.
    listed = [{"n": n, "pick": list(pick), "level": [levels[j][b] for j, b in enumerate(pick)]} for pick, n in sorted(picks.items())]
    listed = [{"n": 1, "pick": [-1] * k, "level": [0.0] * k}, *listed]
    values = [F.coalesce(v, F.lit(0.0)) for v in value]
    own = rows.select(
        col(key).alias("row_id"), *[v.alias(f"_x{j}") for j, v in enumerate(values)], *[cell(v, cuts[j]).alias(f"_own{j}") for j, v in enumerate(values)]
    )
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    held = boxes(rows.sparkSession, model, k)
    sums = _scored_sums(model, own, listed, pairs) if held is None else _boxed_sums(held, own, listed, pairs)
    kind = rows.select(col(key).alias("row_id")).schema.simpleString().removeprefix("struct<").removesuffix(">")

    def solve(batches):
        at = np.array(pairs).T
        for batch in batches:
            if batch.empty:
                continue
            total = np.vstack(batch["sums"].to_numpy())
            gram = np.zeros((len(total), k, k))
            gram[:, at[0], at[1]] = gram[:, at[1], at[0]] = total[:, 2 + k :]
            once = np.einsum("rii->ri", gram)  # the values are 0 and 1, so squares are the values
            weight, answer = total[:, 0], total[:, 1]
            left = gram - once[:, :, None] * once[:, None, :] / weight[:, None, None] + np.eye(k)
            right = total[:, 2 : 2 + k] - once * (answer / weight)[:, None]
            beta = np.linalg.solve(left, right[:, :, None])[:, :, 0]
            yield pd.DataFrame({"row_id": batch["row_id"], "weights": list(beta)})

    solved = sums.mapInPandas(solve, f"{kind}, weights array<double>")
    names = F.array(*[F.lit(c) for c in columns])
    order = F.slice(
        F.array_sort(F.transform("weights", lambda w, j: F.struct((-F.round(F.abs(w), 9)).alias("by"), j.alias("j"), w.alias("w")))), 1, top
    )
    return solved.select("row_id", F.posexplode(order).alias("_at", "_one")).select(
        "row_id", F.get(names, F.col("_one.j")).alias("feature"), F.col("_one.w").alias("weight"), (F.col("_at") + 1).alias("rank")
    )


# Own wording of the verdicts and advice.
ADVICE = {
    "HIGH": "Review this module now; split long functions; test its complex paths.",
    "MED": "Add a second reviewer; watch this module; document it if comments are rare.",
    "LOW": "Nothing to do beyond keeping complexity where it is.",
}
VERDICTS = {"HIGH": "HIGH RISK", "MED": "MEDIUM RISK", "LOW": "LOW RISK"}


def narratives(attributions: DataFrame, probabilities: DataFrame, threshold: float = 0.5, top: int = NARRATIVE_TOP) -> DataFrame:
    """One text row per module: verdict, factors that raise or lower risk, advice.

    ``probabilities`` is (row_id, model, score).
    """
    order = Win.partitionBy("model", "row_id").orderBy(F.desc(F.abs("contribution")), "feature")
    best = attributions.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= top)
    text = F.format_string("%s = %.2f (%+.4f)", "feature", "value", "contribution")
    factors = best.groupBy("model", "row_id").agg(
        F.array_sort(F.collect_list(F.when(F.col("contribution") > 0, F.struct("_n", text.alias("t"))))).alias("up"),
        F.array_sort(F.collect_list(F.when(F.col("contribution") < 0, F.struct("_n", text.alias("t"))))).alias("down"),
    )
    level = band(F.col("score"), "analysis")
    named = F.create_map(*[F.lit(x) for pair in VERDICTS.items() for x in pair])
    advice = F.create_map(*[F.lit(x) for pair in ADVICE.items() for x in pair])
    side = F.when(F.col("score") >= threshold, "above").otherwise("below")
    return probabilities.join(factors, ["model", "row_id"], "left").select(
        "model", "row_id", "score", F.element_at(named, level).alias("verdict"),
        F.format_string(
            "%s: probability %.1f%%, %s the %.0f%% threshold", F.element_at(named, level),
            F.col("score") * 100, side, F.lit(threshold * 100),
        ).alias("headline"),
        F.array_join(F.coalesce(F.col("up.t"), F.array()), "; ").alias("raises_risk"),
        F.array_join(F.coalesce(F.col("down.t"), F.array()), "; ").alias("lowers_risk"),
        F.element_at(advice, level).alias("advice"),
    )
