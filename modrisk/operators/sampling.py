"""Splits, folds, class weights and oversampling; every draw depends on keys only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window as Win, functions as F

from modrisk.functions.draws import draw
from modrisk.functions.ordered import ROWS_PER_RANGE, ranked, values_at
from modrisk.operators.cleaning import LABEL, col
from modrisk.operators.neighbours import nearest

NEIGHBOURS = 5
ROWS_PER_SEED_TASK = 100_000


def class_sizes(rows: DataFrame, label: str = LABEL) -> dict:
    """Rows per class; classes are few."""
    counted = rows.groupBy(col(label).alias("c")).agg(F.count(F.lit(1)).alias("n"))
    return {r["c"]: r["n"] for r in counted.collect()}


def class_weights(rows: DataFrame, label: str = LABEL) -> DataFrame:
    """One row: class sizes, balanced weights n/(2 n_c), n_neg/n_pos, minority ratio."""
    y = col(label)
    positive, negative = F.count_if(y == 1), F.count_if(y == 0)
    total = positive + negative

    def weight(size: Column) -> Column:
        return F.when(size > 0, F.try_divide(total.cast("double"), size * 2)).otherwise(1.0)

    return rows.agg(
        negative.alias("negatives"),
        positive.alias("positives"),
        weight(negative).alias("weight_0"),
        weight(positive).alias("weight_1"),
        F.when(positive > 0, F.try_divide(negative.cast("double"), positive)).otherwise(1.0).alias("positive_weight"),
        F.try_divide(
            F.least(negative, positive).cast("double"), F.greatest(negative, positive)
        ).alias("minority_ratio"),
    )


def with_class_weights(rows: DataFrame, label: str = LABEL, name: str = "weight") -> DataFrame:
    """Balanced class weight as a column, from one small aggregate."""
    w = class_weights(rows, label).first()
    return rows.withColumn(name, F.when(col(label) == 1, w["weight_1"]).otherwise(w["weight_0"]))


def _test_sizes(sizes: dict, share: float) -> dict:
    """Test rows per class: proportional, remainders to the largest fractions."""
    total = sum(sizes.values())
    target = math.ceil(share * total)
    exact = {c: target * n / total for c, n in sizes.items()}
    given = {c: math.floor(x) for c, x in exact.items()}
    order = sorted(sizes, key=lambda c: (-(exact[c] - given[c]), c))
    for c in order[: target - sum(given.values())]:
        given[c] += 1
    return given


def stratified_split(
    rows: DataFrame,
    key: str,
    label: str = LABEL,
    test_share: float = 0.2,
    seed: int = 42,
    exact: bool = True,
    small: int = ROWS_PER_RANGE,
) -> DataFrame:
    """Add ``is_test``. ``key`` must be unique.

    Exact: the rows with the smallest draws of each class. The draw at the
    boundary rank is found by bracketing, so nothing is sorted or shuffled and
    the result is a comparison on each row. Not exact: draw below the share.
    """
    u = draw(seed, col(key))
    if not exact:
        return rows.withColumn("is_test", u < F.lit(test_share))
    sizes = class_sizes(rows, label)
    taken = {c: n for c, n in _test_sizes(sizes, test_share).items() if n > 0}
    if not taken:
        return rows.withColumn("is_test", F.lit(False))
    drawn = rows.select(
        col(key).alias("_key"), *[F.when(col(label) == c, u).alias(f"u{i}") for i, c in enumerate(taken)]
    )
    edges = {}
    for i, (c, n) in enumerate(taken.items()):
        _, found = values_at(drawn, {f"u{i}": [(n - 0.5) / sizes[c]]}, lambda size, n=n: [n - 1], small)
        edges[c] = found[f"u{i}"][n - 1]
    # Equal draws are rare (one in 2^32); among them the smaller keys go first.
    facts = drawn.agg(
        *[F.count_if(F.col(f"u{i}") < edges[c]).alias(f"n{i}") for i, c in enumerate(taken)],
        *[F.array_sort(F.collect_list(F.when(F.col(f"u{i}") == edges[c], F.col("_key")))).alias(f"k{i}") for i, c in enumerate(taken)],
    ).first()
    is_test = F.lit(False)
    for i, (c, n) in enumerate(taken.items()):
        last = facts[f"k{i}"][n - facts[f"n{i}"] - 1]
        is_test = is_test | ((col(label) == c) & ((u < edges[c]) | ((u == edges[c]) & (col(key) <= F.lit(last)))))
    return rows.withColumn("is_test", is_test)


def stratified_folds(
    rows: DataFrame,
    key: str,
    label: str = LABEL,
    folds: int = 5,
    seed: int = 42,
    exact: bool = True,
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """Add ``fold`` in 0..folds-1, dealt out in draw order within each class.

    The ranks behind the deal come from range-partitioned windows. With
    ``exact=False`` the fold is cut from the draw itself and needs no ranks.
    """
    u = draw(seed, col(key))
    if not exact:
        return rows.withColumn("fold", F.floor(u * folds).cast("int"))
    ordered = ranked(
        rows.withColumn("_u", u), [label], "_u", [key], "_rank", rows_per_range=rows_per_range, uniform=True
    )
    return ordered.withColumn("fold", F.pmod(F.col("_rank") - 1, F.lit(folds)).cast("int")).drop("_u", "_rank")


def _along_segments(
    seeds: DataFrame, minority: DataFrame, key: str, vector: str, k: int, seed: int
) -> DataFrame:
    """New vectors on the segments from seed rows to random near neighbours.

    ``seeds`` is (key, copies). A seed asked for very many copies is split into
    pieces first, so no single task writes them all.
    """
    near = nearest(minority, minority, k, key, vector)
    vectors = minority.select(col(key).alias("neighbour"), col(vector).cast("array<double>").alias("_to"))
    lists = (
        near.join(vectors, "neighbour")
        .groupBy(key)
        .agg(F.array_sort(F.collect_list(F.struct("rank", "_to"))).alias("_near"))
    )
    base = minority.select(col(key).alias(key), col(vector).cast("array<double>").alias("_from"))
    piece = F.sequence(F.lit(0).cast("long"), F.col("copies") - 1, F.lit(ROWS_PER_SEED_TASK).cast("long"))
    pieces = (
        seeds.filter(F.col("copies") > 0)
        .join(base, key)
        .join(lists, key)
        .select("*", F.explode(piece).alias("_first"))
        .repartition(F.col(key), F.col("_first"))
    )
    last = F.least(F.col("_first") + ROWS_PER_SEED_TASK, F.col("copies")) - 1
    drawn = pieces.select(
        "*", F.explode(F.sequence(F.col("_first"), last)).alias("copy")
    ).select(
        key, "copy", "_from", "_near",
        draw(f"{seed}:pick", F.col(key), F.col("copy")).alias("_pick"),
        draw(f"{seed}:step", F.col(key), F.col("copy")).alias("_step"),
    )
    target = F.element_at("_near", (F.floor(F.col("_pick") * F.size("_near")) + 1).cast("int"))["_to"]
    return drawn.select(key, "copy", "_from", "_step", target.alias("_to")).select(
        key, "copy",
        F.zip_with("_from", "_to", lambda a, b: a + F.col("_step") * (b - a)).alias(vector),
    )


def _combined(rows: DataFrame, synthetic: DataFrame, key: str, vector: str, label: str, minority_class) -> DataFrame:
    original = rows.select(
        col(key).alias(key), F.lit(None).cast("long").alias("copy"),
        col(vector).cast("array<double>").alias(vector), col(label).alias(label), F.lit(False).alias("is_synthetic"),
    )
    added = synthetic.select(
        key, "copy", vector,
        F.lit(minority_class).cast(rows.schema[label].dataType).alias(label), F.lit(True).alias("is_synthetic"),
    )
    return original.unionByName(added)


def smote(
    rows: DataFrame, key: str, vector: str, label: str = LABEL, k: int = NEIGHBOURS, seed: int = 42
) -> DataFrame:
    """Add synthetic rows of the smaller class until both classes are equal.

    Copies are dealt evenly over the minority rows in draw order. With too few
    minority rows for k neighbours the rows come back unchanged.
    """
    sizes = class_sizes(rows, label)
    minority_class = min(sizes, key=lambda c: (sizes[c], c))
    small, large = sizes[minority_class], max(sizes.values())
    minority = rows.filter(col(label) == minority_class)
    missing = large - small if small > k and len(sizes) > 1 else 0
    order = ranked(
        minority.select(col(key).alias(key), draw(f"{seed}:order", col(key)).alias("_u")), [], "_u", [key], "_rank",
        uniform=True,
    )
    seeds = order.select(
        key,
        (F.lit(missing // small) + F.when(F.col("_rank") <= missing % small, 1).otherwise(0)).cast("long").alias("copies"),
    )
    return _combined(rows, _along_segments(seeds, minority, key, vector, k, seed), key, vector, label, minority_class)


def adasyn(
    rows: DataFrame, key: str, vector: str, label: str = LABEL, k: int = NEIGHBOURS, seed: int = 42
) -> DataFrame:
    """Add synthetic minority rows, more where more of the k nearest are majority rows."""
    sizes = class_sizes(rows, label)
    minority_class = min(sizes, key=lambda c: (sizes[c], c))
    small, large = sizes[minority_class], max(sizes.values())
    minority = rows.filter(col(label) == minority_class)
    missing = large - small if small > k and len(sizes) > 1 else 0
    classes = rows.select(col(key).alias("neighbour"), col(label).alias("_y"))
    hardness = (
        nearest(minority, rows, k, key, vector)
        .join(classes, "neighbour")
        .groupBy(key)
        .agg((F.count_if(F.col("_y") != minority_class) / F.lit(float(k))).alias("hardness"))
    )
    total = hardness.agg(F.sum("hardness").alias("s")).first()["s"] or 0.0
    share = F.col("hardness") / F.lit(total) if total > 0 else F.lit(0.0)
    seeds = hardness.select(key, F.rint(share * F.lit(float(missing))).cast("long").alias("copies"))
    return _combined(rows, _along_segments(seeds, minority, key, vector, k, seed), key, vector, label, minority_class)


def rebalanced(rows: DataFrame, key: str, vector: str, label: str = LABEL, strategy: str = "smote", k: int = NEIGHBOURS, seed: int = 42) -> DataFrame:
    """Rows rebalanced by ``smote`` or ``adasyn``, or as they are for ``none``."""
    if strategy == "none":
        return rows
    return {"smote": smote, "adasyn": adasyn}[strategy](rows, key, vector, label, k, seed)
