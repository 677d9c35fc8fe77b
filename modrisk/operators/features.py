"""Feature engineering, feature scores and selection on metrics tables."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.sql import Column, DataFrame, functions as F

from modrisk.functions.ordered import ROWS_PER_RANGE, exact_quantiles
from modrisk.functions.tasks import dealt
from modrisk.operators import forest
from modrisk.operators.cleaning import LABEL, _Readable, col, feature_columns

# Heavy-tailed metrics, products and ratios.
LOG_METRICS = [
    "loc", "n", "v", "l", "d", "i", "e", "b", "t", "lOCode", "lOComment", "lOBlank",
    "total_Op", "total_Opnd", "uniq_Op", "uniq_Opnd",
]
PRODUCTS = [("v(g)", "loc"), ("ev(g)", "v(g)"), ("iv(g)", "v(g)"), ("d", "v"), ("branchCount", "loc")]
RATIOS = [
    ("v(g)_per_loc", "v(g)", "loc"),
    ("ev(g)_per_vg", "ev(g)", "v(g)"),
    ("iv(g)_per_vg", "iv(g)", "v(g)"),
    ("comment_density", "lOComment", "loc"),
    ("branch_density", "branchCount", "loc"),
]
FOREST_TREES, FOREST_DEPTH = 100, 8
SPARKS_FOREST_ROWS = 100_000  # up to so many rows Spark's forest takes some seconds
INFORMATION_BINS = 10


def log_columns(columns: list[str]) -> list[str]:
    wanted = {m.lower() for m in LOG_METRICS}
    return [c for c in columns if c.lower().replace("(", "").replace(")", "") in wanted]


def with_logs(rows: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """``log_x = ln(1 + max(x, 0))`` for the heavy-tailed metrics; NULL stays NULL."""
    chosen = log_columns(rows.columns) if columns is None else columns
    return rows.select(
        "*",
        *[
            F.when(col(c).isNotNull(), F.log1p(F.greatest(col(c), F.lit(0)).cast("double"))).alias(f"log_{c}")
            for c in chosen
            if c in rows.columns
        ],
    )


def with_products(rows: DataFrame) -> DataFrame:
    present = set(rows.columns)
    return rows.select(
        "*", *[(col(a) * col(b)).alias(f"{a}x{b}") for a, b in PRODUCTS if {a, b} <= present]
    )


def with_ratios(rows: DataFrame) -> DataFrame:
    """Ratios of metric pairs; a zero or missing denominator gives 0."""
    present = set(rows.columns)
    return rows.select(
        "*",
        *[
            F.when(F.coalesce(col(b), F.lit(0)) == 0, F.lit(0.0))
            .otherwise(F.try_divide(col(a), col(b)))
            .alias(name)
            for name, a, b in RATIOS
            if {a, b} <= present
        ],
    )


def min_max(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Columns scaled to 0..1; constant columns become 0."""
    row = rows.agg(
        *[F.min(col(c)).alias(f"lo{i}") for i, c in enumerate(columns)],
        *[F.max(col(c)).alias(f"hi{i}") for i, c in enumerate(columns)],
    ).first()
    scaled = {}
    for i, c in enumerate(columns):
        lo, hi = row[f"lo{i}"], row[f"hi{i}"]
        varies = lo is not None and hi > lo
        scaled[c] = (col(c) - F.lit(lo)) / F.lit(float(hi - lo)) if varies else F.lit(0.0)
    return rows.select(*[scaled[c].alias(c) if c in scaled else col(c) for c in rows.columns])


def _over_plus_one(rows: DataFrame, top: str, bottom: str) -> Column:
    if top in rows.columns and bottom in rows.columns:
        return col(top) / (col(bottom) + 1)
    return F.lit(0.0)


def aggregated_features(rows: DataFrame) -> DataFrame:
    """Complexity from decisions, and four ratios; 0 where inputs are absent."""
    decisions = (
        (col("DECISION_COUNT") + 1) if "DECISION_COUNT" in rows.columns else F.lit(0)
    )
    new = {
        "CYCLOMATIC_COMPLEXITY": decisions,
        "CODE_DENSITY": _over_plus_one(rows, "LOC_EXECUTABLE", "LOC_TOTAL"),
        "COMMENT_RATIO": _over_plus_one(rows, "LOC_COMMENTS", "LOC_TOTAL"),
        "DESIGN_COMPLEXITY_RATIO": _over_plus_one(rows, "DESIGN_COMPLEXITY", "CYCLOMATIC_COMPLEXITY"),
        "ESSENTIAL_COMPLEXITY_RATIO": _over_plus_one(rows, "ESSENTIAL_COMPLEXITY", "CYCLOMATIC_COMPLEXITY"),
    }
    return rows.select(
        *[col(c) for c in rows.columns if c not in new], *[e.alias(n) for n, e in new.items()]
    )


def correlations(rows: DataFrame, columns: list[str], label: str = LABEL) -> DataFrame:
    """Absolute Pearson correlation of each column with the label; constant columns are left out."""
    y = col(label).cast("double")
    parts = []
    for c in columns:
        x = col(c).cast("double")
        both = x.isNotNull() & y.isNotNull()
        xs, ys = F.when(both, x), F.when(both, y)
        varies = (F.min(xs) < F.max(xs)) & (F.min(ys) < F.max(ys))
        # Not F.corr: with a constant column it divides by zero, an error under ANSI rules.
        r = F.try_divide(F.covar_pop(xs, ys), F.stddev_pop(xs) * F.stddev_pop(ys))
        parts.append(F.struct(F.lit(c).alias("feature"), F.when(varies, F.abs(r)).alias("score")))
    return (
        rows.agg(F.array(*parts).alias("_rows"))
        .select(F.inline("_rows"))
        .filter(F.col("score").isNotNull() & ~F.isnan("score"))
    )


def top_features(scores: DataFrame, n: int = 10) -> DataFrame:
    """The n best features; ties by name."""
    return scores.orderBy(F.desc("score"), "feature").limit(n)


def _binned(batches: Iterator[pa.RecordBatch], points: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """(feature, bin, label, n) of a task's rows; a value is in the bin after all points below it, NaN in the last."""
    width = max((len(p) for p in points), default=0) + 1
    sums, kind = {}, None
    for batch in batches:
        labels = batch.column(len(points))
        kind = labels.type
        found = labels.dictionary_encode(null_encoding="encode")
        code, values = found.indices.to_numpy(zero_copy_only=False).astype(np.int64), found.dictionary.to_pylist()
        for i, cuts in enumerate(points):
            at = code * width + np.searchsorted(cuts, batch.column(i).to_numpy(zero_copy_only=False), "left")
            counts = np.bincount(at, minlength=len(values) * width).reshape(len(values), width)
            for value, n in zip(values, counts):
                sums[value, i] = sums.get((value, i), 0) + n
    for (value, i), n in sums.items():
        bins = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(bins), i, np.int32)), pa.array(bins.astype(np.int32)), pa.array([value] * len(bins), kind), pa.array(n[bins])],
            names=["feature", "bin", "_y", "n"],
        )


def mutual_information(
    rows: DataFrame, columns: list[str], label: str = LABEL, bins: int = INFORMATION_BINS, small: int = ROWS_PER_RANGE
) -> DataFrame:
    """Mutual information of each binned column with the label, in nats.

    Bins hold equal shares: cut points are exact quantiles, a handful of
    numbers. One pass then counts (feature, bin, label) in arrays; a task gives
    a bounded table.
    """
    cuts = exact_quantiles(rows, columns, [i / bins for i in range(1, bins)], small)

    points = [np.unique(np.array([p for p in cuts[c] if p is not None], float)) for c in columns]
    kind = rows.select(col(label)).schema[0].dataType.simpleString()
    plain = rows.select(
        *[F.coalesce(col(c).cast("double"), F.lit(0.0)).alias(f"f{i}") for i, c in enumerate(columns)], col(label).alias("_y")
    )
    names = F.array(*[F.lit(c) for c in columns])
    cells = (
        plain.mapInArrow(partial(_binned, points=points), f"feature int, bin int, _y {kind}, n long")
        .groupBy(F.get(names, F.col("feature")).alias("feature"), "bin", "_y")
        .agg(F.sum("n").cast("double").alias("n"))
    )
    # From here on there are at most features x bins x labels rows.
    from pyspark.sql import Window as Win

    total = F.sum("n").over(Win.partitionBy("feature"))
    by_bin = F.sum("n").over(Win.partitionBy("feature", "bin"))
    by_label = F.sum("n").over(Win.partitionBy("feature", "_y"))
    shares = cells.select("feature", "n", total.alias("t"), by_bin.alias("b"), by_label.alias("l"))
    gain = F.col("n") / F.col("t") * F.log(F.col("n") * F.col("t") / (F.col("b") * F.col("l")))
    return shares.groupBy("feature").agg(F.greatest(F.sum(gain), F.lit(0.0)).alias("score"))


def forest_importance(
    rows: DataFrame,
    columns: list[str],
    label: str = LABEL,
    trees: int = FOREST_TREES,
    depth: int = FOREST_DEPTH,
    seed: int = 42,
    even: bool = False,
    small: int = SPARKS_FOREST_ROWS,
) -> DataFrame:
    """Importance of each column in a class-balanced random forest.

    Every level of the trees is a pass over partitions as they come, so rows are dealt out evenly first; ``even`` says
    that they are. Tables of more than ``small`` rows get a forest of their own, grown in the same way with other draws.
    """
    from modrisk.operators.sampling import class_sizes, class_weights, with_class_weights

    sizes = class_sizes(rows, label)
    if sum(sizes.values()) > small and set(sizes) <= {0, 1}:
        w, names = class_weights(rows, label).first(), [f"f{i}" for i in range(len(columns))]
        plain = rows.select(
            *[F.coalesce(col(c).cast("double"), F.lit(0.0)).alias(n) for c, n in zip(columns, names)], col(label).alias("_label")
        )
        scores = forest.importance(plain, names, "_label", (w["weight_0"], w["weight_1"]), sum(sizes.values()), trees, depth, seed)
        return _scores(rows, columns, scores)
    if not even:
        narrow = dealt(rows.select(*[col(c) for c in dict.fromkeys([*columns, label])])).persist()
        found = forest_importance(narrow, columns, label, trees, depth, seed, even=True, small=small)
        narrow.unpersist()
        return found
    weighted = with_class_weights(rows, label)
    # Assembled under plain names, because assembler inputs cannot hold dots or brackets.
    plain = weighted.select(
        *[F.coalesce(col(c).cast("double"), F.lit(0.0)).alias(f"f{i}") for i, c in enumerate(columns)],
        col(label).cast("double").alias("_label"),
        "weight",
    )
    table = VectorAssembler(inputCols=[f"f{i}" for i in range(len(columns))], outputCol="features").transform(plain)
    model = RandomForestClassifier(
        featuresCol="features", labelCol="_label", weightCol="weight", numTrees=trees, maxDepth=depth, seed=seed
    ).fit(table)
    return _scores(rows, columns, model.featureImportances.toArray())


def _scores(rows: DataFrame, columns: list[str], scores) -> DataFrame:
    return rows.sparkSession.createDataFrame(
        [(c, float(scores[i])) for i, c in enumerate(columns)], "feature string, score double"
    )


def union_of_tops(first: DataFrame, second: DataFrame, n: int) -> DataFrame:
    """Features in either top-n, sorted by name."""
    names = top_features(first, n).select("feature").union(top_features(second, n).select("feature"))
    return names.distinct().orderBy("feature")


class FeatureEngineer(Estimator, _Readable):
    """Adds logs, products and ratios, then keeps the union of two top-n selections."""

    keep = Param(Params._dummy(), "keep", "features kept by each selection", TypeConverters.toInt)
    trees = Param(Params._dummy(), "trees", "trees of the selecting forest", TypeConverters.toInt)
    seed = Param(Params._dummy(), "seed", "seed", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, keep: int = 12, trees: int = FOREST_TREES, seed: int = 42):
        super().__init__()
        self._setDefault(keep=12, trees=FOREST_TREES, seed=42)
        self._set(**self._input_kwargs)

    def _fit(self, rows: DataFrame) -> "FeatureEngineerModel":
        logs = log_columns(feature_columns(rows))
        rows = dealt(rows).persist()
        wide = with_ratios(with_products(with_logs(rows, logs)))
        columns = feature_columns(wide)
        n = min(self.getOrDefault(self.keep), len(columns))
        by_information = mutual_information(wide, columns)
        by_forest = forest_importance(
            wide, columns, trees=self.getOrDefault(self.trees), seed=self.getOrDefault(self.seed), even=True
        )
        selected = [r["feature"] for r in union_of_tops(by_information, by_forest, n).collect()]
        rows.unpersist()
        return FeatureEngineerModel(logs=logs, selected=selected)


class FeatureEngineerModel(Model, _Readable):
    logs = Param(Params._dummy(), "logs", "columns to take logs of", TypeConverters.toListString)
    selected = Param(Params._dummy(), "selected", "features kept", TypeConverters.toListString)

    @keyword_only
    def __init__(self, *, logs=None, selected=None):
        super().__init__()
        self._setDefault(logs=[], selected=[])
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, rows: DataFrame) -> DataFrame:
        """Selected features (as far as present) after every column that is not a feature."""
        others = [c for c in rows.columns if c not in feature_columns(rows)]
        wide = with_ratios(with_products(with_logs(rows, self.getOrDefault(self.logs))))
        kept = [c for c in self.getOrDefault(self.selected) if c in wide.columns]
        return wide.select(*[col(c) for c in [*others, *kept]])
