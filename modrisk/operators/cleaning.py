"""Cleaning of module-metrics tables: labels, integrity, filling, clipping, pruning."""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, functions as F, types as T

from modrisk.functions.ordered import ROWS_PER_RANGE, exact_quantiles

# Column names with a special role.
LABEL = "LABEL"
LABEL_NAMES = {"label", "defects", "problems"}
TRUE_WORDS = ["1", "true", "yes"]
NOT_FEATURES = {
    "unique_id", "id", "module", "module_name", "file_name", "file_path", "label", "defects", "problems",
}
LINE_COUNT_COLUMNS = ["loc", "locode", "lOCode", "loc_total", "loc_executable"]


def col(name: str) -> Column:
    """Column by exact name; names like ``v(g)`` need the back-ticks."""
    return F.col(f"`{name}`")


def normalise_label(rows: DataFrame) -> DataFrame:
    """Rename the first label column to LABEL and map its text to 0/1."""
    found = [c for c in rows.columns if c.lower() in LABEL_NAMES]
    if not found:
        raise ValueError(f"no label column among {rows.columns}")
    value = F.lower(F.trim(col(found[0]).cast("string"))).isin(*TRUE_WORDS)
    return rows.select(
        *[
            F.coalesce(value, F.lit(False)).cast("int").alias(LABEL) if c == found[0] else col(c)
            for c in rows.columns
        ]
    )


def numeric_columns(rows: DataFrame, but: set[str] = frozenset()) -> list[str]:
    return [f.name for f in rows.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in but]


def feature_columns(rows: DataFrame) -> list[str]:
    """Numeric columns that are neither identifiers nor labels."""
    return [c for c in numeric_columns(rows) if c.lower() not in NOT_FEATURES]


def features_only(rows: DataFrame) -> DataFrame:
    return rows.select(*[col(c) for c in feature_columns(rows)])


def nan_to_null(rows: DataFrame) -> DataFrame:
    """NaN counts as missing; Spark's order statistics would treat it as a value."""
    floating = {f.name for f in rows.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    return rows.select(*[F.nanvl(col(c), F.lit(None)).alias(c) if c in floating else col(c) for c in rows.columns])


def drop_exact_duplicates(rows: DataFrame) -> DataFrame:
    """Distinct rows; copies collapse on the map side before the shuffle."""
    return rows.dropDuplicates()


def integrity_filter(rows: DataFrame) -> DataFrame:
    """Every line-count column that is present must be above zero."""
    kept = rows
    for name in LINE_COUNT_COLUMNS:
        if name in rows.columns:
            kept = kept.filter(col(name) > 0)
    return kept


def medians(rows: DataFrame, columns: list[str], small: int = ROWS_PER_RANGE) -> dict[str, float]:
    found = exact_quantiles(rows, columns, [0.5], small)
    return {c: q[0] for c, q in found.items() if q[0] is not None}


def fill_missing(rows: DataFrame, values: dict[str, float]) -> DataFrame:
    """NULLs become the given values; whole-number columns stay whole when they can."""
    whole = {f.name for f in rows.schema.fields if isinstance(f.dataType, T.IntegralType)}

    def filled(name: str) -> Column:
        value = values[name]
        if name in whole and float(value).is_integer():
            return F.coalesce(col(name), F.lit(int(value))).alias(name)
        return F.coalesce(col(name).cast("double"), F.lit(float(value))).alias(name)

    return rows.select(*[filled(c) if c in values else col(c) for c in rows.columns])


def clip_bounds(
    rows: DataFrame, columns: list[str], multiplier: float = 3.0, small: int = ROWS_PER_RANGE
) -> dict[str, tuple[float, float]]:
    """Quartiles widened by a multiple of their distance."""
    bounds = {}
    for name, (q1, q3) in exact_quantiles(rows, columns, [0.25, 0.75], small).items():
        if q1 is not None:
            spread = q3 - q1
            bounds[name] = (q1 - multiplier * spread, q3 + multiplier * spread)
    return bounds


def clipped(rows: DataFrame, bounds: dict[str, tuple[float, float]]) -> DataFrame:
    """Values limited to their bounds; NULL stays NULL."""
    def one(name: str) -> Column:
        low, high = bounds[name]
        value = col(name).cast("double")
        limited = F.least(F.greatest(value, F.lit(low)), F.lit(high))
        return F.when(value.isNotNull(), limited).alias(name)

    return rows.select(*[one(c) if c in bounds else col(c) for c in rows.columns])


def constant_columns(rows: DataFrame, columns: list[str]) -> list[str]:
    """Columns with at most one distinct value: minimum equals maximum, or all NULL."""
    if not columns:
        return []
    row = rows.agg(
        *[
            F.coalesce(F.min(col(c)) == F.max(col(c)), F.lit(True)).alias(f"c{i}")
            for i, c in enumerate(columns)
        ]
    ).first()
    return [c for i, c in enumerate(columns) if row[f"c{i}"]]


def describe(rows: DataFrame, columns: list[str] | None = None, small: int = ROWS_PER_RANGE) -> DataFrame:
    """Count, mean, sample deviation, minimum, quartiles, maximum and missing count per column."""
    columns = columns or numeric_columns(rows)
    quartiles = exact_quantiles(rows, columns, [0.25, 0.5, 0.75], small)
    parts = []
    for c in columns:
        x = col(c).cast("double")
        parts.append(
            F.struct(
                F.lit(c).alias("column"),
                F.count(x).alias("count"),
                F.avg(x).alias("mean"),
                F.stddev_samp(x).alias("std"),
                F.min(x).alias("min"),
                *[F.lit(q).cast("double").alias(n) for n, q in zip(["q25", "q50", "q75"], quartiles[c])],
                F.max(x).alias("max"),
                F.count_if(x.isNull()).alias("missing"),
            )
        )
    return rows.agg(F.array(*parts).alias("_rows")).select(F.inline("_rows"))


def missing_counts(rows: DataFrame) -> DataFrame:
    parts = [
        F.struct(F.lit(c).alias("column"), F.count_if(col(c).isNull()).alias("missing")) for c in rows.columns
    ]
    return rows.agg(F.array(*parts).alias("_rows")).select(F.inline("_rows"))


def label_summary(rows: DataFrame, label: str = LABEL) -> DataFrame:
    """One row: row count, positives and their share."""
    return rows.agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(col(label)).cast("long").alias("positives"),
        F.avg(col(label)).alias("positive_rate"),
    )


def label_counts(rows: DataFrame, label: str = LABEL) -> DataFrame:
    return rows.groupBy(col(label).alias(label)).agg(F.count(F.lit(1)).alias("rows"))


class _Readable(DefaultParamsReadable, DefaultParamsWritable):
    """Fitted values are params, so the default reader and writer keep them."""


class MetricCleaner(Estimator, _Readable):
    """Learns medians, clip bounds and constant columns of a metrics table."""

    multiplier = Param(Params._dummy(), "multiplier", "quartile distance multiple", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, multiplier: float = 3.0):
        super().__init__()
        self._setDefault(multiplier=3.0)
        self._set(**self._input_kwargs)

    def prepare(self, rows: DataFrame) -> DataFrame:
        """The row-dropping steps, which apply to training data only."""
        return integrity_filter(drop_exact_duplicates(rows))

    def _fit(self, rows: DataFrame) -> "MetricCleanerModel":
        """Fits on rows that went through :meth:`prepare`; several passes, so they are cached."""
        rows = rows.persist()
        numeric = numeric_columns(rows)
        fill = medians(rows, numeric)
        filled = fill_missing(rows, fill)
        measured = [c for c in numeric if c != LABEL]
        bounds = clip_bounds(filled, measured, self.getOrDefault(self.multiplier))
        dropped = constant_columns(clipped(filled, bounds), measured)
        rows.unpersist()
        return MetricCleanerModel(fill=fill, bounds={k: list(v) for k, v in bounds.items()}, dropped=dropped)


class MetricCleanerModel(Model, _Readable):
    fill = Param(Params._dummy(), "fill", "median per column")
    bounds = Param(Params._dummy(), "bounds", "low and high per column")
    dropped = Param(Params._dummy(), "dropped", "constant columns", TypeConverters.toListString)

    @keyword_only
    def __init__(self, *, fill=None, bounds=None, dropped=None):
        super().__init__()
        self._setDefault(fill={}, bounds={}, dropped=[])
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, rows: DataFrame) -> DataFrame:
        kept = fill_missing(rows, {c: v for c, v in self.getOrDefault(self.fill).items() if c in rows.columns})
        bounds = {c: tuple(v) for c, v in self.getOrDefault(self.bounds).items() if c in rows.columns}
        dropped = set(self.getOrDefault(self.dropped))
        limited = clipped(kept, bounds)
        return limited.select(*[col(c) for c in limited.columns if c not in dropped])


def clean(rows: DataFrame, multiplier: float = 3.0) -> tuple[DataFrame, MetricCleanerModel]:
    """All cleaning steps in order, with the fitted model."""
    cleaner = MetricCleaner(multiplier=multiplier)
    prepared = cleaner.prepare(rows)
    model = cleaner.fit(prepared)
    return model.transform(prepared), model
