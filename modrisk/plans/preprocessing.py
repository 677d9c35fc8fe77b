"""Labelled metrics table to train and test tables: clean, split, engineer, scale, rebalance."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from modrisk.operators import cleaning, features, models, sampling
from modrisk.operators.cleaning import LABEL, col

KEY = "_row"


def row_key(rows: DataFrame) -> Column:
    """A key from the values of a row; unique once exact copies are gone."""
    return F.md5(F.to_json(F.struct(*[col(c) for c in rows.columns])))


@dataclass
class Preprocessor:
    """Fits all steps and keeps them for new rows.

    ``fit_clean_on="all"`` learns medians and clip bounds from the whole table;
    ``"train"`` learns them from the training part, which leaks nothing.
    """

    multiplier: float = 3.0
    keep: int = 12
    test_share: float = 0.2
    strategy: str = "smote"
    seed: int = 42
    trees: int = features.FOREST_TREES
    fit_clean_on: str = "all"
    cleaner: object = None
    engineer: object = None
    scaler: object = None
    selected: list[str] = field(default_factory=list)
    report: DataFrame | None = None

    def fit_transform(self, raw: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Model tables (features, label, weight) for training and for testing."""
        rows = cleaning.nan_to_null(cleaning.normalise_label(raw))
        step = cleaning.MetricCleaner(multiplier=self.multiplier)
        prepared = step.prepare(rows)
        keyed = prepared.withColumn(KEY, row_key(prepared)).persist()
        parted = sampling.stratified_split(keyed, KEY, LABEL, self.test_share, self.seed)
        learn_from = keyed if self.fit_clean_on == "all" else parted.filter(~F.col("is_test"))
        self.cleaner = step.fit(learn_from.select(*[col(c) for c in prepared.columns]))
        cleaned = self.cleaner.transform(parted)
        wanted = [KEY, LABEL, "is_test", *cleaning.feature_columns(cleaned)]
        split = cleaned.select(*[col(c) for c in wanted]).persist()
        train, test = split.filter(~F.col("is_test")), split.filter("is_test")

        self.engineer = features.FeatureEngineer(keep=self.keep, trees=self.trees, seed=self.seed).fit(
            train.drop(KEY, "is_test")
        )
        train, test = self.engineer.transform(train), self.engineer.transform(test)
        self.selected = [c for c in self.engineer.getOrDefault("selected") if c in train.columns]
        self.scaler = models.PopulationScaler(columns=self.selected).fit(train)
        train, test = self.scaler.transform(train), self.scaler.transform(test)
        train = self._rebalance(train)
        tables = models.model_table(train, self.selected), models.model_table(test, self.selected, keep=[KEY])
        self.report = self._report(raw, cleaned, *tables)
        return tables

    def _rebalance(self, train: DataFrame) -> DataFrame:
        if self.strategy == "none":
            return train
        keyed = train.select(
            F.xxhash64(KEY).alias("_id"), LABEL,
            F.array(*[F.coalesce(col(c).cast("double"), F.lit(0.0)) for c in self.selected]).alias("_x"),
        ).persist()
        full = sampling.rebalanced(keyed, "_id", "_x", LABEL, self.strategy, seed=self.seed)
        return full.select(
            *[F.get("_x", F.lit(i)).alias(c) for i, c in enumerate(self.selected)], LABEL
        )

    def transform_new(self, rows: DataFrame, *keep: str) -> DataFrame:
        """Feature vectors of new rows through the fitted steps."""
        ready = self.scaler.transform(self.engineer.transform(self.cleaner.transform(rows)))
        values = [
            F.coalesce(col(c).cast("double"), F.lit(0.0)) if c in ready.columns else F.lit(0.0)
            for c in self.selected
        ]
        return ready.select(*keep, array_to_vector(F.array(*values)).alias("features"))

    def _report(self, raw: DataFrame, cleaned: DataFrame, train: DataFrame, test: DataFrame) -> DataFrame:
        """One row on sizes, defect rates, selected features and class weights."""
        named = cleaning.normalise_label(raw)
        before = named.agg(F.count(F.lit(1)).alias("raw_rows"), F.avg(LABEL).alias("raw_defect_rate"))
        after = cleaned.agg(F.count(F.lit(1)).alias("clean_rows"))
        learned = train.agg(
            F.count(F.lit(1)).alias("train_size"), F.avg("label").alias("train_defect_rate"),
            F.max(F.when(F.col("label") == 0, F.col("weight"))).alias("_w0"),
            F.max(F.when(F.col("label") == 1, F.col("weight"))).alias("_w1"),
        )
        held = test.agg(F.count(F.lit(1)).alias("test_size"), F.avg("label").alias("test_defect_rate"))
        parts = [f.first().asDict() for f in (before, after, learned, held)]
        merged = {k: v for part in parts for k, v in part.items()}
        # cleaned carries a key and the split flag besides the data columns
        row = (
            merged["raw_rows"], len(raw.columns), merged["clean_rows"], len(cleaned.columns) - 2,
            merged["raw_defect_rate"], merged["train_size"], merged["test_size"],
            merged["train_defect_rate"], merged["test_defect_rate"], len(self.selected), self.selected,
            {"0": merged["_w0"] or 1.0, "1": merged["_w1"] or 1.0}, self.strategy,
        )
        return raw.sparkSession.createDataFrame(
            [row],
            "raw_rows long, raw_columns int, clean_rows long, clean_columns int, raw_defect_rate double, "
            "train_size long, test_size long, train_defect_rate double, test_defect_rate double, "
            "n_features int, selected_features array<string>, class_weights map<string,double>, "
            "imbalance_strategy string",
        )


def with_folds(table: DataFrame, folds: int = 5, seed: int = 42) -> DataFrame:
    """Stratified folds of a model table, keyed by the values of its rows."""
    keyed = table.withColumn(
        KEY, F.md5(F.concat_ws(",", vector_to_array("features").cast("array<string>"), F.col("label").cast("string")))
    )
    return sampling.stratified_folds(keyed, KEY, "label", folds, seed).drop(KEY)
