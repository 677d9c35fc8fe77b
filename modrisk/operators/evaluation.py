"""Evaluation of scored rows: (row_id, model, label, score, prediction).

Curves and areas aggregate to distinct scores first and take running totals
over ranges of the score, so no task ever holds all scores of a model.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as Win, functions as F

from modrisk.functions.bands import band
from modrisk.functions.ordered import ROWS_PER_RANGE, running_totals

# Columns of a comparison and of a leaderboard, and their decimals.
COMPARED = ["accuracy", "precision", "recall", "f1", "roc_auc", "specificity"]
LEADERBOARD_METRICS = [
    "accuracy", "precision", "recall", "f1", "roc_auc", "avg_precision", "cv_roc_auc_mean", "cv_roc_auc_std",
]


def _ratio(top: Column, bottom: Column) -> Column:
    return F.coalesce(F.try_divide(top.cast("double"), bottom.cast("double")), F.lit(0.0))


def confusion(scored: DataFrame, *by: str) -> DataFrame:
    """tn, fp, fn, tp per group; one map-side-combined aggregate."""
    y, p = F.col("label"), F.col("prediction")
    return scored.groupBy(*(by or ("model",))).agg(
        F.count_if((y == 0) & (p == 0)).alias("tn"),
        F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 1) & (p == 0)).alias("fn"),
        F.count_if((y == 1) & (p == 1)).alias("tp"),
    )


def class_metrics(cells: DataFrame) -> DataFrame:
    """Accuracy, precision, recall, F1, specificity and NPV; 0 where undefined."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    return cells.select(
        "*",
        _ratio(tp + tn, tp + tn + fp + fn).alias("accuracy"),
        _ratio(tp, tp + fp).alias("precision"),
        _ratio(tp, tp + fn).alias("recall"),
        _ratio(tp * 2, tp * 2 + fp + fn).alias("f1"),
        _ratio(tn, tn + fp).alias("specificity"),
        _ratio(tn, tn + fn).alias("npv"),
    )


def class_report(cells: DataFrame, by: str = "model") -> DataFrame:
    """Precision, recall, F1 and support per class, with macro and weighted averages."""
    tn, fp, fn, tp = (F.col(c).cast("double") for c in ("tn", "fp", "fn", "tp"))
    n0, n1 = tn + fp, tp + fn

    def scores(hit: Column, wrong: Column, missed: Column) -> tuple[Column, Column, Column]:
        return _ratio(hit, hit + wrong), _ratio(hit, hit + missed), _ratio(hit * 2, hit * 2 + wrong + missed)

    zero, one = scores(tn, fn, fp), scores(tp, fp, fn)

    def row(name: str, values, support: Column) -> Column:
        return F.struct(
            F.lit(name).alias("class"),
            *[v.alias(n) for n, v in zip(("precision", "recall", "f1"), values)],
            support.cast("long").alias("support"),
        )

    macro = [(a + b) / 2 for a, b in zip(zero, one)]
    weighted = [_ratio(a * n0 + b * n1, n0 + n1) for a, b in zip(zero, one)]
    accuracy = _ratio(tp + tn, n0 + n1)
    return cells.select(
        by,
        F.inline(
            F.array(
                row("0", zero, n0),
                row("1", one, n1),
                row("accuracy", [accuracy] * 3, n0 + n1),
                row("macro avg", macro, n0 + n1),
                row("weighted avg", weighted, n0 + n1),
            )
        ),
    )


def _steps(scored: DataFrame, by: str, rows_per_range: int) -> DataFrame:
    """Per distinct score, from high to low: own and running positives and negatives."""
    per_score = scored.groupBy(by, "score").agg(
        F.count_if(F.col("label") == 1).alias("pos"), F.count_if(F.col("label") == 0).alias("neg")
    ).persist()
    return running_totals(
        per_score, [by], "score", {"tp": "pos", "fp": "neg"}, descending=True,
        rows_per_range=rows_per_range, group_totals={"P": "pos", "N": "neg"},
    )


def roc_curve(scored: DataFrame, by: str = "model", rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """(fpr, tpr, threshold) at every distinct score, and the point (0, 0)."""
    steps = _steps(scored, by, rows_per_range)
    points = steps.select(
        by,
        F.try_divide(F.col("fp").cast("double"), F.col("N")).alias("fpr"),
        F.try_divide(F.col("tp").cast("double"), F.col("P")).alias("tpr"),
        F.col("score").alias("threshold"),
    )
    start = scored.groupBy(by).agg(
        F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"), F.lit(None).cast("double").alias("threshold")
    )
    return points.unionByName(start)


def roc_auc(scored: DataFrame, by: str = "model", rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Area under the ROC curve, ties counting one half; NULL with a single class."""
    pairs = F.col("neg") * (F.col("tp") - F.col("pos") / F.lit(2.0))
    return (
        _steps(scored, by, rows_per_range)
        .groupBy(by)
        .agg(
            F.try_divide(
                F.sum(pairs), F.any_value("P").cast("double") * F.any_value("N").cast("double")
            ).alias("roc_auc")
        )
    )


def pr_curve(scored: DataFrame, by: str = "model", rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """(precision, recall, threshold) at every distinct score, and the end point (1, 0)."""
    points = _steps(scored, by, rows_per_range).select(
        by,
        F.try_divide(F.col("tp").cast("double"), F.col("tp") + F.col("fp")).alias("precision"),
        F.try_divide(F.col("tp").cast("double"), F.col("P")).alias("recall"),
        F.col("score").alias("threshold"),
    )
    end = scored.groupBy(by).agg(
        F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall"), F.lit(None).cast("double").alias("threshold")
    )
    return points.unionByName(end)


def average_precision(scored: DataFrame, by: str = "model", rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Step-wise sum of precision times gain in recall (not the trapezoid)."""
    gain = F.try_divide(F.col("pos").cast("double"), F.col("P")) * F.try_divide(
        F.col("tp").cast("double"), F.col("tp") + F.col("fp")
    )
    return _steps(scored, by, rows_per_range).groupBy(by).agg(F.coalesce(F.sum(gain), F.lit(0.0)).alias("avg_precision"))


def evaluate(scored: DataFrame, by: str = "model", rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """All scores of every model on one row each."""
    steps = _steps(scored, by, rows_per_range)
    tp, fp = F.col("tp").cast("double"), F.col("fp").cast("double")
    areas = steps.groupBy(by).agg(
        F.try_divide(
            F.sum(F.col("neg") * (F.col("tp") - F.col("pos") / F.lit(2.0))),
            F.any_value("P").cast("double") * F.any_value("N").cast("double"),
        ).alias("roc_auc"),
        F.coalesce(
            F.sum(F.try_divide(F.col("pos").cast("double"), F.col("P")) * F.try_divide(tp, tp + fp)), F.lit(0.0)
        ).alias("avg_precision"),
    )
    return class_metrics(confusion(scored, by)).join(F.broadcast(areas), by)


def detector_effort(scored: DataFrame, loc: str = "loc", by: str = "model") -> DataFrame:
    """Share of code in flagged modules, and the false-alarm rate."""
    flagged = F.col("prediction") == 1
    fp = F.count_if(flagged & (F.col("label") == 0))
    negatives = F.count_if(F.col("label") == 0)
    return scored.groupBy(by).agg(
        _ratio(F.sum(F.when(flagged, F.col(loc)).otherwise(0)), F.sum(loc)).alias("effort"),
        _ratio(fp, negatives).alias("false_alarm_rate"),
    )


def fold_summary(fold_scores: DataFrame, metrics: list[str], by: str = "model") -> DataFrame:
    """Mean and population deviation over folds; NULL when a fold has no value."""
    def whole(m: str, value: Column) -> Column:
        return F.when(F.count(m) == F.count(F.lit(1)), value)

    return fold_scores.groupBy(by).agg(
        *[whole(m, F.avg(m)).alias(f"{m}_mean") for m in metrics],
        *[whole(m, F.stddev_pop(m)).alias(f"{m}_std") for m in metrics],
    )


def comparison(metrics: DataFrame, by: str = "model") -> DataFrame:
    return metrics.select(by, *COMPARED)


def comparison_long(metrics: DataFrame, by: str = "model") -> DataFrame:
    """One row per model and metric, for grouped views."""
    return comparison(metrics, by).unpivot([by], COMPARED, "metric", "score")


def leaderboard(metrics: DataFrame, sort_by: str = "roc_auc", by: str = "model") -> DataFrame:
    """Models ranked from 1 by a metric, rounded; a model is one row, so there are few."""
    rounded = [F.round(c, 4).alias(c) for c in LEADERBOARD_METRICS if c in metrics.columns]
    if "train_time_s" in metrics.columns:
        rounded.append(F.round("train_time_s", 2).alias("train_time_s"))
    order = Win.orderBy(F.desc(sort_by), by)
    return metrics.select(F.row_number().over(order).alias("rank"), by, *rounded)


def best_model(metrics: DataFrame, metric: str = "roc_auc", by: str = "model", order: str = "ord") -> DataFrame:
    """Name of the best model; the first one wins a tie."""
    return metrics.agg(
        F.max_by(by, F.struct(F.coalesce(F.col(metric), F.lit(0.0)), -F.col(order))).alias("model"),
        F.max(F.coalesce(F.col(metric), F.lit(0.0))).alias(metric),
    )


def averaged_models(scored: DataFrame, key: str = "row_id", scale: str = "analysis") -> DataFrame:
    """Mean score of all models per row, with its band."""
    return (
        scored.groupBy(key)
        .agg(F.avg("score").alias("score"), F.count(F.lit(1)).alias("models"))
        .withColumn("risk_level", band(F.col("score"), scale))
    )
