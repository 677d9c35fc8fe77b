"""Report rows and exports; large parts stay distributed and are written by tasks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from modrisk.functions.bands import band
from modrisk.operators.cleaning import LABEL

RULE = "=" * 60
THIN_RULE = "-" * 60


def risk_csv_rows(risks: DataFrame) -> DataFrame:
    """file, LOC, CC, functions, classes, score in percent with one decimal, level."""
    return risks.select(
        F.col("path").alias("file"), F.col("loc").alias("LOC"), F.col("cc").alias("CC"),
        F.col("funcs").alias("functions"), "classes",
        F.format_string("%.1f", F.col("risk_score") * 100).alias("risk_score"),
        band(F.col("risk_score"), "analysis").alias("risk_level"),
    )


def write_risk_csv(risks: DataFrame, path: str) -> None:
    risk_csv_rows(risks).write.mode("overwrite").option("header", True).csv(path)


def _constant(text: str) -> Column:
    return F.lit(text)


def text_report_rows(risks: DataFrame, summary: DataFrame, generated: str) -> DataFrame:
    """(section, score, path, part, line) rows of the text report in reading order.

    Sorted by section, falling score, path and part.
    """
    score, none = F.col("risk_score"), F.lit(None)
    head = summary.select(
        F.posexplode(
            F.array(
                _constant(RULE), _constant("MODULE RISK REPORT"), _constant(RULE),
                _constant(f"Generated: {generated}"), _constant(""),
                F.format_string("Total Files: %d", "files"),
                F.format_string("Total LOC: %d", "total_loc"),
                F.format_string("Avg Risk: %.1f%%", F.col("avg_risk") * 100),
                F.format_string("High: %d  Med: %d  Safe: %d", "high", "med", "low"),
                _constant(""), _constant("FILE RISK ASSESSMENT"), _constant(THIN_RULE),
            )
        ).alias("part", "line")
    ).select(F.lit(0).alias("section"), none.cast("double").alias("score"), none.cast("string").alias("path"), "part", "line")
    first = F.format_string("  %-40s %5.1f%%  [%s]", "path", score * 100, band(score, "analysis"))
    second = F.format_string("    CC=%d  LOC=%d  Funcs=%d", "cc", "loc", "funcs")
    body = risks.select(
        F.lit(1).alias("section"), score.alias("score"), "path",
        F.posexplode(F.array(first, second)).alias("part", "line"),
    )
    foot = summary.select(
        F.lit(2).alias("section"), none.cast("double").alias("score"), none.cast("string").alias("path"),
        F.posexplode(F.array(_constant(""), _constant(RULE))).alias("part", "line"),
    )
    return head.unionByName(body).unionByName(foot).orderBy("section", F.desc("score"), "path", "part")


def write_text_report(risks: DataFrame, summary: DataFrame, generated: str, path: str) -> None:
    text_report_rows(risks, summary, generated).select("line").write.mode("overwrite").text(path)


def json_rows(risks: DataFrame) -> DataFrame:
    """One nested record per file."""
    return risks.select(
        F.col("path").alias("name"),
        F.struct("loc", "funcs", "classes", "cc", "decisions", "comment_ratio").alias("metrics"),
        "risk_score",
        band(F.col("risk_score"), "analysis").alias("risk_level"),
    )


def write_json(risks: DataFrame, summary: DataFrame, path: str) -> None:
    """``files`` and ``summary`` as JSON lines below the path."""
    json_rows(risks).write.mode("overwrite").json(f"{path}/files")
    summary.withColumn("exported_at", F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss")).write.mode(
        "overwrite"
    ).json(f"{path}/summary")


def evaluation_report_rows(metrics: DataFrame) -> DataFrame:
    """(model, part, line) rows: scores and confusion cells of each model."""
    def scored(title: str, name: str) -> Column:
        return F.format_string(f"- {title} %.4f", F.col(name))

    return metrics.select(
        "model",
        F.posexplode(
            F.array(
                F.concat(F.lit(">>> "), F.upper("model")),
                scored("Accuracy:", "accuracy"), scored("Precision:", "precision"), scored("Recall:", "recall"),
                scored("F1:", "f1"), scored("ROC-AUC:", "roc_auc"),
                F.format_string("  True Neg: %d", "tn"), F.format_string("  False Pos: %d", "fp"),
                F.format_string("  False Neg: %d", "fn"), F.format_string("  True Pos: %d", "tp"),
            )
        ).alias("part", "line"),
    ).orderBy("model", "part")


def write_evaluation_report(metrics: DataFrame, path: str) -> None:
    evaluation_report_rows(metrics).select("line").write.mode("overwrite").text(path)


def write_predictions(predictions: DataFrame, path: str, kind: str = "csv") -> None:
    """Prediction table as comma or tab separated text."""
    separator = "," if kind == "csv" else "\t"
    predictions.write.mode("overwrite").option("header", True).option("sep", separator).csv(path)


def summary_report_rows(data: DataFrame, metrics: DataFrame) -> DataFrame:
    """(part, line) rows on the data set and its best model by ROC-AUC."""
    about = data.agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(LABEL), F.lit(0)).cast("long").alias("bad"),
        F.coalesce(F.avg(LABEL), F.lit(0.0)).alias("rate"),
    )
    best = metrics.agg(
        F.max_by(F.struct("model", "roc_auc", "f1", "accuracy"), "roc_auc").alias("b")
    )
    first = about.select(
        F.posexplode(
            F.array(
                F.format_string("Samples: %d", "n"), F.format_string("Defective: %d", "bad"),
                F.format_string("Defect rate: %.2f%%", F.col("rate") * 100),
                F.lit(f"Features: {len(data.columns) - 1}"),
            )
        ).alias("part", "line")
    )
    second = best.select(
        F.posexplode(
            F.array(
                F.concat(F.lit("Best model: "), F.col("b.model")),
                F.format_string("ROC-AUC: %.4f", "b.roc_auc"), F.format_string("F1: %.4f", "b.f1"),
                F.format_string("Accuracy: %.4f", "b.accuracy"),
            )
        ).alias("part", "line")
    ).withColumn("part", F.col("part") + 4)
    return first.unionByName(second).orderBy("part")


def write_summary_report(data: DataFrame, metrics: DataFrame, path: str) -> None:
    summary_report_rows(data, metrics).select("line").write.mode("overwrite").text(path)
