"""Evaluation queries on two deterministic scorers of the labelled documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from modrisk.catalog import query
from modrisk.catalog.tables import draw_sql, rounded
from modrisk.catalog.views import table
from modrisk.functions.draws import draw
from modrisk.operators import evaluation, risk

_SCORED = f"""SELECT row_id, model, label, score, CASE WHEN score >= 0.5 THEN 1 ELSE 0 END AS prediction, loc FROM (
  SELECT doc_id AS row_id, toxic AS label, n_chars AS loc, least(n_chars / 4000.0, 1.0)::DOUBLE AS by_size,
    (floor({draw_sql("'score:' || doc_id")} * 20) / 20.0)::DOUBLE AS by_draw FROM labels JOIN documents USING (doc_id))
  UNPIVOT (score FOR model IN (by_size, by_draw))"""


def scored(spark, sf):
    joined = table(spark, sf, "labels").join(table(spark, sf, "documents").select("doc_id", "n_chars"), "doc_id")
    by_size = F.least(F.col("n_chars") / 4000.0, F.lit(1.0))
    by_draw = F.floor(draw("score", F.col("doc_id")) * 20) / 20.0
    return joined.select(
        F.col("doc_id").alias("row_id"), F.col("toxic").alias("label"), F.col("n_chars").alias("loc"),
        by_size.alias("by_size"), by_draw.alias("by_draw"),
    ).unpivot(["row_id", "label", "loc"], ["by_size", "by_draw"], "model", "score").withColumn(
        "prediction", (F.col("score") >= 0.5).cast("int")
    )


_CELLS = """SELECT model, count(*) FILTER (label = 0 AND prediction = 0) AS tn, count(*) FILTER (label = 0 AND prediction = 1) AS fp,
  count(*) FILTER (label = 1 AND prediction = 0) AS fn, count(*) FILTER (label = 1 AND prediction = 1) AS tp FROM s GROUP BY model"""
_METRICS = """SELECT *, (tp + tn) / (tp + tn + fp + fn) AS accuracy, coalesce(tp / nullif(tp + fp, 0), 0) AS precision, coalesce(tp / nullif(tp + fn, 0), 0) AS recall,
  coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1, coalesce(tn / nullif(tn + fp, 0), 0) AS specificity, coalesce(tn / nullif(tn + fn, 0), 0) AS npv FROM cells"""
_STEPS = """SELECT model, score, pos, neg, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER (PARTITION BY model) AS P, sum(neg) OVER (PARTITION BY model) AS N
  FROM (SELECT model, score, count(*) FILTER (label = 1) AS pos, count(*) FILTER (label = 0) AS neg FROM s GROUP BY ALL)
  WINDOW w AS (PARTITION BY model ORDER BY score DESC ROWS UNBOUNDED PRECEDING)"""
_AREAS = """SELECT model, sum(neg * (tp - pos / 2.0)) / (any_value(P) * any_value(N)) AS roc_auc, sum(pos / P * tp / (tp + fp)) AS avg_precision FROM steps GROUP BY model"""
WITH = f"WITH s AS ({_SCORED}), cells AS ({_CELLS}), met AS ({_METRICS}), steps AS ({_STEPS}), areas AS ({_AREAS})"
NAMES = ["accuracy", "precision", "recall", "f1", "specificity", "npv"]
ROUNDED = ", ".join(f"round({n}, 6)::DOUBLE AS {n}" for n in NAMES)


@query("confusion", f"{WITH} SELECT * FROM cells")
def confusion(spark, sf):
    return evaluation.confusion(scored(spark, sf))


@query("class_metrics", f"{WITH} SELECT model, {ROUNDED} FROM met")
def class_metrics(spark, sf):
    return rounded(evaluation.class_metrics(evaluation.confusion(scored(spark, sf))).select("model", *NAMES), NAMES)


def _report(name: str, p: str, r: str, f: str, n: str) -> str:
    return f"SELECT model, '{name}' AS \"class\", {p} AS precision, {r} AS recall, {f} AS f1, ({n})::BIGINT AS support FROM per"


_PER = """SELECT model, tn, fp, fn, tp, (tn + fp)::DOUBLE AS n0, (tp + fn)::DOUBLE AS n1, (tn + fp + fn + tp)::DOUBLE AS n,
  coalesce(tn / nullif(tn + fn, 0), 0) AS p0, coalesce(tn / nullif(tn + fp, 0), 0) AS r0, coalesce(2 * tn / nullif(2 * tn + fn + fp, 0), 0) AS f0,
  coalesce(tp / nullif(tp + fp, 0), 0) AS p1, coalesce(tp / nullif(tp + fn, 0), 0) AS r1, coalesce(2 * tp / nullif(2 * tp + fn + fp, 0), 0) AS f1 FROM cells"""
_REPORTS = " UNION ALL ".join(
    [
        _report("0", "p0", "r0", "f0", "n0"), _report("1", "p1", "r1", "f1", "n1"),
        _report("accuracy", "(tp + tn) / n", "(tp + tn) / n", "(tp + tn) / n", "n"),
        _report("macro avg", "(p0 + p1) / 2", "(r0 + r1) / 2", "(f0 + f1) / 2", "n"),
        _report("weighted avg", "(p0 * n0 + p1 * n1) / n", "(r0 * n0 + r1 * n1) / n", "(f0 * n0 + f1 * n1) / n", "n"),
    ]
)


@query(
    "class_report",
    f"""{WITH}, per AS ({_PER}) SELECT model, "class", round(precision, 6)::DOUBLE AS precision, round(recall, 6)::DOUBLE AS recall, round(f1, 6)::DOUBLE AS f1, support FROM ({_REPORTS})""",
)
def class_report(spark, sf):
    return rounded(evaluation.class_report(evaluation.confusion(scored(spark, sf))), ["precision", "recall", "f1"])


@query(
    "roc_curve",
    f"""{WITH} SELECT model, round(fp / N, 6)::DOUBLE AS fpr, round(tp / P, 6)::DOUBLE AS tpr, score AS threshold FROM steps
        UNION ALL SELECT DISTINCT model, 0.0::DOUBLE, 0.0::DOUBLE, NULL FROM steps""",
)
def roc_curve(spark, sf):
    return rounded(evaluation.roc_curve(scored(spark, sf)), ["fpr", "tpr"])


@query("roc_auc", f"{WITH} SELECT model, round(roc_auc, 6)::DOUBLE AS roc_auc FROM areas")
def roc_auc(spark, sf):
    return rounded(evaluation.roc_auc(scored(spark, sf)), ["roc_auc"])


@query(
    "pr_curve",
    f"""{WITH} SELECT model, round(tp / (tp + fp), 6)::DOUBLE AS precision, round(tp / P, 6)::DOUBLE AS recall, score AS threshold FROM steps
        UNION ALL SELECT DISTINCT model, 1.0::DOUBLE, 0.0::DOUBLE, NULL FROM steps""",
)
def pr_curve(spark, sf):
    return rounded(evaluation.pr_curve(scored(spark, sf)), ["precision", "recall"])


@query("average_precision", f"{WITH} SELECT model, round(avg_precision, 6)::DOUBLE AS avg_precision FROM areas")
def average_precision(spark, sf):
    return rounded(evaluation.average_precision(scored(spark, sf)), ["avg_precision"])


@query(
    "evaluation",
    f"{WITH} SELECT model, tn, fp, fn, tp, {ROUNDED}, round(roc_auc, 6)::DOUBLE AS roc_auc, round(avg_precision, 6)::DOUBLE AS avg_precision FROM met JOIN areas USING (model)",
)
def evaluated(spark, sf):
    return rounded(evaluation.evaluate(scored(spark, sf)), [*NAMES, "roc_auc", "avg_precision"])


@query(
    "detector_effort",
    f"""WITH s AS ({_SCORED}) SELECT model, round(sum(CASE WHEN prediction = 1 THEN loc ELSE 0 END) / sum(loc), 6)::DOUBLE AS effort,
        round(count(*) FILTER (prediction = 1 AND label = 0) / count(*) FILTER (label = 0), 6)::DOUBLE AS false_alarm_rate FROM s GROUP BY model""",
)
def detector_effort(spark, sf):
    return rounded(evaluation.detector_effort(scored(spark, sf)), ["effort", "false_alarm_rate"])


@query(
    "model_comparison",
    f"""{WITH} SELECT model, metric, round(score, 6) AS score FROM (SELECT model, accuracy::DOUBLE AS accuracy, precision::DOUBLE AS precision, recall::DOUBLE AS recall,
        f1::DOUBLE AS f1, roc_auc::DOUBLE AS roc_auc, specificity::DOUBLE AS specificity FROM met JOIN areas USING (model))
        UNPIVOT (score FOR metric IN (accuracy, precision, recall, f1, roc_auc, specificity))""",
)
def model_comparison(spark, sf):
    return rounded(evaluation.comparison_long(evaluation.evaluate(scored(spark, sf))), ["score"])


@query(
    "leaderboard",
    f"""{WITH} SELECT row_number() OVER (ORDER BY roc_auc DESC, model)::INT AS rank, model, round(accuracy, 4)::DOUBLE AS accuracy, round(precision, 4)::DOUBLE AS precision,
        round(recall, 4)::DOUBLE AS recall, round(f1, 4)::DOUBLE AS f1, round(roc_auc, 4)::DOUBLE AS roc_auc, round(avg_precision, 4)::DOUBLE AS avg_precision
        FROM met JOIN areas USING (model)""",
)
def leaderboard(spark, sf):
    return evaluation.leaderboard(evaluation.evaluate(scored(spark, sf)))


@query("best_model", f"{WITH} SELECT arg_max(model, f1) AS model, round(max(f1), 6)::DOUBLE AS f1 FROM met")
def best_model(spark, sf):
    cells = evaluation.class_metrics(evaluation.confusion(scored(spark, sf))).withColumn("ord", F.length("model"))
    return rounded(evaluation.best_model(cells, "f1"), ["f1"])


@query(
    "averaged_models",
    f"""WITH s AS ({_SCORED}) SELECT row_id, round(avg(score), 6) AS score, count(*) AS models,
        CASE WHEN avg(score) >= 0.5 THEN 'HIGH' WHEN avg(score) >= 0.3 THEN 'MED' ELSE 'LOW' END AS risk_level FROM s GROUP BY row_id""",
)
def averaged_models(spark, sf):
    return rounded(evaluation.averaged_models(scored(spark, sf)), ["score"])


@query(
    "fold_summary",
    f"""WITH s AS (SELECT * REPLACE (model || '#' || (row_id % 5) AS model) FROM ({_SCORED})), cells AS ({_CELLS}), met AS ({_METRICS}), steps AS ({_STEPS}), areas AS ({_AREAS})
        SELECT string_split(model, '#')[1] AS model, round(avg(roc_auc), 6) AS roc_auc_mean, round(avg(f1), 6) AS f1_mean, round(avg(recall), 6) AS recall_mean,
        round(stddev_pop(roc_auc), 6) AS roc_auc_std, round(stddev_pop(f1), 6) AS f1_std, round(stddev_pop(recall), 6) AS recall_std FROM met JOIN areas USING (model) GROUP BY 1""",
)
def fold_summary(spark, sf):
    rows = scored(spark, sf).withColumn("unit", F.concat("model", F.lit("#"), F.col("row_id") % 5))
    per_fold = evaluation.evaluate(rows, "unit").withColumn("model", F.substring_index("unit", "#", 1))
    names = ["roc_auc", "f1", "recall"]
    return rounded(evaluation.fold_summary(per_fold, names), [f"{n}_{k}" for n in names for k in ("mean", "std")])


@query(
    "probability_histogram",
    f"""WITH s AS ({_SCORED}), l AS (SELECT model, score, min(score) OVER (PARTITION BY model) AS lo, max(score) OVER (PARTITION BY model) AS hi FROM s)
        SELECT model, bin, round(lo + bin * w, 6) AS bin_start, round(lo + (bin + 1) * w, 6) AS bin_end, count(*) AS n FROM (
          SELECT model, lo, (hi - lo) / 20.0::DOUBLE AS w, least(floor((score - lo) / ((hi - lo) / 20.0::DOUBLE)), 19)::INT AS bin FROM l) GROUP BY ALL""",
)
def probability_histogram(spark, sf):
    return rounded(risk.histogram(scored(spark, sf), "score", 20, ["model"]), ["bin_start", "bin_end"])
