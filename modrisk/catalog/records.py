"""Queries on history tables and report rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from modrisk.catalog import query
from modrisk.catalog.corpus import risks_of, with_file_risk
from modrisk.catalog.scores import WITH as SCORES_WITH, scored
from modrisk.catalog.tables import metrics, rounded, _METRICS
from modrisk.catalog.views import table
from modrisk.operators import evaluation, history, reports, risk

# Users stand for sessions, their events for session rows.
_SESSIONS = """SELECT user_id AS session_id, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS timestamp, count(*) AS files_count,
  count(DISTINCT event_type) AS kinds FROM events GROUP BY user_id"""


def sessions(spark, sf):
    return table(spark, sf, "events").groupBy(F.col("user_id").alias("session_id")).agg(
        history.stamp(F.max("ts")).alias("timestamp"), F.count(F.lit(1)).alias("files_count"),
        F.count_distinct("event_type").alias("kinds"),
    )


@query("recent_sessions", f"SELECT * FROM ({_SESSIONS}) ORDER BY timestamp DESC, session_id LIMIT 5")
def recent_sessions(spark, sf):
    return history.newest_first(sessions(spark, sf), 5, tie="session_id")


@query("session_count", "SELECT count(DISTINCT user_id) AS sessions FROM events")
def session_count(spark, sf):
    return history.session_count(sessions(spark, sf))


@query(
    "session_metrics",
    """SELECT 's1' AS session_id, coalesce(p_name, 'unknown') AS file_name, p_size::BIGINT AS "LOC", 0::BIGINT AS "LOC_BLANK", round(p_retailprice)::BIGINT AS "LOC_TOTAL",
       round(p_retailprice / 1000, 6) AS "COMMENT_RATIO", 0::BIGINT AS "LABEL" FROM part""",
)
def session_metrics(spark, sf):
    rows = table(spark, sf, "part").select(
        F.col("p_name").alias("file_name"), F.col("p_size").alias("LOC"), F.round("p_retailprice").alias("LOC_TOTAL"),
        F.round(F.col("p_retailprice") / 1000, 6).alias("COMMENT_RATIO"),
    )
    return history.session_metrics("s1", rows).select(
        "session_id", "file_name", "LOC", "LOC_BLANK", "LOC_TOTAL", "COMMENT_RATIO", "LABEL"
    )


@query(
    "session_detail",
    f"""WITH s AS ({_SESSIONS}), c AS (SELECT user_id AS session_id, 'metric' AS kind, event_id::VARCHAR AS name, value FROM events WHERE event_type <> 'view'
          UNION ALL SELECT user_id, 'prediction', event_type, value FROM events WHERE event_type = 'view')
        SELECT s.session_id, files_count, kind, name, round(value, 6) AS value FROM s LEFT JOIN c USING (session_id)""",
)
def session_detail(spark, sf):
    events = table(spark, sf, "events")
    child = events.select(
        F.col("user_id").alias("session_id"), F.col("event_id").cast("string").alias("file_name"), "value", "event_type"
    )
    measured = child.filter("event_type <> 'view'").drop("event_type")
    predicted = child.filter("event_type = 'view'").select("session_id", F.col("event_type").alias("model_name"), "value")
    rows = history.session_details(sessions(spark, sf), measured, predicted)
    value = F.get_json_object("values", "$.value").cast("double")
    return rows.select("session_id", "files_count", "kind", "name", F.round(value, 6).alias("value"))


@query(
    "delete_sessions",
    "SELECT event_id, user_id FROM events WHERE user_id NOT IN (SELECT user_id FROM events GROUP BY user_id HAVING count(*) FILTER (event_type = 'error') > 13)",
)
def delete_sessions(spark, sf):
    events = table(spark, sf, "events")
    gone = events.groupBy("user_id").agg(F.count_if(F.col("event_type") == "error").alias("n")).filter("n > 13")
    return history.without(events, gone, "user_id").select("event_id", "user_id")


@query(
    "conversation_log",
    """SELECT conv_id, turn, role, text FROM conversations""",
)
def conversation_log(spark, sf):
    return history.message_log(table(spark, sf, "conversations"), None, "conv_id", "turn", "turn")


@query(
    "conversation_messages",
    """SELECT c.conv_id, c.turns, m.turn, m.role, m.text
       FROM (SELECT conv_id, count(*) AS turns FROM conversations GROUP BY conv_id) c LEFT JOIN conversations m USING (conv_id)""",
)
def conversation_messages(spark, sf):
    messages = table(spark, sf, "conversations")
    heads = messages.groupBy("conv_id").agg(F.count(F.lit(1)).alias("turns"))
    joined = history.conversations_with_messages(heads, messages, "conv_id")
    return history.message_log(joined, None, "conv_id", "turn", "role").select("conv_id", "turns", "turn", "role", "text")


@query(
    "conversation_state",
    """SELECT conv_id, arg_max(role, turn) AS role, arg_max(text, turn) FILTER (role <> 'user') AS answer, min(turn) AS turn FROM conversations GROUP BY conv_id""",
)
def conversation_state(spark, sf):
    events = table(spark, sf, "conversations").select(
        "conv_id", "turn", "role", F.when(F.col("role") != "user", F.col("text")).alias("answer"),
        F.col("turn").alias("version"),
    )
    return history.current_state(events, "conv_id", "turn", "version").select("conv_id", "role", "answer", "turn")


# ---- reports --------------------------------------------------------------

_LEVEL = "CASE WHEN risk_score >= 0.5 THEN 'HIGH' WHEN risk_score >= 0.3 THEN 'MED' ELSE 'LOW' END"


@query(
    "risk_csv",
    with_file_risk(
        f"""SELECT path AS file, loc AS "LOC", cc AS "CC", funcs AS functions, classes, printf('%.1f', risk_score * 100) AS risk_score, {_LEVEL} AS risk_level FROM fr"""
    ),
)
def risk_csv(spark, sf):
    return reports.risk_csv_rows(risks_of(spark, sf))


@query(
    "text_report",
    with_file_risk(
        f"""SELECT 1 AS section, path, 0 AS part, printf('  %-40s %5.1f%%  [%s]', path, risk_score * 100, {_LEVEL}) AS line FROM fr
            UNION ALL SELECT 1, path, 1, printf('    CC=%d  LOC=%d  Funcs=%d', cc, loc, funcs) FROM fr
            UNION ALL SELECT 0, NULL, 5, 'Total Files: ' || count(*) FROM fr UNION ALL SELECT 0, NULL, 6, 'Total LOC: ' || sum(loc) FROM fr
            UNION ALL SELECT 0, NULL, 8, printf('High: %d  Med: %d  Safe: %d', count(*) FILTER (risk_score >= 0.5),
              count(*) FILTER (risk_score >= 0.3 AND risk_score < 0.5), count(*) FILTER (risk_score < 0.3)) FROM fr"""
    ),
)
def text_report(spark, sf):
    risks = risks_of(spark, sf)
    rows = reports.text_report_rows(risks, risk.workspace_summary(risks), "")
    counted = (F.col("section") == 1) | ((F.col("section") == 0) & F.col("part").isin(5, 6, 8))
    return rows.filter(counted).select("section", "path", "part", "line")


@query(
    "json_export",
    with_file_risk(
        f"""SELECT path AS name, loc, cc, funcs, classes, decisions, round(risk_score, 6) AS risk_score, {_LEVEL} AS risk_level FROM fr"""
    ),
)
def json_export(spark, sf):
    return reports.json_rows(risks_of(spark, sf)).select(
        "name", *[F.col(f"metrics.{m}").alias(m) for m in ["loc", "cc", "funcs", "classes", "decisions"]],
        F.round("risk_score", 6).alias("risk_score"), "risk_level",
    )


@query(
    "evaluation_report",
    f"""{SCORES_WITH}, e AS (SELECT * FROM met JOIN areas USING (model))
        SELECT model, 0 AS part, '>>> ' || upper(model) AS line FROM e UNION ALL SELECT model, 1, printf('- Accuracy: %.4f', accuracy::DOUBLE) FROM e
        UNION ALL SELECT model, 2, printf('- Precision: %.4f', precision::DOUBLE) FROM e UNION ALL SELECT model, 3, printf('- Recall: %.4f', recall::DOUBLE) FROM e
        UNION ALL SELECT model, 4, printf('- F1: %.4f', f1::DOUBLE) FROM e UNION ALL SELECT model, 5, printf('- ROC-AUC: %.4f', roc_auc::DOUBLE) FROM e
        UNION ALL SELECT model, 6, '  True Neg: ' || tn FROM e UNION ALL SELECT model, 7, '  False Pos: ' || fp FROM e
        UNION ALL SELECT model, 8, '  False Neg: ' || fn FROM e UNION ALL SELECT model, 9, '  True Pos: ' || tp FROM e""",
)
def evaluation_report(spark, sf):
    return reports.evaluation_report_rows(evaluation.evaluate(scored(spark, sf)))


@query(
    "summary_report",
    f"""{SCORES_WITH}, m AS ({_METRICS}), b AS (SELECT arg_max(model, roc_auc) AS model, max(roc_auc) AS auc, arg_max(f1, roc_auc) AS f1, arg_max(accuracy, roc_auc) AS acc FROM met JOIN areas USING (model))
        SELECT 0 AS part, 'Samples: ' || count(*) AS line FROM m UNION ALL SELECT 1, 'Defective: ' || sum("LABEL") FROM m
        UNION ALL SELECT 2, printf('Defect rate: %.2f%%', avg("LABEL") * 100) FROM m UNION ALL SELECT 3, 'Features: 9'
        UNION ALL SELECT 4, 'Best model: ' || model FROM b UNION ALL SELECT 5, printf('ROC-AUC: %.4f', auc::DOUBLE) FROM b
        UNION ALL SELECT 6, printf('F1: %.4f', f1::DOUBLE) FROM b UNION ALL SELECT 7, printf('Accuracy: %.4f', acc::DOUBLE) FROM b""",
)
def summary_report(spark, sf):
    return reports.summary_report_rows(metrics(spark, sf), evaluation.evaluate(scored(spark, sf)))
