"""History tables as Parquet: sessions, metrics, predictions, conversations, messages.

Rows are appended; the current state of a conversation is the newest event per
id. Tables are split by a hash of the id, so reading one session prunes the
rest; deleted ids are noted and left out when reading.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Numeric metrics kept per file, and score columns kept per model.
FILE_METRICS = [
    "LOC", "LOC_BLANK", "LOC_TOTAL", "LOC_COMMENTS", "LOC_CODE", "FUNCTION_COUNT", "CLASS_COUNT",
    "CYCLOMATIC_COMPLEXITY", "DECISION_COUNT", "COMMENT_RATIO", "LABEL",
]
MODEL_SCORES = ["accuracy", "precision", "recall", "f1_score", "roc_auc"]
STAMP = "yyyy-MM-dd HH:mm:ss"


def stamp(moment: Column) -> Column:
    return F.date_format(moment, STAMP)


# ---- sessions -------------------------------------------------------------


def session_metrics(session_id: str, metrics: DataFrame) -> DataFrame:
    """Metric rows of one session; absent metrics are 0, an absent name is ``unknown``."""
    present = set(metrics.columns)
    named = next((c for c in ("file_name", "filename", "fname") if c in present), None)
    name = F.coalesce(F.col(named), F.lit("unknown")) if named else F.lit("unknown")

    def value(c: str) -> Column:
        kind = "double" if c == "COMMENT_RATIO" else "long"
        return (F.coalesce(F.col(c), F.lit(0)) if c in present else F.lit(0)).cast(kind).alias(c)

    return metrics.select(
        F.lit(session_id).alias("session_id"), name.alias("file_name"), *[value(c) for c in FILE_METRICS]
    )


def prediction_rows(session_id: str, scores: DataFrame) -> DataFrame:
    """Score rows of one session; absent scores are 0."""
    renamed = {"model": "model_name", "f1": "f1_score"}
    rows = scores.withColumnsRenamed({k: v for k, v in renamed.items() if k in scores.columns})
    return rows.select(
        F.lit(session_id).alias("session_id"), "model_name",
        *[
            (F.coalesce(F.col(c), F.lit(0.0)) if c in rows.columns else F.lit(0.0)).cast("double").alias(c)
            for c in MODEL_SCORES
        ],
    )


def newest_first(rows: DataFrame, limit: int | None = None, time: str = "timestamp", tie: str | None = None) -> DataFrame:
    """Rows by time, newest first; with a limit this plans as a top-k."""
    ordered = rows.orderBy(F.desc(time), *([tie] if tie else []))
    return ordered.limit(limit) if limit else ordered


def session_count(sessions: DataFrame) -> DataFrame:
    return sessions.agg(F.count(F.lit(1)).alias("sessions"))


def session_details(sessions: DataFrame, metrics: DataFrame, predictions: DataFrame) -> DataFrame:
    """Flat rows: each session with its metric rows and with its prediction rows.

    Children stay rows (``kind`` tells them apart), because a session may hold
    very many files; sessions without children appear once with NULLs.
    """
    children = metrics.select(
        "session_id", F.lit("metric").alias("kind"), F.col("file_name").alias("name"),
        F.to_json(F.struct(*[c for c in metrics.columns if c not in ("session_id", "file_name")])).alias("values"),
    ).unionByName(
        predictions.select(
            "session_id", F.lit("prediction").alias("kind"), F.col("model_name").alias("name"),
            F.to_json(F.struct(*[c for c in predictions.columns if c not in ("session_id", "model_name")])).alias("values"),
        )
    )
    return with_children(sessions, children, "session_id")


def with_children(parents: DataFrame, children: DataFrame, key: str) -> DataFrame:
    """Left join of parents and their children, safe for a parent with very many.

    A left join cannot split a crowded key on its right side. The inner join
    can, and parents without children are few columns found by an anti join.
    """
    matched = parents.join(children, key)
    lonely = without(parents, children, key)
    return matched.unionByName(lonely, allowMissingColumns=True)


# ---- conversations --------------------------------------------------------


def current_state(events: DataFrame, key: str = "conversation_id", time: str = "timestamp", order: str = "version") -> DataFrame:
    """The newest non-NULL value of every column per id, from append-only events.

    ``max_by`` combines on the map side, so an id with very many events costs
    one row per task in the shuffle.
    """
    columns = [c for c in events.columns if c not in (key, time, order)]
    at = F.struct(order, time)
    return events.groupBy(key).agg(
        F.min(time).alias(time), *[F.max_by(c, F.when(F.col(c).isNotNull(), at)).alias(c) for c in columns]
    )


def message_log(
    messages: DataFrame, conversation_id=None, key: str = "conversation_id", time: str = "timestamp", tie: str = "id"
) -> DataFrame:
    """Messages in time order, of one conversation or of all."""
    rows = messages if conversation_id is None else messages.filter(F.col(key) == conversation_id)
    return rows.orderBy(key, time, tie)


def conversations_with_messages(conversations: DataFrame, messages: DataFrame, key: str = "conversation_id") -> DataFrame:
    """Each conversation with its messages as rows; order them with :func:`message_log`.

    The rows carry their time, so reading a conversation in order is a
    range-partitioned sort and needs no numbering per conversation.
    """
    return with_children(conversations, messages, key)


def without(rows: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows whose id is not among the given ones."""
    return rows.join(ids.select(key).distinct(), key, "left_anti")


# ---- stored tables --------------------------------------------------------


class HistoryStore:
    """History tables in one folder, addressed by name.

    Ids are plain text columns; tables are split by a hash of the id into a fixed number of folders, so reading one id
    opens one of them. Appends carry their moment. Deleting appends the ids and the moment to a table of their own, and
    reading leaves out rows of those ids from before: nothing is rewritten, a failed delete changes nothing, and an
    id can be used again.
    """

    PARTS = 64
    KEYS = {
        "sessions": "session_id", "metrics": "session_id", "predictions": "session_id",
        "conversations": "conversation_id", "conversation_messages": "conversation_id",
    }
    SCHEMAS = {
        "sessions": "session_id string, source_type string, files_count int, files_list string, status string, timestamp string",
        "metrics": "session_id string, file_name string, "
        + ", ".join(f"{c} {'double' if c == 'COMMENT_RATIO' else 'long'}" for c in FILE_METRICS),
        "predictions": "session_id string, model_name string, " + ", ".join(f"{c} double" for c in MODEL_SCORES),
        "conversations": "conversation_id string, version int, name string, folder_name string, files_count int, status string, "
        "total_loc long, avg_complexity double, avg_defect_prob double, high_risk_count int, medium_risk_count int, "
        "low_risk_count int, timestamp string",
        "conversation_messages": "conversation_id string, message_type string, content string, timestamp string, id long",
    }

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _part(self, ident: Column) -> Column:
        return F.pmod(F.xxhash64(ident), F.lit(self.PARTS)).cast("int")

    def _append(self, name: str, rows: DataFrame) -> None:
        key = self.KEYS[name]
        stored = rows.withColumn("_at", F.unix_micros(F.current_timestamp())).withColumn("_part", self._part(F.col(key)))
        stored.write.mode("append").partitionBy("_part").parquet(f"{self.folder}/{name}")

    def _stored(self, path: str, schema: str) -> DataFrame:
        """A table, or no rows where it was never written."""
        try:
            return self.spark.read.schema(schema).parquet(path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def read(self, name: str, ident: str | None = None) -> DataFrame:
        """The rows of a table that are not deleted; of one id, or of all."""
        key, schema = self.KEYS[name], self.SCHEMAS[name]
        rows = self._stored(f"{self.folder}/{name}", f"{schema}, _at long, _part int")
        gone = self._stored(f"{self.folder}/deleted_{name}", f"{key} string, _until long")
        if ident is not None:
            rows = rows.filter((F.col("_part") == self._part(F.lit(ident))) & (F.col(key) == ident))
            gone = gone.filter(F.col(key) == ident)
        last = gone.groupBy(key).agg(F.max("_until").alias("_until"))
        kept = rows.join(last, key, "left").filter(F.col("_until").isNull() | (F.col("_at") > F.col("_until")))
        return kept.select(*[c.split()[0] for c in schema.split(", ")])

    def save_session(self, session_id: str, source_type: str, files: list[str], metrics: DataFrame) -> str:
        row = self.spark.createDataFrame(
            [(session_id, source_type, len(files), ", ".join(files), "completed")],
            "session_id string, source_type string, files_count int, files_list string, status string",
        ).withColumn("timestamp", stamp(F.current_timestamp()))
        self._append("sessions", row)
        self._append("metrics", session_metrics(session_id, metrics))
        return session_id

    def save_predictions(self, session_id: str, scores: DataFrame) -> None:
        self._append("predictions", prediction_rows(session_id, scores))

    def create_conversation(self, conversation_id: str, name: str | None = None, folder_name: str | None = None) -> str:
        self._conversation_event(
            conversation_id, 0, name=name or f"Analysis {conversation_id}", folder_name=folder_name,
            files_count=0, status="in_progress",
        )
        return conversation_id

    def update_conversation(self, conversation_id: str, **values) -> None:
        """Append the results of an analysis; the conversation becomes completed."""
        known = self.read("conversations", conversation_id)
        version = (known.agg(F.max("version")).first()[0] or 0) + 1
        self._conversation_event(conversation_id, version, status="completed", **values)

    def _conversation_event(self, conversation_id: str, version: int, **values) -> None:
        columns = {
            "name": "string", "folder_name": "string", "files_count": "int", "status": "string", "total_loc": "long",
            "avg_complexity": "double", "avg_defect_prob": "double", "high_risk_count": "int",
            "medium_risk_count": "int", "low_risk_count": "int",
        }
        row = self.spark.createDataFrame(
            [(conversation_id, version, *[values.get(c) for c in columns])],
            "conversation_id string, version int, " + ", ".join(f"{c} {t}" for c, t in columns.items()),
        ).withColumn("timestamp", stamp(F.current_timestamp()))
        self._append("conversations", row)

    def add_messages(self, messages: DataFrame) -> None:
        """Append many messages (conversation_id, message_type, content, timestamp, id) as one batch of files."""
        self._append("conversation_messages", messages)

    def add_message(self, conversation_id: str, message_type: str, content: str) -> None:
        row = self.spark.createDataFrame(
            [(conversation_id, message_type, content)], "conversation_id string, message_type string, content string"
        ).select("*", stamp(F.current_timestamp()).alias("timestamp"), F.unix_micros(F.current_timestamp()).alias("id"))
        self._append("conversation_messages", row)

    def all_sessions(self, limit: int | None = None) -> DataFrame:
        return newest_first(self.read("sessions"), limit, tie="session_id")

    def session(self, session_id: str) -> dict[str, DataFrame]:
        """The session and its children; the id filter prunes partitions."""
        return {
            name: self.read(name, session_id)
            for name in ("sessions", "metrics", "predictions")
        }

    def all_conversations(self) -> DataFrame:
        return newest_first(current_state(self.read("conversations")), tie="conversation_id")

    def messages(self, conversation_id: str) -> DataFrame:
        return message_log(self.read("conversation_messages", conversation_id))

    def delete_sessions(self, ids: list[str]) -> None:
        self._delete(("predictions", "metrics", "sessions"), "session_id", ids)

    def delete_conversations(self, ids: list[str]) -> None:
        self._delete(("conversation_messages", "conversations"), "conversation_id", ids)

    def _delete(self, names: tuple[str, ...], key: str, ids: list[str]) -> None:
        """Note the ids as deleted, children first."""
        gone = self.spark.createDataFrame([(i,) for i in ids], f"{key} string")
        for name in names:
            noted = gone.withColumn("_until", F.unix_micros(F.current_timestamp()))
            noted.write.mode("append").parquet(f"{self.folder}/deleted_{name}")
