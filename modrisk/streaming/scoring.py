"""File risks of newly arriving source files.

The analysis of a file needs nothing but the file, so each micro-batch of new
files runs the batch plan and appends its rows; there is no streaming state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from modrisk.operators.risk import file_risk


def score_arrivals(files: DataFrame, output: str, checkpoint: str) -> StreamingQuery:
    """Score a stream of (path, fname, ext, lang, content) rows into Parquet.

    Every batch writes its own folder, so a batch repeated after a failure
    replaces its rows instead of doubling them.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        file_risk(batch).write.mode("overwrite").parquet(f"{output}/batch={batch_id}")

    return (
        files.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
