"""How many tasks the rows of an iterative job are dealt to."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame

ROWS_PER_TASK = 20_000
MOST_ROWS_PER_TASK = 250_000


def tasks_for(rows: int, cores: int, rows_per_task: int = ROWS_PER_TASK) -> int:
    """One task for every ``rows_per_task`` rows up to one a core; past that, as few rounds of all cores as keep tasks small.

    Not more, since every task of a forest writes the statistics of all nodes.
    """
    rounds = max(1, math.ceil(rows / (cores * MOST_ROWS_PER_TASK)))
    return max(1, min(math.ceil(rows / rows_per_task), cores * rounds))


def dealt(rows: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Rows in as many even partitions as they need; a table that one task holds is left as it is.

    Splits of a file say nothing about its rows, since only the one with the middle of a row group reads that group.
    """
    tasks = tasks_for(rows.count(), rows.sparkSession.sparkContext.defaultParallelism, rows_per_task)
    return rows if tasks == 1 else rows.repartition(tasks)
