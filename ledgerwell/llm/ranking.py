"""Ranks within groups of any size, without one task per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerwell.llm.shared import stage

AT, TASK = "_at", "_task"


def ranked(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str) -> tuple[DataFrame, DataFrame]:
    """``df`` sorted over all tasks by (keys, order), staged, with each row's place; and the runs.

    A group that spans tasks is a run in each of them. The runs hold, per (keys, task): the first
    place, and how many rows of the group lie in earlier tasks. A row's rank in its group, from 0, is
    ``_at - first + before``. Range partitions split a group of any size; the runs are few: one per
    group and one more per task.
    """
    spread = df.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order)
    placed = stage(spread.withColumn(AT, F.monotonically_increasing_id()), name)
    placed = placed.withColumn(TASK, F.shiftright(F.col(AT), 33))
    runs = placed.groupBy(*keys, TASK).agg(F.min(AT).alias("_first"), F.count("*").alias("_n"))
    earlier = Window.partitionBy(*keys).orderBy(TASK).rowsBetween(Window.unboundedPreceding, -1)
    return placed, runs.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))


RANK = f"({AT} - _first + _before)"
