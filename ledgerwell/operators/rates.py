"""Validity intervals of exchange rates."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerwell.functions.money import ASOF_STRATEGY, BACKFILL_STRATEGY
from ledgerwell.schemas import TABLES

# Fixed value: the start of the interval that serves rows older than the first rate.
BEGINNING_OF_TIME = "1900-01-01 00:00:00"


def usable_rates(silver_rates: DataFrame) -> DataFrame:
    """Valid positive rates, one per timestamp: the greatest update id wins."""
    valid = silver_rates.where(
        F.col("is_valid_record")
        & F.col("rate_timestamp").isNotNull()
        & (F.col("rate_tgrk_punk") > 0)
        & (F.col("rate_tgrk_rub") > 0)
    )
    newest = F.max(F.struct("update_id", "rate_tgrk_punk", "rate_tgrk_rub")).alias("newest")
    return valid.groupBy("rate_timestamp").agg(newest).select(
        F.col("newest.update_id").alias("rate_update_id"),
        "rate_timestamp",
        F.to_date("rate_timestamp").alias("rate_date"),
        "newest.rate_tgrk_punk",
        "newest.rate_tgrk_rub",
    )


def _with_next_timestamp(rates: DataFrame) -> DataFrame:
    """Add ``valid_to``, the timestamp of the next rate, without one global sort.

    Rates are chained within their day. A closing row per day carries the first timestamp of the
    following day that has rates; only those closing rows, one per calendar day, share a task.
    """
    day_heads = rates.groupBy("rate_date").agg(F.min("rate_timestamp").alias("head"))
    closings = day_heads.select(
        "rate_date", F.lead("head").over(Window.orderBy("rate_date")).alias("rate_timestamp")
    ).where(F.col("rate_timestamp").isNotNull())
    in_day = Window.partitionBy("rate_date").orderBy("rate_timestamp")
    return (
        rates.withColumn("_is_rate", F.lit(True))
        .unionByName(closings, allowMissingColumns=True)
        .withColumn("valid_to", F.lead("rate_timestamp").over(in_day))
        .where(F.col("_is_rate"))
        .drop("_is_rate")
    )


def rate_intervals(
    silver_rates: DataFrame, start: str | date | None = None, end: str | date | None = None
) -> DataFrame:
    """Half-open intervals ``[valid_from, valid_to)``; the last one is open.

    The rate that is first in time also serves everything before it. ``start`` and ``end`` only
    label the rows: all rates are always used.
    """
    rates = usable_rates(silver_rates)
    asof = _with_next_timestamp(rates).select(
        "*",
        F.col("rate_timestamp").alias("valid_from"),
        F.lit(ASOF_STRATEGY).alias("rate_selection_strategy"),
    )
    first = (
        rates.agg(F.min(F.struct("rate_timestamp", *[n for n in rates.columns if n != "rate_timestamp"])).alias("r"))
        .where(F.col("r").isNotNull())
        .select("r.*")
        .select(
            "*",
            F.lit(BEGINNING_OF_TIME).cast("timestamp").alias("valid_from"),
            F.col("rate_timestamp").alias("valid_to"),
            F.lit(BACKFILL_STRATEGY).alias("rate_selection_strategy"),
        )
    )
    return (
        first.unionByName(asof)
        .withColumns(
            {
                "rate_interval_id": F.col("valid_from").cast("string"),
                "valid_from_date": F.to_date("valid_from"),
                "valid_to_date": F.to_date("valid_to"),
                "is_rate_found": F.lit(True),
                "is_rate_valid": F.lit(True),
                "gold_window_start": F.lit(start).cast("date"),
                "gold_window_end": F.lit(end).cast("date"),
                "gold_processed_at": F.current_timestamp(),
            }
        )
        .select(*TABLES["gold/dim_exchange_rate_intervals"].schema.names)
    )
