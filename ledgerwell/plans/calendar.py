"""What should have been loaded, what is missing, and what has to be rebuilt."""

from __future__ import annotations

from datetime import date, datetime, timedelta
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerwell.sources.lake import as_date

# The first day of data, the length of a slot, the zone of the slots, the batch size
# of a catch-up and the days a regular rebuild goes back.
FIRST_DAY = date(2026, 4, 27)
SLOT_MINUTES = 10
LANDING_ZONE = "Europe/Moscow"
CATCH_UP_LIMIT = 20
REBUILD_DAYS_BACK = 2


def expected_slots(spark: SparkSession, start: str | date, end: str | date, last_slot: str = "23-50") -> DataFrame:
    """(day, slot) of every slot from the start of ``start`` to ``last_slot`` of ``end``."""
    hour, minute = last_slot.split("-")
    first = F.lit(f"{as_date(start)} 00:00:00").cast("timestamp_ntz")
    last = F.lit(f"{as_date(end)} {hour}:{minute}:00").cast("timestamp_ntz")
    step = F.expr(f"INTERVAL '{SLOT_MINUTES}' MINUTE")
    return (
        spark.range(1)
        .select(F.explode(F.sequence(first, last, step)).alias("at"))
        .select(F.to_date("at").alias("day"), F.date_format("at", "HH-mm").alias("slot"))
    )


def expected_days(spark: SparkSession, start: str | date, end: str | date) -> DataFrame:
    """One row per day; empty when ``end`` lies before ``start``."""
    first, last = as_date(start), as_date(end)
    return spark.range((last - first).days + 1 if last >= first else 0).select(
        F.date_add(F.lit(first), F.col("id").cast("int")).alias("day")
    )


def loaded_partitions(audit: DataFrame, target_table: str) -> DataFrame:
    return (
        audit.where((F.col("status") == "loaded") & (F.col("target_table") == target_table))
        .select(F.col("file_date").alias("day"), "slot")
        .distinct()
    )


def missing_slots(expected: DataFrame, loaded: DataFrame, limit: int = CATCH_UP_LIMIT) -> DataFrame:
    """The oldest expected slots that were never loaded, at most one batch of them."""
    return expected.join(loaded, ["day", "slot"], "left_anti").orderBy("day", "slot").limit(limit)


def missing_days(expected: DataFrame, loaded: DataFrame) -> DataFrame:
    return expected.join(loaded.select("day").distinct(), "day", "left_anti").orderBy("day")


def last_complete_slot(at: Column) -> tuple[Column, Column]:
    """(day, slot) of the newest slot that was over at ``at``, in the zone of the slots."""
    seconds = SLOT_MINUTES * 60
    floored = F.timestamp_seconds(F.floor(F.unix_seconds(at) / seconds) * seconds - seconds)
    local = F.convert_timezone(F.lit("UTC"), F.lit(LANDING_ZONE), floored.cast("timestamp_ntz"))
    return F.to_date(local), F.date_format(local, "HH-mm")


def last_complete_slot_now(now: datetime) -> tuple[date, str]:
    local = now.astimezone(ZoneInfo(LANDING_ZONE)) - timedelta(minutes=SLOT_MINUTES)
    return local.date(), f"{local.hour:02d}-{local.minute // SLOT_MINUTES * SLOT_MINUTES:02d}"


def last_day_for_cancellations(now: datetime) -> date:
    """Only finished days, in UTC: the file of today may still grow."""
    return now.astimezone(ZoneInfo("UTC")).date() - timedelta(days=1)


def last_day_for_rates(now: datetime) -> date:
    """Today is included: rates are updated during the day."""
    return now.astimezone(ZoneInfo(LANDING_ZONE)).date()


def rebuild_window(now: datetime) -> tuple[date, date]:
    """The days a regular rebuild of the fact covers."""
    today = now.astimezone(ZoneInfo(LANDING_ZONE)).date()
    return today - timedelta(days=REBUILD_DAYS_BACK), today


def affected_dates(fact: DataFrame, new_cancellations: DataFrame) -> DataFrame:
    """File dates of the fact that newly loaded cancellations touch, however old.

    The fact is reduced to distinct (id, day) pairs before the shuffle, so an id with very many
    rows costs a few rows per task.
    """
    days_of_id = (
        fact.where(F.col("transaction_id").isNotNull()).select("transaction_id", "file_date").distinct()
    )
    cancelled = (
        new_cancellations.where(F.col("original_transaction_id").isNotNull())
        .select(F.col("original_transaction_id").alias("transaction_id"))
        .distinct()
    )
    return days_of_id.join(cancelled, "transaction_id", "left_semi").select("file_date").distinct()
