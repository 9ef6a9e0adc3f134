"""The hourly cube: 12 keys, 10 measures."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerwell.functions.money import MONEY, zero_money
from ledgerwell.schemas import CUBE_KEYS, CUBE_MEASURES
from ledgerwell.sources.lake import in_days

# Fixed value: the order in which the cube is displayed.
DISPLAY_ORDER = (
    "event_date event_hour currency transaction_type status user_segment is_cancelled "
    "cancellation_reason rate_selection_strategy"
).split()


def _known(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit("unknown")).alias(name)


def _zero_one(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(False)).cast("tinyint").alias(name)


def _total(name: str) -> Column:
    return F.coalesce(F.sum(name), zero_money()).cast(MONEY).alias(name)


def hourly_cube(fact: DataFrame, start: str | date, end: str | date) -> DataFrame:
    """Cells of the days ``start..end`` of ``created_date``, the same key the cube is replaced by.

    ``unique_users_count`` is exact within a cell and must not be added up across cells.
    """
    return _cells(fact.where(in_days("created_date", start, end)))


def hourly_cube_of(fact: DataFrame, event_days: Sequence[date]) -> DataFrame:
    """Cells of single event days; ``fact`` may be any part of the fact that holds all their rows."""
    return _cells(fact.where(F.col("created_date").isin(list(event_days))))


def _cells(fact: DataFrame) -> DataFrame:
    return (
        fact.where(F.col("created_at").isNotNull())
        .groupBy(
            F.col("created_date").alias("event_date"),
            F.hour("created_at").cast("tinyint").alias("event_hour"),
            _known("currency"),
            _known("transaction_type"),
            _known("status"),
            _known("user_segment"),
            _zero_one("is_purchase_type"),
            _zero_one("is_completed_status"),
            _zero_one("is_completed_purchase"),
            _zero_one("is_cancelled"),
            F.coalesce("cancellation_reason", F.lit("")).alias("cancellation_reason"),
            _known("rate_selection_strategy"),
        )
        .agg(
            F.count(F.lit(1)).alias("transactions_count"),
            F.count_if("is_canonical_transaction").alias("canonical_transactions_count"),
            F.count_if("is_duplicate_transaction").alias("duplicate_transaction_id_rows_count"),
            F.count_distinct("user_id").alias("unique_users_count"),
            _total("gross_amount_tgrk"),
            _total("refund_amount_tgrk"),
            _total("net_amount_tgrk"),
            F.count_if("negative_amount").alias("negative_amount_count"),
            F.count_if("zero_amount").alias("zero_amount_count"),
            F.count_if(F.col("is_cancelled")).alias("cancelled_transactions_count"),
        )
        .select(*CUBE_KEYS, *CUBE_MEASURES)
    )


def displayed(cube: DataFrame) -> DataFrame:
    return cube.orderBy(*DISPLAY_ORDER)
