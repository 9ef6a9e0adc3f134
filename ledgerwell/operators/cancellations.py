"""The cancellation that applies to a transaction."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerwell.operators.dictionaries import one_row_per_key
from ledgerwell.operators.joins import spread_join


# What a transaction gets from its cancellation.
KEPT_COLUMNS = (
    "cancellation_id cancellation_reason cancelled_at cancelled_date refund_amount negative_refund_amount "
    "is_valid_cancellation cancellation_validation_errors"
).split()


def candidate_cancellations(silver_cancellations: DataFrame, *more: Column) -> DataFrame:
    """Cancellations that name a transaction, in the columns the fact keeps, and ``processed_at``."""
    return silver_cancellations.where(F.col("original_transaction_id").isNotNull()).select(
        "cancellation_id",
        "original_transaction_id",
        F.col("reason").alias("cancellation_reason"),
        "cancelled_at",
        "cancelled_date",
        "refund_amount",
        "negative_refund_amount",
        F.col("is_valid_record").alias("is_valid_cancellation"),
        F.col("validation_errors").alias("cancellation_validation_errors"),
        "processed_at",
        *more,
    )


def latest_cancellations(silver_cancellations: DataFrame) -> DataFrame:
    """One row per cancelled transaction: the newest by time, then load time, then id."""
    candidates = candidate_cancellations(silver_cancellations)
    return one_row_per_key(
        candidates, "original_transaction_id", "cancelled_at", "processed_at", "cancellation_id"
    ).drop("processed_at")


def attach_cancellations(df: DataFrame, latest: DataFrame, hot: Sequence[int] = ()) -> DataFrame:
    """Left-join ``latest`` by transaction id; ``df`` carries ``_spread`` (see ``mark_duplicates``).

    The join keys are (id, _spread), the partitioning the duplicate marks already made.
    """
    joined = spread_join(df, latest, "transaction_id", "original_transaction_id", hot)
    return joined.drop("original_transaction_id")
