"""The enriched fact: one row per silver transaction, with everything reports need."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerwell.functions.money import (
    ASOF_STRATEGY,
    BACKFILL_STRATEGY,
    BASE_CURRENCY,
    BASE_STRATEGY,
    MONEY,
    NO_RATE_STRATEGY,
    in_base_currency,
    minutes_between,
    zero_money,
)
from ledgerwell.operators.asof import attach_rates
from ledgerwell.operators.cancellations import attach_cancellations, latest_cancellations
from ledgerwell.operators.duplicates import mark_duplicates
from ledgerwell.operators.hotkeys import HOT_ROWS, hot_keys, with_scatter
from ledgerwell.operators.joins import BROADCAST_ROWS
from ledgerwell.operators.lookups import attach_promo_codes, attach_test_users, attach_users
from ledgerwell.schemas import TABLES, TRANSACTION_FLAGS
from ledgerwell.sources.lake import in_days

FACT_COLUMNS = tuple(TABLES["gold/fct_transactions_enriched"].schema.names)

_RENAMED = {
    "loaded_at": "transaction_loaded_at",
    "processed_at": "transaction_processed_at",
    "is_valid_record": "is_valid_transaction",
    "validation_errors": "transaction_validation_errors",
}


def transactions_in_window(silver_transactions: DataFrame, start: str | date, end: str | date) -> DataFrame:
    """The columns the fact keeps, for files of the inclusive day window."""
    return _kept_columns(silver_transactions.where(in_days("file_date", start, end)))


def _kept_columns(silver_transactions: DataFrame) -> DataFrame:
    kept = (
        *"transaction_id user_id user_uuid amount currency transaction_type status promo_code_id".split(),
        *"created_at created_date file_date slot source_file raw_bucket raw_object_path".split(),
        *_RENAMED,
        *TRANSACTION_FLAGS,
    )
    return silver_transactions.select(*[F.col(name).alias(_RENAMED.get(name, name)) for name in kept])


# Each of these adds columns in steps: a later step names what an earlier one made instead of
# repeating its expression, which also keeps the optimizer's constraint sets small.


def with_business_flags(df: DataFrame) -> DataFrame:
    kind, status = F.col("transaction_type"), F.col("status")
    return df.withColumns(
        {
            "is_purchase_type": kind == "purchase",
            "is_completed_status": status == "completed",
            "is_failed_status": status == "failed",
            "is_refund_type": kind == "refund",
            "is_transfer_type": kind == "transfer",
        }
    ).withColumn("is_completed_purchase", F.col("is_purchase_type") & F.col("is_completed_status"))


def with_user_state(df: DataFrame) -> DataFrame:
    """A missing user id makes the row anonymous, even when its uuid is a test user's."""
    return (
        df.withColumns(
            {
                "is_user_found": F.col("u_id").isNotNull(),
                "user_is_test_from_users": F.coalesce(F.col("u_is_test"), F.lit(False)),
                "user_is_test_from_test_users": F.col("tu_uuid").isNotNull(),
            }
        )
        .withColumn("is_test_user", F.col("user_is_test_from_users") | F.col("user_is_test_from_test_users"))
        .withColumn(
            "user_segment",
            F.when(F.col("user_id").isNull(), "anonymous").when(F.col("is_test_user"), "test").otherwise("real"),
        )
        .drop("u_id", "u_is_test", "tu_uuid")
    )


def with_promo_state(df: DataFrame) -> DataFrame:
    used, last_day = F.col("has_promo_code"), F.col("promo_expiry_date")
    named = df.withColumnsRenamed(
        {"p_code": "promo_code", "p_max_uses": "promo_max_uses", "p_expiry_date": "promo_expiry_date"}
    )
    return (
        named.withColumn("has_promo_code", F.col("promo_code_id").isNotNull())
        .withColumns(
            {
                "is_promo_missing_in_dictionary": used & F.col("p_id").isNull(),
                "is_promo_expired": used & last_day.isNotNull() & (F.col("created_date") > last_day),
            }
        )
        .withColumn("is_promo_found", ~F.col("is_promo_missing_in_dictionary"))
        .drop("p_id")
    )


def with_rate_state(df: DataFrame) -> DataFrame:
    base = F.col("currency") == BASE_CURRENCY
    at, punk, rub = F.col("rate_timestamp"), F.col("rate_tgrk_punk"), F.col("rate_tgrk_rub")
    usable = at.isNotNull() & punk.isNotNull() & rub.isNotNull() & (punk > 0) & (rub > 0)
    strategy = F.when(base, BASE_STRATEGY).when(at.isNotNull(), F.col("r_strategy")).otherwise(NO_RATE_STRATEGY)
    return (
        df.withColumnsRenamed(
            {
                "r_interval_id": "rate_interval_id",
                "r_timestamp": "rate_timestamp",
                "r_date": "rate_date",
                "r_punk": "rate_tgrk_punk",
                "r_rub": "rate_tgrk_rub",
            }
        )
        .withColumns(
            {
                "rate_selection_strategy": strategy,
                "is_rate_valid": F.when(base, True).otherwise(usable),
                "rate_time_diff_minutes": minutes_between(at, F.col("created_at")),
            }
        )
        .withColumn(
            "is_rate_found",
            F.col("rate_selection_strategy").isin(BASE_STRATEGY, ASOF_STRATEGY, BACKFILL_STRATEGY),
        )
        .drop("r_strategy")
    )


def with_base_amount(df: DataFrame) -> DataFrame:
    return df.withColumn("amount_tgrk", _in_base(F.col("amount")))


def with_net_amount(df: DataFrame) -> DataFrame:
    """Net is gross minus the refund, which counts as 0 if it is unknown."""
    refund = F.when(F.col("cancellation_id").isNull(), zero_money()).otherwise(_in_base(F.col("refund_amount")))
    net = F.col("amount_tgrk") - F.coalesce(F.col("refund_amount_tgrk"), zero_money())
    return (
        with_base_amount(df)
        .withColumn("refund_amount_tgrk", refund)
        .withColumns({"gross_amount_tgrk": F.col("amount_tgrk"), "net_amount_tgrk": net.try_cast(MONEY)})
    )


def _in_base(amount: Column) -> Column:
    return in_base_currency(amount, F.col("currency"), F.col("rate_tgrk_punk"), F.col("rate_tgrk_rub"))


def with_cancellation_state(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "is_cancelled": F.col("cancellation_id").isNotNull(),
            "time_to_cancel_minutes": minutes_between(F.col("cancelled_at"), F.col("created_at")),
        }
    )


def with_stamps(df: DataFrame, start: str | date, end: str | date) -> DataFrame:
    return df.withColumns(
        {
            "is_canonical_transaction": F.lit(True),
            "gold_window_start": F.lit(start).cast("date"),
            "gold_window_end": F.lit(end).cast("date"),
            "gold_processed_at": F.current_timestamp(),
        }
    )


def enriched_fact(
    transactions: DataFrame,
    *,
    users: DataFrame,
    test_users: DataFrame,
    promo_codes: DataFrame,
    intervals: DataFrame,
    cancellations: DataFrame,
    start: str | date,
    end: str | date,
    hot_rows: int = HOT_ROWS,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Silver transactions of the window with all lookups, amounts and marks.

    While the dictionaries and intervals are small, the only shuffle of the wide rows is by
    transaction id; it serves the duplicate marks and the cancellation join. ``hot_rows`` is the
    size from which a key is spread over tasks, ``broadcast_rows`` the size up to which a lookup
    is broadcast.
    """
    base = transactions_in_window(transactions, start, end)
    hot = hot_keys(base, "transaction_id", hot_rows)
    marked = mark_duplicates(with_scatter(base), hot)
    sizes = {"keys_from": base, "broadcast_rows": broadcast_rows, "hot_rows": hot_rows}
    lookups = {"users": users, "test_users": test_users, "promo_codes": promo_codes, "intervals": intervals}
    joined = _looked_up(marked, hot, latest_cancellations(cancellations), lookups, sizes)
    return joined.transform(with_stamps, start, end).select(*FACT_COLUMNS)


def enriched_days(
    transactions: DataFrame,
    windows: Mapping[date, tuple[date, date]],
    *,
    users: DataFrame,
    test_users: DataFrame,
    promo_codes: DataFrame,
    intervals: DataFrame,
    latest: DataFrame,
    hot_rows: int = HOT_ROWS,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """The fact rows of single file days, each as a build of its window would make them.

    ``windows`` names the days and the window of each; duplicates of a day are those of its window. Only
    partitions of these windows are read, and only rows of the days themselves are looked up. ``latest`` is
    the newest cancellation per transaction (see ``latest.merge_latest``).
    """
    spans = sorted(set(windows.values()))
    read = sorted({start + timedelta(days=n) for start, end in spans for n in range((end - start).days + 1)})
    base = _kept_columns(transactions.where(F.col("file_date").isin(read)))
    hot = hot_keys(base, "transaction_id", hot_rows)
    span = F.array(*[F.struct(F.lit(a).alias("gold_window_start"), F.lit(b).alias("gold_window_end")) for a, b in spans])
    covers = F.filter(span, lambda s: F.col("file_date").between(s["gold_window_start"], s["gold_window_end"]))
    # A row takes part in every window that holds its day.
    parted = with_scatter(base).withColumn("_span", F.explode(covers))
    parted = parted.withColumn("_window", F.concat_ws("/", "_span.gold_window_start", "_span.gold_window_end"))
    marked = mark_duplicates(parted, hot, ["_window"])
    own = F.map_from_arrays(F.array(*[F.lit(day) for day in windows]), F.array(*[F.lit(f"{a}/{b}") for a, b in windows.values()]))
    marked = marked.where(F.col("_window") == F.try_element_at(own, F.col("file_date"))).drop("_window")
    sizes = {"keys_from": base, "broadcast_rows": broadcast_rows, "hot_rows": hot_rows}
    lookups = {"users": users, "test_users": test_users, "promo_codes": promo_codes, "intervals": intervals}
    joined = _looked_up(marked, hot, latest, lookups, sizes)
    stamps = {"gold_window_start": F.col("_span.gold_window_start"), "gold_window_end": F.col("_span.gold_window_end")}
    return joined.withColumns(
        {"is_canonical_transaction": F.lit(True), "gold_processed_at": F.current_timestamp(), **stamps}
    ).select(*FACT_COLUMNS)


def _looked_up(marked: DataFrame, hot: Sequence[int], latest: DataFrame, lookups: dict[str, DataFrame], sizes: dict) -> DataFrame:
    """Marked transactions with cancellations, dictionaries, rates, and all that follows from them."""
    joined = attach_cancellations(marked, latest, hot)
    joined = attach_users(joined, lookups["users"], **sizes)
    joined = attach_test_users(joined, lookups["test_users"], **sizes)
    joined = attach_promo_codes(joined, lookups["promo_codes"], **sizes)
    joined = attach_rates(joined, lookups["intervals"], **sizes)
    return (
        joined.transform(with_business_flags)
        .transform(with_user_state)
        .transform(with_promo_state)
        .transform(with_rate_state)
        .transform(with_net_amount)
        .transform(with_cancellation_state)
    )
