"""Schemas of every input and table. Names, order and types are the data contract."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

_TYPES = {
    "STRING": T.StringType(),
    "BIGINT": T.LongType(),
    "TINYINT": T.ByteType(),
    "DOUBLE": T.DoubleType(),
    "BOOLEAN": T.BooleanType(),
    "DATE": T.DateType(),
    "TIMESTAMP": T.TimestampType(),
    "DECIMAL(18,2)": T.DecimalType(18, 2),
    "ARRAY<STRING>": T.ArrayType(T.StringType()),
}


def _struct(columns: str) -> T.StructType:
    """``"name TYPE, name TYPE"`` as a schema; unlike ``fromDDL`` it needs no running session."""
    pairs = [column.split() for column in columns.split(", ")]
    return T.StructType([T.StructField(name, _TYPES[sql_type]) for name, sql_type in pairs])

# --- line-JSON inputs: everything dirty is read as text ---------------------------------------

RAW_TRANSACTIONS = _struct(
    "transaction_id STRING, user_id STRING, user_uuid STRING, amount STRING, currency STRING, "
    "transaction_type STRING, promo_code_id STRING, status STRING, created_at STRING"
)
RAW_RATES = _struct(
    "update_id STRING, timestamp STRING, rate_tgrk_punk STRING, rate_tgrk_rub STRING"
)
RAW_CANCELLATIONS = _struct(
    "cancellation_id STRING, original_transaction_id STRING, reason STRING, "
    "cancelled_at STRING, refund_amount STRING"
)
RAW_DICTIONARIES = {
    "users": _struct("user_id BIGINT, user_uuid STRING, is_test_user BOOLEAN"),
    "test_users": _struct("test_user_uuid STRING"),
    "promo_codes": _struct(
        "promo_code_id BIGINT, code STRING, max_uses BIGINT, expiry_date STRING"
    ),
}

# --- tables -----------------------------------------------------------------------------------

_TRANSACTION_FLAGS = (
    "missing_transaction_id invalid_transaction_id missing_user_id invalid_user_id missing_user_uuid "
    "missing_amount invalid_amount negative_amount zero_amount missing_currency unsupported_currency "
    "missing_transaction_type unsupported_transaction_type missing_status missing_created_at "
    "invalid_created_at invalid_promo_code_id"
).split()
_RATE_FLAGS = (
    "missing_update_id missing_timestamp invalid_update_id invalid_timestamp invalid_rate_tgrk_punk "
    "invalid_rate_tgrk_rub missing_rate_tgrk_punk missing_rate_tgrk_rub non_positive_rate_tgrk_punk "
    "non_positive_rate_tgrk_rub"
).split()
_CANCELLATION_FLAGS = (
    "invalid_cancellation_id invalid_original_transaction_id invalid_cancelled_at "
    "invalid_refund_amount negative_refund_amount missing_reason"
).split()


def _typed(names: list[str], sql_type: str) -> str:
    return ", ".join(f"{name} {sql_type}" for name in names)


def _raw_copies(schema: T.StructType) -> str:
    return _typed([f"{name}_raw" for name in schema.names], "STRING")


_VERDICT = "is_valid_record BOOLEAN, validation_errors ARRAY<STRING>"
_ORIGIN = (
    "source_file STRING, raw_bucket STRING, raw_object_path STRING, "
    "loaded_at TIMESTAMP, processed_at TIMESTAMP"
)


@dataclass(frozen=True)
class Table:
    """A stored table: its schema and the columns that name its partitions."""

    schema: T.StructType
    partitioned_by: tuple[str, ...] = ()


def _table(ddl: str, *partitioned_by: str) -> Table:
    return Table(_struct(ddl), partitioned_by)


TABLES = {
    "dictionaries/users": _table(
        "user_id BIGINT, user_uuid STRING, is_test_user BOOLEAN, source_file STRING, loaded_at TIMESTAMP"
    ),
    "dictionaries/test_users": _table(
        "test_user_uuid STRING, source_file STRING, loaded_at TIMESTAMP"
    ),
    "dictionaries/promo_codes": _table(
        "promo_code_id BIGINT, code STRING, max_uses BIGINT, expiry_date DATE, "
        "source_file STRING, loaded_at TIMESTAMP"
    ),
    "bronze/cancellations_raw": _table(
        "cancellation_id STRING, original_transaction_id STRING, reason STRING, cancelled_at STRING, "
        "refund_amount STRING, source_file STRING, raw_bucket STRING, raw_object_path STRING, "
        "file_date STRING, loaded_at TIMESTAMP",
        "file_date",
    ),
    "silver/transactions_clean": _table(
        f"{_raw_copies(RAW_TRANSACTIONS)}, "
        "transaction_id BIGINT, user_id BIGINT, user_uuid STRING, amount DECIMAL(18,2), currency STRING, "
        "transaction_type STRING, promo_code_id BIGINT, status STRING, created_at TIMESTAMP, "
        f"created_date DATE, {_typed(_TRANSACTION_FLAGS, 'BOOLEAN')}, {_VERDICT}, "
        f"file_date DATE, slot STRING, {_ORIGIN}",
        "file_date",
        "slot",
    ),
    "silver/exchange_rates_clean": _table(
        f"{_raw_copies(RAW_RATES)}, update_id BIGINT, rate_timestamp TIMESTAMP, rate_date DATE, "
        f"rate_tgrk_punk DOUBLE, rate_tgrk_rub DOUBLE, {_typed(_RATE_FLAGS, 'BOOLEAN')}, {_VERDICT}, "
        f"file_date DATE, {_ORIGIN}",
        "file_date",
    ),
    "silver/cancellations_clean": _table(
        f"{_raw_copies(RAW_CANCELLATIONS)}, cancellation_id BIGINT, original_transaction_id BIGINT, "
        "reason STRING, cancelled_at TIMESTAMP, cancelled_date DATE, refund_amount DECIMAL(18,2), "
        f"{_typed(_CANCELLATION_FLAGS, 'BOOLEAN')}, {_VERDICT}, file_date DATE, {_ORIGIN}",
        "file_date",
    ),
    "gold/dim_exchange_rate_intervals": _table(
        "rate_interval_id STRING, valid_from TIMESTAMP, valid_to TIMESTAMP, valid_from_date DATE, "
        "valid_to_date DATE, rate_update_id BIGINT, rate_timestamp TIMESTAMP, rate_date DATE, "
        "rate_tgrk_punk DOUBLE, rate_tgrk_rub DOUBLE, is_rate_found BOOLEAN, is_rate_valid BOOLEAN, "
        "rate_selection_strategy STRING, gold_window_start DATE, gold_window_end DATE, "
        "gold_processed_at TIMESTAMP",
        "valid_from_date",
    ),
    "gold/fct_transactions_enriched": _table(
        "transaction_id BIGINT, user_id BIGINT, user_uuid STRING, amount DECIMAL(18,2), currency STRING, "
        "transaction_type STRING, status STRING, promo_code_id BIGINT, created_at TIMESTAMP, "
        "created_date DATE, file_date DATE, slot STRING, source_file STRING, raw_bucket STRING, "
        "raw_object_path STRING, transaction_loaded_at TIMESTAMP, transaction_processed_at TIMESTAMP, "
        "is_valid_transaction BOOLEAN, transaction_validation_errors ARRAY<STRING>, "
        f"{_typed(_TRANSACTION_FLAGS, 'BOOLEAN')}, "
        "is_purchase_type BOOLEAN, is_completed_status BOOLEAN, is_completed_purchase BOOLEAN, "
        "is_failed_status BOOLEAN, is_refund_type BOOLEAN, is_transfer_type BOOLEAN, "
        "is_user_found BOOLEAN, user_is_test_from_users BOOLEAN, user_is_test_from_test_users BOOLEAN, "
        "is_test_user BOOLEAN, user_segment STRING, "
        "promo_code STRING, promo_max_uses BIGINT, promo_expiry_date DATE, has_promo_code BOOLEAN, "
        "is_promo_found BOOLEAN, is_promo_missing_in_dictionary BOOLEAN, is_promo_expired BOOLEAN, "
        "rate_interval_id STRING, rate_timestamp TIMESTAMP, rate_date DATE, rate_tgrk_punk DOUBLE, "
        "rate_tgrk_rub DOUBLE, is_rate_found BOOLEAN, is_rate_valid BOOLEAN, "
        "rate_selection_strategy STRING, rate_time_diff_minutes DOUBLE, "
        "amount_tgrk DECIMAL(18,2), gross_amount_tgrk DECIMAL(18,2), "
        "duplicate_count BIGINT, duplicate_rank BIGINT, is_duplicate_transaction BOOLEAN, "
        "is_canonical_transaction BOOLEAN, "
        "is_cancelled BOOLEAN, cancellation_id BIGINT, cancelled_at TIMESTAMP, cancelled_date DATE, "
        "cancellation_reason STRING, refund_amount DECIMAL(18,2), refund_amount_tgrk DECIMAL(18,2), "
        "negative_refund_amount BOOLEAN, is_valid_cancellation BOOLEAN, "
        "cancellation_validation_errors ARRAY<STRING>, time_to_cancel_minutes DOUBLE, "
        "net_amount_tgrk DECIMAL(18,2), "
        "gold_window_start DATE, gold_window_end DATE, gold_processed_at TIMESTAMP",
        "file_date",
    ),
    "gold/latest_cancellations": _table(
        "cancellation_id BIGINT, original_transaction_id BIGINT, cancellation_reason STRING, cancelled_at TIMESTAMP, "
        "cancelled_date DATE, refund_amount DECIMAL(18,2), negative_refund_amount BOOLEAN, "
        "is_valid_cancellation BOOLEAN, cancellation_validation_errors ARRAY<STRING>, processed_at TIMESTAMP, "
        "source_day DATE, bucket BIGINT",
        "bucket",
    ),
    "control/pending_cancellations": _table("original_transaction_id BIGINT"),
    "gold/fact_days": _table(
        "created_date DATE, row_count BIGINT, gold_window_start DATE, gold_window_end DATE, file_date DATE",
        "file_date",
    ),
    "serving/transactions_cube_hourly": _table(
        "event_date DATE, event_hour TINYINT, currency STRING, transaction_type STRING, status STRING, "
        "user_segment STRING, is_purchase_type TINYINT, is_completed_status TINYINT, "
        "is_completed_purchase TINYINT, is_cancelled TINYINT, cancellation_reason STRING, "
        "rate_selection_strategy STRING, transactions_count BIGINT, canonical_transactions_count BIGINT, "
        "duplicate_transaction_id_rows_count BIGINT, unique_users_count BIGINT, "
        "gross_amount_tgrk DECIMAL(18,2), refund_amount_tgrk DECIMAL(18,2), net_amount_tgrk DECIMAL(18,2), "
        "negative_amount_count BIGINT, zero_amount_count BIGINT, cancelled_transactions_count BIGINT",
        "event_date",
    ),
    "quarantine/malformed_lines": _table(
        "line STRING, fields_read BIGINT, source_file STRING, raw_bucket STRING, raw_object_path STRING, "
        "loaded_at TIMESTAMP, source_name STRING, file_date DATE, slot STRING",
        "source_name",
        "file_date",
        "slot",
    ),
    "control/file_load_audit": _table(
        "run_id STRING, job_name STRING, source_name STRING, source_url STRING, raw_bucket STRING, "
        "raw_object_path STRING, target_table STRING, file_date DATE, slot STRING, status STRING, "
        "rows_read BIGINT, rows_written BIGINT, file_size_bytes BIGINT, error_message STRING, "
        "started_at TIMESTAMP, finished_at TIMESTAMP, created_at TIMESTAMP"
    ),
}

TRANSACTION_FLAGS = tuple(_TRANSACTION_FLAGS)
CUBE_KEYS = tuple(TABLES["serving/transactions_cube_hourly"].schema.names[:12])
CUBE_MEASURES = tuple(TABLES["serving/transactions_cube_hourly"].schema.names[12:])
