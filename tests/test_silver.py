"""Every parser and rule on single values."""

from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerwell.functions import text
from ledgerwell.operators import silver
from ledgerwell.schemas import RAW_CANCELLATIONS, RAW_RATES, RAW_TRANSACTIONS
from ledgerwell.sources import jsonl
from tests.fixtures import CANCELLATION_FIELDS, TRANSACTION_FIELDS, write_lines

GOOD_TX = dict(
    zip(TRANSACTION_FIELDS, ("1", "2", "u-2", "10", "RUB", "purchase", "3", "completed", "1777290000"))
)
GOOD_RATE = {"update_id": "1", "timestamp": "1777290000", "rate_tgrk_punk": "2", "rate_tgrk_rub": "3"}
GOOD_CANCEL = dict(zip(CANCELLATION_FIELDS, ("1", "2", "late", "2026 Apr 27 15:00", "1")))

# field, text, typed value, flags
TX_CASES = [
    ("transaction_id", " 42 ", 42, []),
    ("transaction_id", "-7", -7, []),
    *[("transaction_id", t, None, ["missing_transaction_id"]) for t in (None, "", " NONE ", "null", "NaN")],
    *[("transaction_id", t, None, ["invalid_transaction_id"]) for t in ("abc", "12.5", "9" * 20)],
    ("user_id", None, None, ["missing_user_id"]),
    ("user_id", "x", None, ["invalid_user_id"]),
    ("user_uuid", " AbC ", "AbC", []),
    ("user_uuid", " none ", None, ["missing_user_uuid"]),
    ("amount", "10,50", Decimal("10.50"), []),
    ("amount", "1.005", Decimal("1.01"), []),
    ("amount", "1e3", Decimal("1000.00"), []),
    ("amount", "nan", None, ["missing_amount"]),
    ("amount", "1,234.50", None, ["invalid_amount"]),
    ("amount", "99999999999999999", None, ["invalid_amount"]),
    ("amount", "-3", Decimal("-3.00"), ["negative_amount"]),
    ("amount", "0.004", Decimal("0.00"), ["zero_amount"]),
    ("currency", " rub ", "RUB", []),
    ("currency", "None", None, ["missing_currency"]),
    ("currency", "usd", "USD", ["unsupported_currency"]),
    ("transaction_type", "Purchase", "purchase", []),
    ("transaction_type", "", None, ["missing_transaction_type"]),
    ("transaction_type", "gift", "gift", ["unsupported_transaction_type"]),
    ("status", " Odd ", "odd", []),
    ("status", "null", None, ["missing_status"]),
    ("promo_code_id", None, None, []),
    ("promo_code_id", "none", None, []),
    ("promo_code_id", "p", None, ["invalid_promo_code_id"]),
    ("created_at", "1777290000", datetime(2026, 4, 27, 11, 40), []),
    ("created_at", None, None, ["missing_created_at"]),
    ("created_at", "1777290000000", None, ["invalid_created_at"]),
    ("created_at", "9" * 18, None, ["invalid_created_at"]),
    ("created_at", "2026-04-27", None, ["invalid_created_at"]),
]
TX_WARNINGS = {"missing_user_id", "missing_user_uuid", "negative_amount", "zero_amount"}

RATE_CASES = [
    ("update_id", "none", None, ["missing_update_id"]),
    ("update_id", "12.5", None, ["invalid_update_id"]),
    ("timestamp", "", None, ["missing_timestamp"]),
    ("timestamp", "soon", None, ["invalid_timestamp"]),
    ("rate_tgrk_punk", "0", 0.0, ["non_positive_rate_tgrk_punk"]),
    ("rate_tgrk_rub", "-1", -1.0, ["non_positive_rate_tgrk_rub"]),
    ("rate_tgrk_punk", "abc", None, ["invalid_rate_tgrk_punk", "missing_rate_tgrk_punk"]),
    ("rate_tgrk_rub", None, None, ["missing_rate_tgrk_rub"]),
    ("rate_tgrk_punk", " infinity", float("inf"), []),
]

CANCEL_CASES = [
    ("cancelled_at", "2026 apr 27 10:15", datetime(2026, 4, 27, 10, 15), []),
    ("cancelled_at", None, None, []),
    ("cancelled_at", "  ", None, []),
    ("cancelled_at", "none", None, ["invalid_cancelled_at"]),
    ("cancelled_at", "2026-04-27", None, ["invalid_cancelled_at"]),
    ("cancelled_at", "2026 Apr 7 1:5", None, ["invalid_cancelled_at"]),
    ("cancellation_id", "null", None, []),
    ("cancellation_id", "c", None, ["invalid_cancellation_id"]),
    ("original_transaction_id", None, None, []),
    ("original_transaction_id", "#", None, ["invalid_original_transaction_id"]),
    ("refund_amount", "13,00", Decimal("13.00"), []),
    ("refund_amount", None, None, []),
    ("refund_amount", "x", None, ["invalid_refund_amount"]),
    ("refund_amount", "-1", Decimal("-1.00"), ["negative_refund_amount"]),
    ("reason", " Fraud ", "fraud", []),
    ("reason", "none", None, ["missing_reason"]),
]


def check(spark, clean, schema, good, cases, warnings, typed_names):
    rows = [(i, *[{**good, field: text}[n] for n in schema.names]) for i, (field, text, _, _) in enumerate(cases)]
    raw = spark.createDataFrame(rows, "i int, " + ", ".join(f"{n} string" for n in schema.names))
    results = {r.i: r for r in clean(raw).collect()}
    assert len(results) == len(cases)
    for i, (field, text, value, flags) in enumerate(cases):
        row = results[i]
        case = (field, text)
        assert row[typed_names.get(field, field)] == value, case
        assert row[f"{field}_raw"] == text, case
        assert row.validation_errors == flags, case
        assert row.is_valid_record == (not set(flags) - warnings), case
        fired = [n for n in row.asDict() if n.startswith(("missing_", "invalid_", "negative_", "zero_", "unsup", "non_"))
                 and row[n]]
        assert sorted(fired) == sorted(flags), case
        assert None not in [row[n] for n in row.asDict() if n.startswith(("missing_", "invalid_", "negative_"))]


def test_transactions(spark):
    check(spark, silver.clean_transactions, RAW_TRANSACTIONS, GOOD_TX, TX_CASES, TX_WARNINGS, {})


def test_rates(spark):
    check(
        spark, silver.clean_rates, RAW_RATES, GOOD_RATE, RATE_CASES, set(), {"timestamp": "rate_timestamp"}
    )


def test_cancellations(spark):
    check(
        spark, silver.clean_cancellations, RAW_CANCELLATIONS, GOOD_CANCEL, CANCEL_CASES,
        {"negative_refund_amount"}, {},
    )


def test_all_rules_at_once_keep_their_order(spark, tmp_path):
    write_lines(str(tmp_path / "t.jsonl"), ["{bad", GOOD_TX, {"amount": 12.5, "transaction_id": 7}])
    rows = silver.clean_transactions(jsonl.read_transactions(spark, str(tmp_path / "t.jsonl"))).collect()
    assert len(rows) == 3
    broken = next(r for r in rows if r.validation_errors and r.transaction_id is None)
    assert broken.validation_errors == [
        "missing_transaction_id", "missing_user_id", "missing_user_uuid", "missing_amount", "missing_currency",
        "missing_transaction_type", "missing_status", "missing_created_at",
    ]
    numbers = next(r for r in rows if r.transaction_id == 7)
    assert (numbers.amount_raw, numbers.amount) == ("12.5", Decimal("12.50"))
    assert all(r.source_file.endswith("/t.jsonl") for r in rows)


@pytest.mark.parametrize("clean", [silver.clean_transactions, silver.clean_rates, silver.clean_cancellations])
def test_no_python_in_the_plan(spark, clean):
    schema = {
        silver.clean_transactions: RAW_TRANSACTIONS,
        silver.clean_rates: RAW_RATES,
        silver.clean_cancellations: RAW_CANCELLATIONS,
    }[clean]
    plan = clean(spark.createDataFrame([], schema))._jdf.queryExecution().executedPlan().toString()
    assert "EvalPython" not in plan


def test_guards_before_casts_change_no_value(spark):
    """Texts no cast reads are NULL without a try, which would raise inside the engine; what is left is as before."""
    texts = [
        None, "", "1", "-7", "+7", " 8 ", "\t9\n", "12.5", "1e3", "x1", "#", "c1", "1_0", "99999999999999999999", "--1", "１２",
        "1,5", "1.5", "-0,005", "1.234,50", "1,234.50", ".5", "5.", "1e2", "2e-1", "1d", "1f", "nan", "inf", "99999999999999999", "1 2",
        "2024 Jan 05 01:30", " 2024 Feb 29 23:59 ", "2023 Feb 29 01:30", "2024 jan 05 01:30", "2024 JAN 05 01:30",
        "2024 Jan 5 01:30", "2024 Jan 05 24:00", "2024 Jan 05 01:60", "0000 Jan 05 01:30", "0001 Jan 01 00:00",
        "12024 Jan 05 01:30", "+12024 Jan 05 01:30", "2024 Foo 05 01:30", "2024 anF 05 01:30", "2024 Jan 05 01:30:00",
        "2024 Jan 05 01:30\n", "2024-01-05 01:30", "2024 Sept 05 01:30", "9999 Dec 31 23:59", "none",
    ]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    t = F.col("t")
    found = rows.select(
        text.parse_long(t).alias("long"), t.try_cast("bigint").alias("long_before"),
        text.parse_money(t).alias("money"), F.translate(t, ",", ".").try_cast("decimal(18,2)").alias("money_before"),
        text.parse_cancelled_at(t).cast("string").alias("at"),
        F.try_to_timestamp(F.trim(t), F.lit(text.CANCELLED_AT_FORMAT)).cast("string").alias("at_before"),
        "t",
    ).collect()
    assert [r for r in found if (r["long"], r["money"], r["at"]) != (r["long_before"], r["money_before"], r["at_before"])] == []
    assert sum(r["at"] is not None for r in found) >= 6 and sum(r["long"] is not None for r in found) >= 5
    guarded = rows.select(text.parse_long(t), text.parse_money(t))._jdf.queryExecution().optimizedPlan().toString()
    assert guarded.count("CASE WHEN NOT RLIKE") == 2
