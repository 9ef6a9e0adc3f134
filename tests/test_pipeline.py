"""The whole chain on the fixture: landing files to cube, with every expected value."""

import json
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerwell.plans import jobs
from ledgerwell.plans.audit import AUDIT_TABLE, audit_trail, table_counts
from ledgerwell.schemas import TABLES
from ledgerwell.sources.lake import Lake
from tests.fixtures import DAY, land


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("raw"))
    lake = Lake(spark, str(tmp_path_factory.mktemp("lake")))
    land(root)
    jobs.load_dictionaries(lake, root, run_id="run-1")
    jobs.load_rates(lake, root, DAY, run_id="run-1")
    jobs.load_cancellations(lake, root, DAY, run_id="run-1")
    jobs.load_cancellations_bronze(lake, root, DAY, run_id="run-1")
    jobs.load_transactions(lake, root, DAY, "11-40", run_id="run-1")
    jobs.build_rate_intervals(lake, DAY, DAY, run_id="run-1")
    jobs.build_fact(lake, DAY, DAY, run_id="run-1")
    jobs.export_cube(lake, DAY, DAY, run_id="run-1", json_path=f"{root}/cube")
    return lake, root


def utc(text):
    return datetime.fromisoformat(text)


def test_intervals(built):
    lake, _ = built
    rows = [tuple(r) for r in lake.read(jobs.INTERVALS).orderBy("valid_from").select(
        "valid_from", "valid_to", "rate_tgrk_punk", "rate_tgrk_rub", "rate_selection_strategy", "rate_update_id",
        "rate_interval_id",
    ).collect()]
    first, second = utc("2026-04-27 08:53:20"), utc("2026-04-27 14:26:40")
    assert rows == [
        (utc("1900-01-01 00:00:00"), first, 2.0, 10.0, "backfill_next", 1, "1900-01-01 00:00:00"),
        (first, second, 2.0, 10.0, "asof_previous", 1, "2026-04-27 08:53:20"),
        (second, None, 2.6, 13.0, "asof_previous", 3, "2026-04-27 14:26:40"),
    ]


def money(text):
    return None if text is None else Decimal(text)


EXPECTED = {
    # (id, created second): segment, strategy, rate minutes, gross, refund, net, count, rank
    (101, 1777290000): ("real", "base_currency", None, "100.00", "0.00", "100.00", 1, 1),
    (102, 1777290000): ("anonymous", "asof_previous", -166.667, "25.25", "0.00", "25.25", 1, 1),
    (103, 1777270000): ("test", "backfill_next", 166.667, "20.00", "0.00", "20.00", 1, 1),
    (104, 1777310000): ("real", "asof_previous", -166.667, None, "0.00", None, 1, 1),
    (105, 1777300000): ("real", "asof_previous", 0.0, "-1.00", "0.50", "-1.50", 2, 2),
    (105, 1777300001): ("real", "asof_previous", -0.0167, "2.00", "0.50", "1.50", 2, 1),
    (None, 1777300000): ("real", "asof_previous", 0.0, "2.00", "0.00", "2.00", None, None),
    (106, None): ("real", "no_rate", None, None, "0.00", None, 1, 1),
}


def fact_rows(lake):
    rows = lake.read(jobs.FACT).withColumn("second", F.unix_timestamp("created_at")).collect()
    return {(r.transaction_id, r.second): r for r in rows}


def test_fact_values(built):
    lake, _ = built
    rows = fact_rows(lake)
    assert rows.keys() == EXPECTED.keys()
    for key, (segment, strategy, minutes, gross, refund, net, count, rank) in EXPECTED.items():
        row = rows[key]
        assert (row.user_segment, row.rate_selection_strategy) == (segment, strategy), key
        assert row.rate_time_diff_minutes == (None if minutes is None else pytest.approx(minutes, abs=1e-3)), key
        assert (row.gross_amount_tgrk, row.refund_amount_tgrk, row.net_amount_tgrk) == (
            money(gross), money(refund), money(net)
        ), key
        assert row.amount_tgrk == row.gross_amount_tgrk
        assert (row.duplicate_count, row.duplicate_rank) == (count, rank), key
        assert row.is_duplicate_transaction == ((count or 0) > 1)
        assert row.is_canonical_transaction is True
        assert (row.gold_window_start, row.gold_window_end) == (date(2026, 4, 27), date(2026, 4, 27))


def test_fact_flags(built):
    lake, _ = built
    rows = fact_rows(lake)
    r101, r102 = rows[101, 1777290000], rows[102, 1777290000]
    assert (r101.is_promo_found, r101.is_promo_expired, r101.promo_code) == (True, True, "SPRING")
    assert r101.is_cancelled is False and r101.cancellation_id is None
    assert r101.cancellation_reason == "late"
    assert r101.cancellation_validation_errors == ["invalid_cancelled_at"]
    assert r101.is_valid_cancellation is False
    assert r102.is_test_user and r102.is_valid_transaction and not r102.is_user_found
    assert r102.transaction_validation_errors == ["missing_user_id"]
    assert (r102.is_promo_found, r102.has_promo_code, r102.is_promo_expired) == (True, False, False)
    assert (r102.is_failed_status, r102.is_completed_purchase) == (True, False)
    r103 = rows[103, 1777270000]
    assert (r103.is_promo_found, r103.is_promo_expired, r103.is_transfer_type) == (True, False, True)
    r104 = rows[104, 1777310000]
    assert r104.transaction_validation_errors == ["unsupported_currency"]
    assert (r104.is_rate_found, r104.is_rate_valid, r104.is_user_found) == (True, True, False)
    assert (r104.is_promo_missing_in_dictionary, r104.is_promo_found, r104.is_promo_expired) == (True, False, False)
    older, newer = rows[105, 1777300000], rows[105, 1777300001]
    assert older.time_to_cancel_minutes == pytest.approx(93.333, abs=1e-3)
    assert newer.time_to_cancel_minutes == pytest.approx(93.317, abs=1e-3)
    assert older.cancellation_id == newer.cancellation_id == 2 and older.is_cancelled
    assert older.cancellation_reason == "error" and older.refund_amount == Decimal("6.50")
    assert older.negative_amount and older.is_refund_type
    r106 = rows[106, None]
    assert r106.transaction_validation_errors == [
        "missing_transaction_type", "missing_status", "invalid_created_at",
    ]
    assert (r106.is_purchase_type, r106.is_completed_purchase, r106.is_failed_status) == (None, None, None)
    assert (r106.is_rate_found, r106.is_rate_valid) == (False, False)


def test_fact_and_cube_types(built):
    lake, _ = built
    for name in (jobs.FACT, jobs.CUBE, jobs.TRANSACTIONS, jobs.INTERVALS):
        assert [(f.name, f.dataType) for f in lake.read(name).schema] == [
            (f.name, f.dataType) for f in TABLES[name].schema
        ]
    assert len(TABLES[jobs.FACT].schema) == 84
    assert len(TABLES[jobs.CUBE].schema) == 22


def test_cube(built):
    lake, root = built
    cube = lake.read(jobs.CUBE)
    assert cube.count() == 7
    totals = cube.agg(
        *[F.sum(n).alias(n) for n in TABLES[jobs.CUBE].schema.names[12:]]
    ).first().asDict()
    assert totals == {
        "transactions_count": 7,
        "canonical_transactions_count": 7,
        "duplicate_transaction_id_rows_count": 2,
        "unique_users_count": 6,
        "gross_amount_tgrk": Decimal("148.25"),
        "refund_amount_tgrk": Decimal("1.00"),
        "net_amount_tgrk": Decimal("147.25"),
        "negative_amount_count": 1,
        "zero_amount_count": 0,
        "cancelled_transactions_count": 2,
    }
    lines = [json.loads(r.value) for r in lake.spark.read.text(f"{root}/cube").collect()]
    assert len(lines) == 7
    assert list(lines[0]) == TABLES[jobs.CUBE].schema.names
    base = next(line for line in lines if line["currency"] == "TGRK")
    assert (base["event_date"], base["event_hour"], base["gross_amount_tgrk"]) == ("2026-04-27", 11, "100.00")


def test_bronze_keeps_text(built):
    lake, _ = built
    rows = lake.read(jobs.CANCELLATIONS_BRONZE).orderBy(F.col("cancellation_id")).collect()
    assert [r.refund_amount for r in rows] == ["13,00", "6.50", "1", "10"]
    assert rows[0].file_date == DAY
    assert rows[0].raw_object_path == f"cancellations/day={DAY}/cancellations.jsonl"


def test_audit_of_run(built):
    lake, _ = built
    trail = audit_trail(lake, "run-1").collect()
    assert [(r.job_name, r.status, r.rows_written) for r in trail] == [
        ("load_dictionaries", "loaded", 3),
        ("load_dictionaries", "loaded", 1),
        ("load_dictionaries", "loaded", 2),
        ("load_rates", "loaded", 5),
        ("load_cancellations", "loaded", 4),
        ("load_cancellations_bronze", "loaded", 4),
        ("load_transactions", "loaded", 8),
        ("build_rate_intervals", "loaded", 3),
        ("build_fact", "loaded", 8),
        ("export_cube", "loaded", 7),
    ]
    reads = {r.job_name: r.rows_read for r in lake.read(AUDIT_TABLE).collect()}
    assert (reads["build_rate_intervals"], reads["export_cube"]) == (2, 7)


def test_table_counts(built):
    lake, _ = built
    counts = {r.table_name: r.row_count for r in table_counts(lake, [jobs.FACT, "dictionaries/users"]).collect()}
    assert counts == {jobs.FACT: 8, "dictionaries/users": 3}


def test_published_tables_answer_sql(built):
    lake, _ = built
    name = lake.publish(jobs.FACT, "gold")
    lake.publish(jobs.FACT, "gold")
    n = lake.spark.sql(f"SELECT count(*) FROM {name} WHERE file_date = DATE'2026-04-27'").first()[0]
    assert n == 8


def test_fact_is_the_same_when_every_key_counts_as_hot_and_no_lookup_as_small(built):
    lake, _ = built
    stamps = {"transaction_processed_at", "gold_processed_at"}
    names = [n for n in TABLES[jobs.FACT].schema.names if n not in stamps]
    spread = jobs.fact_of(lake, DAY, DAY, hot_rows=1, broadcast_rows=0)
    as_set = lambda df: sorted(str(r) for r in df.select(*names).collect())
    assert as_set(spread) == as_set(lake.read(jobs.FACT))
