"""Repeatable loads, audit on failure, windows, calendar, streaming, late cancellations."""

import os
from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F

from ledgerwell.operators.cube import hourly_cube
from ledgerwell.plans import calendar, jobs
from ledgerwell.plans.audit import AUDIT_TABLE
from ledgerwell.schemas import TABLES
from ledgerwell.session import object_store_settings
from ledgerwell.streaming.ingest import ingest_transactions
from tests.fixtures import DAY, TRANSACTION_FIELDS, TRANSACTIONS, as_dicts, land, write_lines


def tx_path(root, day, slot):
    return f"{root}/transactions/day={day}/slot={slot}/transactions.jsonl"


def ids(lake):
    rows = lake.read(jobs.TRANSACTIONS).select("slot", "transaction_id_raw").collect()
    return sorted((r.slot, r.transaction_id_raw or "") for r in rows)


def test_reload_replaces_only_its_partition(lake, tmp_path):
    root = str(tmp_path / "raw")
    all_rows = as_dicts(TRANSACTION_FIELDS, TRANSACTIONS)
    write_lines(tx_path(root, DAY, "11-40"), all_rows)
    write_lines(tx_path(root, DAY, "11-50"), all_rows[:2])
    assert jobs.load_transactions(lake, root, DAY, "11-40") == 8
    assert jobs.load_transactions(lake, root, DAY, "11-50") == 2
    once = ids(lake)
    assert jobs.load_transactions(lake, root, DAY, "11-40") == 8
    assert ids(lake) == once
    write_lines(tx_path(root, DAY, "11-40"), all_rows[:3])
    jobs.load_transactions(lake, root, DAY, "11-40")
    assert [i for i in ids(lake) if i[0] == "11-40"] == [("11-40", "101"), ("11-40", "102"), ("11-40", "103")]
    write_lines(tx_path(root, DAY, "11-40"), [])
    assert jobs.load_transactions(lake, root, DAY, "11-40") == 0
    assert {i[0] for i in ids(lake)} == {"11-50"}
    assert lake.read(AUDIT_TABLE).where("status = 'loaded'").count() == 5


def test_missing_file_is_audited_and_raised(lake, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        jobs.load_transactions(lake, str(tmp_path / "raw"), DAY, "11-40", run_id="r")
    (event,) = lake.read(AUDIT_TABLE).collect()
    assert (event.run_id, event.status, event.rows_read, event.rows_written) == ("r", "failed", None, None)
    assert 0 < len(event.error_message) <= 4000
    assert (event.file_date, event.slot, event.target_table) == (date(2026, 4, 27), "11-40", jobs.TRANSACTIONS)


def test_missing_rates_may_be_no_error(lake, tmp_path):
    assert jobs.load_rates(lake, str(tmp_path / "raw"), DAY, missing_ok=True) is None
    assert not os.path.exists(lake.path(AUDIT_TABLE))


def test_a_missing_source_table_is_an_error(lake, tmp_path):
    root = str(tmp_path / "raw")
    land(root)
    jobs.load_transactions(lake, root, DAY, "11-40")
    jobs.load_dictionaries(lake, root)
    jobs.load_cancellations(lake, root, DAY)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        jobs.build_fact(lake, DAY, DAY, run_id="r")
    (event,) = lake.read(AUDIT_TABLE).where("run_id = 'r'").collect()
    assert (event.status, event.rows_written) == ("failed", None)
    assert not os.path.exists(lake.path(jobs.INTERVALS)) and not os.path.exists(lake.path(jobs.FACT))


def test_ensure_keeps_an_existing_table(lake, spark):
    name = "dictionaries/test_users"
    lake.replace(name, spark.createDataFrame([("a", "f", None)], TABLES[name].schema))
    lake.ensure(name)
    assert lake.read(name).count() == 1


def fact_of(spark, rows):
    """A fact with only what the cube reads: (file day, created second, id, amount)."""
    base = spark.createDataFrame(rows, "file_date string, s long, user_id long, net double")
    known = {
        "file_date": F.col("file_date").cast("date"), "created_at": F.timestamp_seconds("s"),
        "created_date": F.to_date(F.timestamp_seconds("s")), "user_id": F.col("user_id"),
        "gross_amount_tgrk": F.col("net").cast("decimal(18,2)"),
        "net_amount_tgrk": F.col("net").cast("decimal(18,2)"),
    }
    return base.select(*[
        known.get(f.name, F.lit(None).cast(f.dataType)).alias(f.name) for f in TABLES[jobs.FACT].schema
    ])


def test_cube_windows_do_not_count_twice(lake, spark):
    start = 1777248000  # 2026-04-27 00:00
    rows = [("2026-04-28", start + 86399, 1, 1.0), ("2026-04-27", start + 86400, 2, 2.0), ("2026-04-27", start, 3, 4.0)]
    lake.replace(jobs.FACT, fact_of(spark, rows))
    for window in (("2026-04-27", "2026-04-27"), ("2026-04-28", "2026-04-28"), ("2026-04-27", "2026-04-28")) * 2:
        jobs.export_cube(lake, *window)
    totals = lake.read(jobs.CUBE).agg(F.sum("transactions_count"), F.sum("net_amount_tgrk")).first()
    assert (totals[0], float(totals[1])) == (3, 7.0)
    assert [r.event_date for r in lake.read(jobs.CUBE).select("event_date").distinct().orderBy("event_date").collect()] == [
        date(2026, 4, 27), date(2026, 4, 28),
    ]
    lake.replace(jobs.FACT, fact_of(spark, rows[:1]))
    assert jobs.export_cube(lake, "2026-04-27", "2026-04-28") == 1
    assert lake.read(jobs.CUBE).count() == 1


def test_days_of_a_window_longer_than_a_bitmap(spark, lake):
    """Both days are stored; the window is replaced by the late one alone, then by the early one."""
    early, late = ("1950-01-01", -631152000, 1, 1.0), ("2039-09-19", 2200003200, 2, 1.0)
    window = ("1950-01-01", "2039-09-19")
    for rows in ([early, late], [late], [early], []):
        cells = hourly_cube(fact_of(spark, rows), *window)
        assert lake.overwrite_days(jobs.CUBE, cells, *window) == len(rows)
        assert {r.event_date.isoformat() for r in lake.read(jobs.CUBE).collect()} == {r[0] for r in rows}


def test_unknowns_in_the_cube(spark):
    cell = hourly_cube(fact_of(spark, [("2026-04-27", 1777248000, None, None)]), "2026-04-27", "2026-04-27").first()
    assert (cell.currency, cell.user_segment, cell.cancellation_reason) == ("unknown", "unknown", "")
    assert (cell.is_purchase_type, cell.unique_users_count, float(cell.gross_amount_tgrk)) == (0, 0, 0.0)


def test_calendar(spark, lake):
    expected = calendar.expected_slots(spark, "2026-04-27", "2026-04-28")
    assert expected.count() == 288
    first, last = expected.orderBy("day", "slot").first(), expected.orderBy(F.desc("day"), F.desc("slot")).first()
    assert (first.day, first.slot, last.day, last.slot) == (date(2026, 4, 27), "00-00", date(2026, 4, 28), "23-50")
    assert calendar.expected_slots(spark, "2026-04-27", "2026-04-27", "00-20").count() == 3
    loaded = spark.createDataFrame([(date(2026, 4, 27), "00-00"), (date(2026, 4, 27), "00-20")], "day date, slot string")
    missing = [(r.day.isoformat(), r.slot) for r in calendar.missing_slots(expected, loaded).collect()]
    assert len(missing) == 20 and missing[:2] == [("2026-04-27", "00-10"), ("2026-04-27", "00-30")]
    days = calendar.missing_days(calendar.expected_days(spark, "2026-04-27", "2026-04-29"), loaded).collect()
    assert [r.day.day for r in days] == [28, 29]
    assert calendar.expected_days(spark, "2026-04-27", "2026-04-26").count() == 0


def test_last_complete_slot(spark):
    # 00:05 in Moscow is 21:05 of the day before in UTC.
    now = datetime(2026, 4, 28, 21, 5, tzinfo=timezone.utc)
    assert calendar.last_complete_slot_now(now) == (date(2026, 4, 28), "23-50")
    assert calendar.last_day_for_cancellations(now) == date(2026, 4, 27)
    assert calendar.last_day_for_rates(now) == date(2026, 4, 29)
    assert calendar.rebuild_window(now) == (date(2026, 4, 27), date(2026, 4, 29))
    day, slot = calendar.last_complete_slot(F.lit("2026-04-28 21:05:00").cast("timestamp"))
    assert tuple(spark.range(1).select(day, slot).first()) == (date(2026, 4, 28), "23-50")


def test_stream_loads_new_files_once(lake, tmp_path):
    root, progress = str(tmp_path / "raw"), str(tmp_path / "progress")
    all_rows = as_dicts(TRANSACTION_FIELDS, TRANSACTIONS)
    write_lines(tx_path(root, DAY, "11-40"), all_rows)
    write_lines(tx_path(root, DAY, "11-50"), all_rows[:2])
    ingest_transactions(lake, root, progress).awaitTermination()
    assert len(ids(lake)) == 10
    write_lines(tx_path(root, "2026-04-28", "00-00"), all_rows[:1])
    ingest_transactions(lake, root, progress).awaitTermination()
    rows = lake.read(jobs.TRANSACTIONS).groupBy("file_date", "slot", "raw_object_path").count().collect()
    assert sorted((str(r.file_date), r.slot, r["count"]) for r in rows) == [
        ("2026-04-27", "11-40", 8), ("2026-04-27", "11-50", 2), ("2026-04-28", "00-00", 1),
    ]
    assert rows[0].raw_object_path.startswith("transactions/day=2026-04-2")
    loaded = calendar.loaded_partitions(lake.read(AUDIT_TABLE), jobs.TRANSACTIONS)
    assert loaded.count() == 3
    missing = calendar.missing_slots(calendar.expected_slots(lake.spark, DAY, DAY), loaded, limit=500)
    assert missing.count() == 142


def test_stream_keeps_every_file_of_a_slot(lake, tmp_path):
    """Files of one slot in batches of one file, then one more in a later run; a replay changes nothing."""
    root, progress = str(tmp_path / "raw files"), str(tmp_path / "progress")
    all_rows = as_dicts(TRANSACTION_FIELDS, TRANSACTIONS)
    folder = f"{root}/transactions/day={DAY}/slot=11-40"
    for nth in range(3):
        write_lines(f"{folder}/part-{nth}.jsonl", all_rows[nth : nth + 1])
    files = {"files_per_batch": 1, "file_glob": "*.jsonl"}
    ingest_transactions(lake, root, progress, **files).awaitTermination()
    assert [i for _, i in ids(lake)] == ["101", "102", "103"]
    write_lines(f"{folder}/part-3.jsonl", all_rows[:1])
    ingest_transactions(lake, root, progress, **files).awaitTermination()
    assert [i for _, i in ids(lake)] == ["101", "101", "102", "103"]
    events = lake.read(AUDIT_TABLE).groupBy("raw_object_path").agg(F.sum("rows_written").alias("n")).collect()
    assert sorted(e.n for e in events) == [1, 1, 1, 1]
    ingest_transactions(lake, root, str(tmp_path / "again"), **files).awaitTermination()
    assert [i for _, i in ids(lake)] == ["101", "101", "102", "103"]


def test_a_failed_batch_is_audited_and_raised(lake, tmp_path, monkeypatch):
    root = str(tmp_path / "raw")
    write_lines(tx_path(root, DAY, "11-40"), as_dicts(TRANSACTION_FIELDS, TRANSACTIONS))

    def broken(name, df):
        raise OSError("no space")

    monkeypatch.setattr(lake, "overwrite_partitions", broken)
    with pytest.raises(Exception, match="no space"):
        ingest_transactions(lake, root, str(tmp_path / "progress")).awaitTermination()
    (event,) = lake.read(AUDIT_TABLE).collect()
    assert event.status == "failed" and "no space" in event.error_message


def test_late_cancellation_names_its_file_date(lake, tmp_path, spark):
    root = str(tmp_path / "raw")
    land(root)
    jobs.load_transactions(lake, root, DAY, "11-40")
    late = "2026-05-02"
    write_lines(
        f"{root}/cancellations/day={late}/cancellations.jsonl",
        [{"cancellation_id": "9", "original_transaction_id": "103", "reason": "late", "cancelled_at": "2026 May 02 10:00"}],
    )
    jobs.load_cancellations(lake, root, late)
    new = lake.read(jobs.CANCELLATIONS).where(F.col("file_date") == late)
    hit = calendar.affected_dates(lake.read(jobs.TRANSACTIONS), new).collect()
    assert [r.file_date for r in hit] == [date(2026, 4, 27)]


def test_reading_a_window_prunes_partitions(lake, tmp_path):
    root = str(tmp_path / "raw")
    land(root)
    jobs.load_transactions(lake, root, DAY, "11-40")
    jobs.load_rates(lake, root, DAY)
    jobs.load_dictionaries(lake, root)
    jobs.load_cancellations(lake, root, DAY)
    jobs.build_rate_intervals(lake, DAY, DAY)
    plan = jobs.fact_of(lake, DAY, DAY)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(file_date" in plan or "PartitionFilters: [(file_date" in plan
    for unwanted in ("NestedLoop", "Cartesian", "EvalPython"):
        assert unwanted not in plan


def test_a_day_is_not_written_by_every_task(lake, spark):
    rows = [(f"2026-04-{20 + i % 3}", 1777248000, i, 1.0) for i in range(600)]
    lake.replace(jobs.FACT, fact_of(spark, rows).repartition(8))
    files = spark.read.parquet(lake.path(jobs.FACT)).select("_metadata.file_path").distinct().count()
    assert files == 3


def test_object_store_settings():
    settings = object_store_settings("http://store:9000", "key", "secret")
    assert settings["spark.hadoop.fs.s3a.endpoint"] == "http://store:9000"
    assert settings["spark.hadoop.fs.s3a.connection.ssl.enabled"] == "false"


def test_no_internal_or_random_state_is_left_in_the_lake(lake, tmp_path):
    root = str(tmp_path / "raw")
    land(root)
    jobs.load_dictionaries(lake, root)
    assert sorted(os.listdir(f"{lake.root}/dictionaries")) == ["promo_codes", "test_users", "users"]
