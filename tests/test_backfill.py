"""Batch backfill from the list of missing slots, and malformed lines kept aside."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from ledgerwell.plans import backfill, jobs
from ledgerwell.plans.audit import AUDIT_TABLE
from ledgerwell.sources import quarantine
from ledgerwell.sources.lake import Lake
from tests import fixtures

DAY = date.fromisoformat(fixtures.DAY)
BAD = ['{"transaction_id": "9", "amount": abc', "no json at all"]
SLOTS = ["00-10", "00-20", "00-30", "00-40"]


def land(root, slot, rows):
    fixtures.write_lines(f"{root}/transactions/day={DAY}/slot={slot}/transactions.jsonl", rows)


def lines_of(rows):
    return fixtures.as_dicts(fixtures.TRANSACTION_FIELDS, rows)


@pytest.fixture
def landed(tmp_path, spark):
    """Three files, one of them empty; the fourth slot never landed."""
    root = str(tmp_path / "raw")
    land(root, SLOTS[0], [*lines_of(fixtures.TRANSACTIONS[:3]), *BAD])
    land(root, SLOTS[1], [])
    land(root, SLOTS[2], lines_of(fixtures.TRANSACTIONS[3:]))
    return root, spark.createDataFrame([(DAY, slot) for slot in SLOTS], "day date, slot string")


def stored(lake):
    held = lake.read(jobs.TRANSACTIONS).drop("loaded_at", "processed_at", "source_file")
    return sorted(map(str, held.collect()))


def aside(lake):
    return sorted((r["slot"], r["line"]) for r in lake.read(quarantine.TABLE).collect())


def test_backfill_equals_single_loads(lake, landed, spark, tmp_path):
    root, expected = landed
    done = backfill.catch_up(lake, root, expected, 20)
    assert done.absent == [(DAY, SLOTS[3])] and done.rows == len(fixtures.TRANSACTIONS) + len(BAD)
    single = Lake(spark, str(tmp_path / "single"))
    for slot in SLOTS[:3]:
        jobs.load_transactions(single, root, str(DAY), slot)
    assert stored(lake) == stored(single)
    assert aside(lake) == aside(single) == sorted((SLOTS[0], line) for line in BAD)
    events = {r["slot"]: r for r in lake.read(AUDIT_TABLE).collect()}
    assert {s: r["rows_written"] for s, r in events.items()} == {SLOTS[0]: 5, SLOTS[1]: 0, SLOTS[2]: 5}
    assert events[SLOTS[1]]["file_size_bytes"] == 0 and events[SLOTS[0]]["file_size_bytes"] > 100
    assert {r["status"] for r in events.values()} == {"loaded"}
    # What has landed is not missing any more; what has not stays so.
    assert backfill.missing_transactions(lake, expected, 20) == [(DAY, SLOTS[3])]
    assert backfill.catch_up(lake, root, expected, 20).files == []


def test_limit_takes_the_oldest(lake, landed):
    root, expected = landed
    assert [f.slot for f in backfill.catch_up(lake, root, expected, 2).files] == SLOTS[:2]
    assert [f.slot for f in backfill.catch_up(lake, root, expected, 1).files] == SLOTS[2:3]


def test_slots_delivered_again_replace_only_themselves(lake, landed):
    root, _ = landed
    slots = [(DAY, slot) for slot in SLOTS]
    backfill.load_slots(lake, root, slots)
    land(root, SLOTS[0], lines_of(fixtures.TRANSACTIONS[:1]))
    land(root, SLOTS[2], [])
    assert backfill.load_slots(lake, root, [slots[0]]).rows == 1
    counts = {r[0]: r[1] for r in lake.read(jobs.TRANSACTIONS).groupBy("slot").count().collect()}
    assert counts == {SLOTS[0]: 1, SLOTS[2]: 5} and aside(lake) == []
    assert backfill.load_slots(lake, root, [slots[2]]).rows == 0
    counts = {r[0]: r[1] for r in lake.read(jobs.TRANSACTIONS).groupBy("slot").count().collect()}
    assert counts == {SLOTS[0]: 1}


def test_a_failed_backfill_leaves_the_slots_missing(lake, landed, monkeypatch):
    root, expected = landed

    def broken(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(quarantine, "replace", broken)
        with pytest.raises(RuntimeError):
            backfill.catch_up(lake, root, expected, 20)
    assert [r["status"] for r in lake.read(AUDIT_TABLE).collect()] == ["failed"]
    assert backfill.catch_up(lake, root, expected, 20).rows == 10
    assert stored(lake) and len(aside(lake)) == 2


def test_malformed_lines_of_daily_files(lake, tmp_path):
    root = str(tmp_path / "raw")
    fixtures.write_lines(f"{root}/exchange_rates/day={DAY}/rates.jsonl", [*fixtures.RATES, "{broken"])
    path = f"{root}/cancellations/day={DAY}/cancellations.jsonl"
    whole = fixtures.as_dicts(fixtures.CANCELLATION_FIELDS, fixtures.CANCELLATIONS)
    fixtures.write_lines(path, [*whole, BAD[1]])
    assert jobs.load_rates(lake, root, str(DAY)) == len(fixtures.RATES) + 1
    jobs.load_cancellations(lake, root, str(DAY))
    kept = {(r["source_name"], r["slot"], r["line"]) for r in lake.read(quarantine.TABLE).collect()}
    assert kept == {("exchange_rates", quarantine.WHOLE_DAY, "{broken"), ("cancellations", quarantine.WHOLE_DAY, BAD[1])}
    fixtures.write_lines(path, whole)
    jobs.load_cancellations(lake, root, str(DAY))
    assert [r[0] for r in lake.read(quarantine.TABLE).select("source_name").collect()] == ["exchange_rates"]
    # The line is gone from the table too; one cancellation has no id of its own.
    assert lake.read(jobs.CANCELLATIONS).count() == len(whole)
    assert lake.read(jobs.CANCELLATIONS).where(F.col("cancellation_id_raw").isNull()).count() == 0
