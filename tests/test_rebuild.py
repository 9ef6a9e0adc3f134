"""Late cancellations: what is replaced, what stays, and what a failed run leaves for the next one."""

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from ledgerwell.operators.cube import hourly_cube
from ledgerwell.operators.latest import LATEST, PENDING, merge_latest
from ledgerwell.plans import jobs, rebuild
from ledgerwell.schemas import TABLES
from tests import fixtures

OLD, NEXT, RECENT = date(2026, 4, 27), date(2026, 4, 28), date(2026, 6, 2)
WINDOWS = [(OLD, NEXT), (RECENT, RECENT)]


def noon(day):
    return 1777248000 + 86400 * (day - OLD).days + 43200


def transaction(number, at, amount="10"):
    return (str(number), "1", "u-1", amount, "TGRK", "purchase", None, "completed", str(at))


def land(lake, root, day, rows):
    fixtures.write_lines(
        f"{root}/cancellations/day={day}/cancellations.jsonl", fixtures.as_dicts(fixtures.CANCELLATION_FIELDS, rows)
    )
    jobs.load_cancellations(lake, str(root), str(day))


@pytest.fixture
def built(lake, tmp_path, spark):
    """Three file days; the first also holds a row of the event day before the last."""
    root = tmp_path / "raw"
    fixtures.write_lines(f"{root}/exchange_rates/day={OLD}/rates.jsonl", fixtures.RATES)
    for name, rows in (("users", fixtures.USERS), ("test_users", fixtures.TEST_USERS), ("promo_codes", fixtures.PROMO_CODES)):
        fixtures.write_lines(f"{root}/dictionaries/{name}.jsonl", rows)
    straddling = noon(RECENT - timedelta(days=1))
    files = {
        OLD: [transaction(1, noon(OLD)), transaction(2, noon(OLD)), transaction(2, noon(OLD) + 60), transaction(9, straddling)],
        NEXT: [transaction(2, noon(NEXT)), transaction(3, noon(NEXT))],
        RECENT: [transaction(4, noon(RECENT)), transaction(5, straddling), transaction(None, noon(RECENT))],
    }
    jobs.load_dictionaries(lake, str(root))
    jobs.load_rates(lake, str(root), str(OLD))
    jobs.build_rate_intervals(lake, OLD, OLD)
    for day, rows in files.items():
        path = f"{root}/transactions/day={day}/slot=11-40/transactions.jsonl"
        fixtures.write_lines(path, fixtures.as_dicts(fixtures.TRANSACTION_FIELDS, rows))
        jobs.load_transactions(lake, str(root), str(day), "11-40")
    land(lake, root, OLD, [("1", "4", "first", "2026 Jun 02 15:00", "1")])
    lake.ensure(PENDING)
    merge_latest(lake, [OLD])
    lake.replace(PENDING, spark.createDataFrame([], lake.read(PENDING).schema))
    for start, end in WINDOWS:
        jobs.build_fact(lake, start, end)
    jobs.export_cube(lake, OLD, RECENT)
    return lake, root


def files(lake, name):
    return lake.files_of(name, lake.partition_values(name))


def changed(before, after):
    return sorted(value for value in after if after[value] != before.get(value))


def rows(df, *dropped):
    return sorted(map(str, df.drop("gold_processed_at", *dropped).collect()))


def whole(lake):
    """Fact and cube as if built from all cancellations at once."""
    fact = jobs.fact_of(lake, *WINDOWS[0]).unionByName(jobs.fact_of(lake, *WINDOWS[1]))
    return rows(fact), rows(hourly_cube(fact, OLD, RECENT))


def test_only_touched_partitions_are_replaced(built):
    lake, root = built
    fact, cube = files(lake, jobs.FACT), files(lake, jobs.CUBE)
    land(lake, root, RECENT, [("7", "9", "late", "2026 Jun 02 16:00", "2"), ("8", "77", "nobody", "2026 Jun 02 16:00", "2")])
    done = rebuild.apply_cancellations(lake, [RECENT])
    assert done.file_days == [OLD] and done.event_days == [OLD, RECENT - timedelta(days=1)]
    assert changed(fact, files(lake, jobs.FACT)) == [str(OLD)]
    assert changed(cube, files(lake, jobs.CUBE)) == [str(OLD), str(RECENT - timedelta(days=1))]
    assert (rows(lake.read(jobs.FACT)), rows(lake.read(jobs.CUBE))) == whole(lake)
    # Duplicates of the replaced day are still those of its window, which the next day belongs to.
    marks = lake.read(jobs.FACT).where(F.col("transaction_id") == 2).select("duplicate_count").collect()
    assert [m[0] for m in marks] == [3, 3, 3]
    # Nothing is pending, and the same load again touches nothing.
    fact, cube = files(lake, jobs.FACT), files(lake, jobs.CUBE)
    assert rebuild.apply_cancellations(lake, [RECENT]) == rebuild.Rebuilt([], [])
    assert not changed(fact, files(lake, jobs.FACT)) and not changed(cube, files(lake, jobs.CUBE))


def test_a_cancellation_that_vanishes_gives_way_to_the_one_before(built):
    lake, root = built
    land(lake, root, RECENT, [("7", "4", "second", "2026 Jun 02 16:00", "2"), ("8", "3", "only", "2026 Jun 02 16:00", "2")])
    assert rebuild.apply_cancellations(lake, [RECENT]).file_days == [NEXT, RECENT]
    land(lake, root, RECENT, [])
    assert rebuild.apply_cancellations(lake, [RECENT]).file_days == [NEXT, RECENT]
    assert (rows(lake.read(jobs.FACT)), rows(lake.read(jobs.CUBE))) == whole(lake)
    reasons = {r[0]: r[1] for r in lake.read(LATEST).select("original_transaction_id", "cancellation_reason").collect()}
    assert reasons == {4: "first"}


def test_a_failed_rebuild_is_made_up_for(built, monkeypatch):
    lake, root = built
    land(lake, root, RECENT, [("7", "9", "late", "2026 Jun 02 16:00", "2")])

    def broken(*_, **__):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(rebuild, "rebuild_days", broken)
        with pytest.raises(RuntimeError):
            rebuild.apply_cancellations(lake, [RECENT])
    assert rebuild.apply_cancellations(lake, []).file_days == [OLD]
    assert (rows(lake.read(jobs.FACT)), rows(lake.read(jobs.CUBE))) == whole(lake)


def test_hot_ids_are_ranked_within_their_window(built):
    lake, root = built
    land(lake, root, RECENT, [("7", "2", "late", "2026 Jun 02 16:00", "2")])
    assert rebuild.apply_cancellations(lake, [RECENT], hot_rows=1, broadcast_rows=0).file_days == [OLD, NEXT]
    assert (rows(lake.read(jobs.FACT)), rows(lake.read(jobs.CUBE))) == whole(lake)


def test_windows_that_overlap(built):
    """Each day keeps the window it was last built in, also where windows share days."""
    lake, root = built
    jobs.build_fact(lake, NEXT, RECENT)
    land(lake, root, RECENT, [("7", "2", "late", "2026 Jun 02 16:00", "2")])
    rebuild.apply_cancellations(lake, [RECENT])
    stored = {(r[0], r[1], r[2]) for r in lake.read(jobs.FACT).select("file_date", "gold_window_start", "gold_window_end").collect()}
    assert stored == {(OLD, OLD, NEXT), (NEXT, NEXT, RECENT), (RECENT, NEXT, RECENT)}
    counts = {(r[0], r[1]) for r in lake.read(jobs.FACT).where("transaction_id = 2").select("file_date", "duplicate_count").collect()}
    assert counts == {(OLD, 3), (NEXT, 1)}


def test_one_partition_is_written_without_a_shuffle(spark, lake):
    day = date(2024, 1, 5)
    rows = spark.range(0, 400, 1, 4).selectExpr("id AS original_transaction_id", f"DATE'{day}' AS file_date")
    kept = {f.name: F.lit(None).cast(f.dataType) for f in TABLES[jobs.CANCELLATIONS].schema.fields if f.name not in rows.columns}
    assert lake.overwrite_values(jobs.CANCELLATIONS, rows.withColumns(kept), [day]) == 400
    assert len([f for f in lake.files_of(jobs.CANCELLATIONS, [str(day)])[str(day)] if f.endswith(".parquet")]) == 4
    assert lake.read(jobs.CANCELLATIONS).where(F.col("file_date") == F.lit(day)).count() == 400
    assert lake.overwrite_values(jobs.CANCELLATIONS, rows.withColumns(kept).where("false"), [day]) == 0
    assert lake.read(jobs.CANCELLATIONS).isEmpty()
