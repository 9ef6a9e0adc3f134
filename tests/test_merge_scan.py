"""The as-of merge scan against the listing join and brute force, with crowded times, far rates and gaps."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from ledgerwell.operators.asof import attach_rates
from ledgerwell.operators.merge_scan import Cuts, attach_rates_by_scan, cuts_of
from ledgerwell.operators.rates import rate_intervals
from tests.test_asof import START, scenario, silver_rates, transactions

SHOWN = ("transaction_id", "s", "r_interval_id", "r_timestamp", "r_date", "r_punk", "r_rub", "r_strategy")


def rows(df):
    return Counter(tuple(map(str, r)) for r in df.select(*SHOWN).collect())


@pytest.mark.parametrize("name", ["few a day", "third in one day, then a gap", "one rate", "borders"])
@pytest.mark.parametrize("rows_per_part", [50, 100_000])
def test_same_as_listing(spark, name, rows_per_part):
    rates, times = scenario(name)
    intervals = rate_intervals(silver_rates(spark, rates)).cache()
    facts = transactions(spark, times)
    scanned = attach_rates_by_scan(facts, intervals, rows_per_part=rows_per_part)
    listed = attach_rates(facts, intervals)
    assert sorted(scanned.columns) == sorted(listed.columns)
    assert rows(scanned) == rows(listed)


def test_a_time_that_most_rows_share_is_dealt_over_tasks(spark):
    times = [START + 5] * 4000 + [START + i for i in range(500)]
    intervals = rate_intervals(silver_rates(spark, [START + i for i in range(0, 500, 3)])).cache()
    facts = transactions(spark, times)
    scanned = attach_rates_by_scan(facts, intervals, rows_per_part=300)
    assert rows(scanned) == rows(attach_rates(facts, intervals))
    cuts = cuts_of([5] * 90 + list(range(6, 16)), 1000, 100)
    assert sum(cuts.shares) >= 10 and max(cuts.shares) == 9 and list(cuts.borders) == sorted(cuts.borders)


def test_a_far_rate_costs_one_row(spark):
    """A rate in year 9000 adds no rows but its own: the merged input has rows, rates and one per part."""
    far = 221_900_000_000
    rates = [START + i * 977 for i in range(300)]
    times = [START + i * 31 for i in range(3000)] + [far - 1, far, far + 1]
    facts = transactions(spark, times)
    results = []
    for more in ([], [far]):
        intervals = rate_intervals(silver_rates(spark, rates + more)).cache()
        scanned = attach_rates_by_scan(facts, intervals, rows_per_part=500)
        results.append({r["s"]: r["r_rub"] for r in scanned.collect()})
        plan = scanned._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan
        assert "sequence(0, cast" not in plan  # no calendar is listed
    assert {s: r for s, r in results[0].items() if s < far} == {s: r for s, r in results[1].items() if s < far}
    assert results[1][far] == results[1][far + 1] == 302.0 and results[1][far - 1] == 301.0


def test_rows_without_a_rate(spark):
    rates, times = scenario("few a day")
    number = F.col("transaction_id") % 4
    df = (
        transactions(spark, times)
        .withColumn("currency", F.when(number == 0, "TGRK").when(number < 3, "RUB"))
        .withColumn("created_at", F.when(number != 2, F.col("created_at")))
    )
    collected = attach_rates_by_scan(df, rate_intervals(silver_rates(spark, rates)), rows_per_part=200).collect()
    assert len(collected) == len(times)
    assert all((r.r_timestamp is None) == (r.transaction_id % 4 != 1) for r in collected)


def test_gaps_between_intervals(spark):
    rates, times = scenario("few a day")
    intervals = rate_intervals(silver_rates(spark, rates)).cache()
    holes = intervals.where(F.pmod(F.unix_seconds("valid_from"), F.lit(3)) != 0)
    facts = transactions(spark, times)
    assert rows(attach_rates_by_scan(facts, holes, rows_per_part=100)) == rows(attach_rates(facts, holes))


@pytest.mark.parametrize("empty", ["rates", "rows", "both"])
def test_empty_sides(spark, empty):
    intervals = rate_intervals(silver_rates(spark, [START])).where(F.lit(empty == "rows"))
    facts = transactions(spark, [START, START + 1]).where(F.lit(empty == "rates"))
    found = attach_rates_by_scan(facts, intervals).collect()
    assert [r.r_timestamp for r in found] == ([None, None] if empty == "rates" else [])


def test_cuts():
    assert cuts_of([], 0, 10) == Cuts((), (1,))
    assert cuts_of([7, 7, 7, 7], 40, 10) == Cuts((), (4,))
    assert cuts_of([1, 2, 3, 4], 40, 20) == Cuts((3.0,), (1, 1))
