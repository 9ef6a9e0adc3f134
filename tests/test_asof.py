"""Intervals and the as-of join against brute force, also for crowded days and outliers."""

import random
from bisect import bisect_right
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from ledgerwell.operators.asof import attach_rates, sliced_intervals
from ledgerwell.operators.hotkeys import with_scatter
from ledgerwell.operators.rates import rate_intervals

DAY = 86_400
START = 1_767_225_600


def silver_rates(spark, seconds):
    rows = [(i, s, 1.0 + i, 2.0 + i) for i, s in enumerate(seconds)]
    df = spark.createDataFrame(rows, "update_id long, s long, rate_tgrk_punk double, rate_tgrk_rub double")
    at = F.timestamp_seconds("s")
    return df.select(
        "update_id", at.alias("rate_timestamp"), F.to_date(at).alias("rate_date"), "rate_tgrk_punk",
        "rate_tgrk_rub", F.lit(True).alias("is_valid_record"),
    )


def transactions(spark, seconds):
    df = spark.createDataFrame([(i, s, "RUB") for i, s in enumerate(seconds)], "transaction_id long, s long, currency string")
    return with_scatter(df.withColumn("created_at", F.timestamp_seconds("s")))


def epoch(value):
    return None if value is None else int(value.replace(tzinfo=timezone.utc).timestamp())


def scenario(name):
    rng = random.Random(name)
    if name == "few a day":
        rates = [START + d * DAY + rng.randrange(DAY) for d in range(30) for _ in range(3)]
        times = [START + rng.randrange(-5 * DAY, 40 * DAY) for _ in range(3000)]
    elif name == "third in one day, then a gap":
        rates = [START + rng.randrange(3600) for _ in range(700)] + [START + 400 * DAY + rng.randrange(900 * DAY) for _ in range(900)]
        times = [START + rng.randrange(7200) for _ in range(1500)] + [START + rng.randrange(1500 * DAY) for _ in range(1500)]
    elif name == "one rate":
        rates, times = [START + 12345], [START + d for d in (-10**6, 0, 12344, 12345, 12346, 10**7)]
    else:  # borders of days and rates, far outliers
        rates = [START, START + DAY - 1, START + DAY, START + DAY + 1, START + 10 * DAY]
        times = [r + d for r in rates for d in (-1, 0, 1)] + [-60 * 366 * DAY, -2_300_000_000, 250_000_000_000]
    return rates, times


@pytest.mark.parametrize("name", ["few a day", "third in one day, then a gap", "one rate", "borders"])
def test_same_as_brute_force(spark, name):
    rates, times = scenario(name)
    intervals = rate_intervals(silver_rates(spark, rates)).cache()
    rows = attach_rates(transactions(spark, times), intervals).collect()
    assert len(rows) == len(times)
    known = sorted(set(rates))
    beginning = -2_208_988_800
    for row in rows:
        place = bisect_right(known, row.s)
        if row.s < beginning:
            expected = (None, None)
        else:
            expected = (known[place - 1], "asof_previous") if place else (known[0], "backfill_next")
        assert (epoch(row.r_timestamp), row.r_strategy) == expected, row.s
    listed = sliced_intervals(intervals)
    days = listed.select("r_day").distinct().count()
    assert listed.count() <= 2 * intervals.count() + 3 * days
    spans = intervals.orderBy("valid_from").collect()
    assert [s.valid_to for s in spans[:-1]] == [s.valid_from for s in spans[1:]]
    assert spans[-1].valid_to is None and spans[0].valid_from == datetime(1900, 1, 1)


def test_no_rates_at_all(spark):
    intervals = rate_intervals(silver_rates(spark, [1]).where(F.lit(False)))
    assert intervals.count() == 0
    rows = attach_rates(transactions(spark, [START, START + 1]), intervals).collect()
    assert [r.r_timestamp for r in rows] == [None, None]


def test_same_timestamp_greatest_update_wins(spark):
    rows = rate_intervals(silver_rates(spark, [START, START, START])).collect()
    assert {r.rate_update_id for r in rows} == {2} and len(rows) == 2


def test_base_currency_and_missing_values_get_no_rate(spark):
    rates, times = scenario("few a day")
    number = F.col("transaction_id") % 4
    df = (
        transactions(spark, times)
        .withColumn("currency", F.when(number == 0, "TGRK").when(number < 3, "RUB"))
        .withColumn("created_at", F.when(number != 2, F.col("created_at")))
    )
    joined = attach_rates(df, rate_intervals(silver_rates(spark, rates)))
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan
    collected = joined.collect()
    assert len(collected) == len(times)
    assert all((r.r_timestamp is None) == (r.transaction_id % 4 != 1) for r in collected)
