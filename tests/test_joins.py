"""The lookup join beyond the broadcast size, with a crowded key and NULL keys."""

from collections import Counter

from pyspark.sql import functions as F

from ledgerwell.operators.asof import attach_rates
from ledgerwell.operators.hotkeys import with_scatter
from ledgerwell.operators.joins import lookup_join
from ledgerwell.operators.rates import rate_intervals
from tests.test_asof import silver_rates, transactions

N = 30_000


def rows(spark, kind="bigint"):
    """A third has key 7, a third no key."""
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, None).otherwise(F.col("id") % 900)
    return with_scatter(spark.range(N, numPartitions=6).select("id", key.cast(kind).alias("key")))


def lookup(spark, kind="bigint"):
    return spark.range(500).select(F.col("id").cast(kind).alias("known"), (F.col("id") * 10).alias("value"))


def result(df):
    return Counter(tuple(r) for r in df.select("id", "key", "value").collect())


def test_small_and_large_lookups_agree(spark):
    for kind in ("bigint", "string"):
        df, side = rows(spark, kind), lookup(spark, kind)
        small = lookup_join(df, side, "key", "known")
        large = lookup_join(df, side, "key", "known", broadcast_rows=10, hot_rows=5000)
        assert "BroadcastHashJoin" in small._jdf.queryExecution().executedPlan().toString()
        assert large.columns == small.columns
        assert result(large) == result(small)
        assert sum(result(large).values()) == N


def test_crowded_key_and_nulls_are_spread(spark):
    off = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
           "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    for key, value in off.items():
        spark.conf.set(key, value)
    try:
        joined = lookup_join(rows(spark), lookup(spark), "key", "known", broadcast_rows=10, hot_rows=5000)
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "_spread" in plan.split("Exchange hashpartitioning", 1)[1].split(")", 1)[0]
        largest = joined.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        for key in list(off)[:2]:
            spark.conf.unset(key)
    assert largest < N / 4


def test_large_interval_list_with_a_crowded_slice(spark):
    rates = [1_767_225_600 + 600 * i for i in range(800)]
    times = [rates[3] + 5] * 2000 + [r + 7 for r in rates] + [rates[0] - 9, rates[-1] + 10**6]
    df, intervals = transactions(spark, times), rate_intervals(silver_rates(spark, rates))
    keep = ("transaction_id", "r_timestamp", "r_strategy")
    small = attach_rates(df, intervals)
    large = attach_rates(df, intervals, broadcast_rows=10, hot_rows=1000, keys_from=df)
    assert large.columns == small.columns
    assert sorted(large.select(*keep).collect()) == sorted(small.select(*keep).collect())
    assert small.count() == len(times)
