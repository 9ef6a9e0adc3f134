"""Duplicate marks and cancellations when one id, NULL, or exact copies dominate."""

from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from ledgerwell.operators.cancellations import attach_cancellations, latest_cancellations
from ledgerwell.operators.duplicates import mark_duplicates
from ledgerwell.operators.hotkeys import SPREAD, hot_keys, with_scatter


def rows(spark, n=6000):
    """A third of the rows has id 7, a third no id, a third of id 7's rows are copies of one row."""
    df = spark.range(n, numPartitions=6).select(
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, None).otherwise(F.col("id") % 500).cast("long")
        .alias("transaction_id"),
        F.when(F.col("id") % 9 == 0, 0).otherwise(F.col("id")).alias("n"),
    )
    at = F.when(F.col("n") % 11 > 0, F.timestamp_seconds(F.col("n") % 97))
    return with_scatter(
        df.select(
            "transaction_id", at.alias("created_at"), F.lit("2026-01-01").cast("date").alias("file_date"),
            F.lit("00-00").alias("slot"), F.lit("2026-01-02").cast("timestamp").alias("transaction_processed_at"),
            F.lit("f").alias("source_file"), F.col("n").alias("user_id"), F.lit("u").alias("user_uuid"),
            F.col("n").cast("decimal(18,2)").alias("amount"), F.lit("RUB").alias("currency"),
            F.lit("refund").alias("transaction_type"), F.lit("done").alias("status"),
            F.lit(1).cast("long").alias("promo_code_id"), F.array(F.lit("e")).alias("transaction_validation_errors"),
        )
    )


def expected(source):
    groups = defaultdict(list)
    for r in source:
        groups[r.transaction_id].append(r)
    out = Counter()
    for key, members in groups.items():
        newest = sorted(
            members,
            key=lambda r: (r.created_at is None, -(r.created_at.timestamp() if r.created_at else 0), r.user_id),
        )
        for rank, r in enumerate(newest, 1):
            marks = (len(members), rank, len(members) > 1) if key is not None else (None, None, False)
            out[(key, r.created_at, r.user_id, *marks)] += 1
    return out


def marked(df):
    return Counter(
        (r.transaction_id, r.created_at, r.user_id, r.duplicate_count, r.duplicate_rank, r.is_duplicate_transaction)
        for r in df.collect()
    )


@pytest.mark.parametrize("hot", [False, True])
def test_marks_equal_brute_force(spark, hot):
    df = rows(spark)
    keys = hot_keys(df, "transaction_id", min_rows=1000) if hot else []
    assert keys == ([7] if hot else [])
    assert marked(mark_duplicates(df, keys)) == expected(df.collect())


def test_hot_id_and_nulls_are_spread_over_tasks(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        result = mark_duplicates(rows(spark), [7])
        shares = (
            result.groupBy(F.spark_partition_id().alias("task")).agg(F.count(F.lit(1)).alias("n"))
            .agg(F.max("n"), F.sum("n")).first()
        )
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert shares[1] == 6000 and shares[0] < 6000 / 5


def cancellations(spark):
    data = [(i, 7 if i % 2 else i % 500, f"r{i}") for i in range(4000)]
    df = spark.createDataFrame(data, "cancellation_id long, original_transaction_id long, reason string")
    return df.select(
        "*", F.timestamp_seconds(F.col("cancellation_id") % 50).alias("cancelled_at"),
        F.to_date(F.lit("1970-01-01")).alias("cancelled_date"), F.lit(1).cast("decimal(18,2)").alias("refund_amount"),
        F.lit(False).alias("negative_refund_amount"), F.lit(True).alias("is_valid_record"),
        F.array(F.lit("x")).alias("validation_errors"), F.lit("2026-01-02").cast("timestamp").alias("processed_at"),
    )


def test_latest_and_join_with_hot_id(spark):
    latest = latest_cancellations(cancellations(spark))
    by_id = {r.original_transaction_id: r.cancellation_id for r in latest.collect()}
    best = {}
    for i in range(4000):
        key = 7 if i % 2 else i % 500
        best[key] = max(best.get(key, (-1, -1)), (i % 50, i))
    assert by_id == {key: i for key, (_, i) in best.items()}
    df = rows(spark)
    plain = attach_cancellations(mark_duplicates(df, []), latest)
    hot = attach_cancellations(mark_duplicates(df, [7]), latest, [7])
    names = ("transaction_id", "user_id", "cancellation_id")
    assert SPREAD not in hot.columns
    as_counter = lambda d: Counter(tuple(r) for r in d.select(*names).collect())
    assert as_counter(plain) == as_counter(hot) == Counter(
        (r.transaction_id, r.user_id, by_id.get(r.transaction_id)) for r in df.collect()
    )


def test_latest_keeps_one_row_per_id_before_the_shuffle(spark):
    plan = latest_cancellations(cancellations(spark))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_hot_keys_are_found_and_few(spark):
    df = spark.range(50_000).select((F.when(F.col("id") % 2 == 0, F.col("id") % 10).otherwise(F.col("id"))).alias("k"))
    assert sorted(hot_keys(df, "k", min_rows=2000)) == [0, 2, 4, 6, 8]
