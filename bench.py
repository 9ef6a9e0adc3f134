"""Times the headline queries: ``BENCH_SF_DIR`` (data), ``BENCH_CPUS`` (threads), ``BENCH_RUNS`` (repeats).

Prints one JSON line. Each query is run once to warm up, then the median of the repeats counts. A
run includes all the query does: its scratch tables, its sketches, its result. With
``BENCH_LITERAL=1`` it also times the as-of lookup as a plain range join, for comparison with
``q06_asof_convert``.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks import queries as checks  # noqa: E402
from ledgerwell.session import configure  # noqa: E402

HEADLINE = (
    "q02_safe_parse",
    "q04_error_array",
    "q05_rate_intervals",
    "q06_asof_convert",
    "q07_latest_cancellation",
    "q08_user_segment",
    "q10_duplicate_marks",
    "q13_enriched_window",
    "q14_hourly_cube",
    "q22_affected_dates",
    "q28_duplicate_marks_hot",
)


def literal_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every foreign row compared with every interval."""
    rows = checks.base_transactions(spark, sf_dir)
    spans = checks.stored_intervals(spark, sf_dir)
    covers = (
        (rows.currency != "TGRK")
        & (rows.created_at >= spans.valid_from)
        & (spans.valid_to.isNull() | (rows.created_at < spans.valid_to))
    )
    return rows.join(F.broadcast(spans), covers, "left").select("transaction_id", "rate_tgrk_punk", "rate_tgrk_rub")


def seconds(spark: SparkSession, query, sf_dir: str, runs: int) -> float:
    def once() -> float:
        started = time.perf_counter()
        query(spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - started

    once()
    return round(statistics.median(once() for _ in range(runs)), 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", cpus)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    timed = {name: seconds(spark, checks.QUERIES[name], sf_dir, runs) for name in HEADLINE}
    literal = {}
    if os.environ.get("BENCH_LITERAL"):
        literal["asof_range_join"] = seconds(spark, literal_asof, sf_dir, runs)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total of headline queries",
                "value": round(sum(timed.values()), 3),
                "unit": "sec",
                "queries": timed,
                "literal": literal,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
