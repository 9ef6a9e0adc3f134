"""One query per operator of the engine. Money is shown in whole cents, times and days as text."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import roles
from ledgerwell.operators import asof, cancellations, cube, duplicates, facts, latest, lookups, merge_scan, rates, silver
from ledgerwell.operators.dictionaries import typed_dictionary
from ledgerwell.operators.hotkeys import hot_keys, with_scatter
from ledgerwell.plans import backfill, calendar, jobs, rebuild
from ledgerwell.plans.audit import AUDIT_TABLE, LoadEvent, audited, table_counts
from ledgerwell.schemas import TABLES, TRANSACTION_FLAGS
from ledgerwell.session import configure, shared_folder, use_local_folder
from ledgerwell.sources import jsonl, quarantine
from ledgerwell.sources.lake import Lake, write_json_lines
from ledgerwell.streaming.ingest import ingest_transactions

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# The days of the provided events; the whole of them is the fact window.
START, END = date(2024, 1, 1), date(2024, 1, 31)


def query(function: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(configure(use_local_folder(spark)), sf_dir)

    QUERIES[function.__name__] = run
    return function


def cents(name: str) -> Column:
    return (F.col(name) * 100).cast("bigint").alias(name)


def shown(df: DataFrame, *names: str) -> DataFrame:
    """Columns in forms that compare exactly: cents, text times, joined lists."""
    types = dict(df.dtypes)

    def form(name: str) -> Column:
        kind = types[name]
        if kind == "decimal(18,2)":
            return cents(name)
        if kind == "timestamp":
            return F.date_format(name, "yyyy-MM-dd HH:mm:ss").alias(name)
        if kind == "date":
            return F.col(name).cast("string").alias(name)
        if kind == "array<string>":
            return F.array_join(name, ",").alias(name)
        return F.col(name)

    return df.select(*[form(name) for name in (names or df.columns)])


def scratch_lake(spark: SparkSession) -> Lake:
    return Lake(spark, f"{shared_folder(spark)}/lake-{uuid4()}")


def silver_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.clean_transactions(roles.transactions(spark, sf_dir))


def silver_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.clean_rates(roles.rates(spark, sf_dir))


def silver_cancellations(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = silver.clean_cancellations(roles.cancellations(spark, sf_dir))
    return cleaned.withColumn("processed_at", F.lit(roles.LOADED_AT).cast("timestamp"))


def stored_rates(spark: SparkSession, sf_dir: str) -> Lake:
    """A lake with the silver rates, the way every layer reads the stored layer below it."""
    lake = scratch_lake(spark)
    lake.overwrite_partitions(jobs.RATES, silver_rates(spark, sf_dir))
    return lake


def stored_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = stored_rates(spark, sf_dir)
    lake.replace(jobs.INTERVALS, rates.rate_intervals(lake.read(jobs.RATES), START, END))
    return lake.read(jobs.INTERVALS)


def base_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = silver_transactions(spark, sf_dir)
    fixed = cleaned.withColumn("processed_at", F.lit(roles.LOADED_AT).cast("timestamp"))
    return with_scatter(facts.transactions_in_window(fixed, START, END))


def fact(spark: SparkSession, sf_dir: str, start: date = START, end: date = END) -> DataFrame:
    cleaned = silver_transactions(spark, sf_dir)
    return facts.enriched_fact(
        cleaned.withColumn("processed_at", F.lit(roles.LOADED_AT).cast("timestamp")),
        users=roles.users(spark, sf_dir),
        test_users=roles.test_users(spark, sf_dir),
        promo_codes=roles.promo_codes(spark, sf_dir),
        intervals=stored_intervals(spark, sf_dir),
        cancellations=silver_cancellations(spark, sf_dir),
        start=start,
        end=end,
    )


@query
def q01_normalise_text(spark, sf_dir):
    return shown(
        silver_transactions(spark, sf_dir),
        "currency_raw", "currency", "transaction_type_raw", "transaction_type",
        "status_raw", "status", "user_uuid_raw", "user_uuid",
    )


@query
def q02_safe_parse(spark, sf_dir):
    return shown(
        silver_transactions(spark, sf_dir),
        "transaction_id_raw", "transaction_id", "user_id_raw", "user_id", "amount_raw", "amount",
        "promo_code_id_raw", "promo_code_id", "created_at_raw", "created_at", "created_date",
    )


@query
def q03_quality_flags(spark, sf_dir):
    return silver_transactions(spark, sf_dir).select("created_at_raw", *TRANSACTION_FLAGS, "is_valid_record")


@query
def q04_error_array(spark, sf_dir):
    return shown(silver_transactions(spark, sf_dir), "transaction_id_raw", "created_at_raw", "validation_errors")


@query
def q05_rate_intervals(spark, sf_dir):
    return shown(
        rates.rate_intervals(stored_rates(spark, sf_dir).read(jobs.RATES)),
        "rate_interval_id", "valid_from", "valid_to", "valid_from_date", "valid_to_date", "rate_update_id",
        "rate_timestamp", "rate_date", "rate_tgrk_punk", "rate_tgrk_rub", "is_rate_found", "is_rate_valid",
        "rate_selection_strategy",
    )


@query
def q06_asof_convert(spark, sf_dir):
    priced = asof.attach_rates(base_transactions(spark, sf_dir), stored_intervals(spark, sf_dir))
    return shown(
        facts.with_base_amount(facts.with_rate_state(priced)),
        "transaction_id", "created_at", "currency", "amount", "amount_tgrk", "rate_interval_id", "rate_timestamp",
        "rate_date", "rate_tgrk_punk", "rate_tgrk_rub", "is_rate_found", "is_rate_valid", "rate_selection_strategy",
        "rate_time_diff_minutes",
    )


@query
def q07_latest_cancellation(spark, sf_dir):
    return shown(cancellations.latest_cancellations(silver_cancellations(spark, sf_dir)))


@query
def q08_user_segment(spark, sf_dir):
    known = lookups.attach_users(base_transactions(spark, sf_dir), roles.users(spark, sf_dir))
    known = lookups.attach_test_users(known, roles.test_users(spark, sf_dir))
    return facts.with_user_state(known).select(
        "user_id", "user_uuid", "is_user_found", "user_is_test_from_users", "user_is_test_from_test_users",
        "is_test_user", "user_segment",
    )


@query
def q09_promo_flags(spark, sf_dir):
    known = lookups.attach_promo_codes(base_transactions(spark, sf_dir), roles.promo_codes(spark, sf_dir))
    return shown(
        facts.with_promo_state(known),
        "promo_code_id", "created_date", "promo_code", "promo_max_uses", "promo_expiry_date", "has_promo_code",
        "is_promo_found", "is_promo_missing_in_dictionary", "is_promo_expired",
    )


def _line_items_as_transactions(spark: SparkSession, sf_dir: str, transaction_id: str) -> DataFrame:
    """Every line item as a transaction whose id many others share."""
    items = roles.table(spark, sf_dir, "lineitem").selectExpr(
        f"{transaction_id} AS transaction_id",
        "l_partkey AS user_id",
        "l_linestatus AS user_uuid",
        "CAST(l_extendedprice AS DECIMAL(18,2)) AS amount",
        "l_returnflag AS currency",
        "CAST(l_linenumber AS STRING) AS transaction_type",
        "CAST(l_quantity AS STRING) AS status",
        "l_suppkey AS promo_code_id",
        "CAST(l_shipdate AS TIMESTAMP) AS created_at",
        "DATE'2001-12-31' AS file_date",
        "'00-00' AS slot",
        f"TIMESTAMP'{roles.LOADED_AT}' AS transaction_processed_at",
        "'lineitem' AS source_file",
        "array(l_returnflag) AS transaction_validation_errors",
    )
    return with_scatter(items)


_MARKED = (
    "transaction_id", "user_id", "amount", "created_at",
    "duplicate_count", "duplicate_rank", "is_duplicate_transaction",
)


@query
def q10_duplicate_marks(spark, sf_dir):
    items = _line_items_as_transactions(
        spark, sf_dir, "CASE WHEN l_suppkey % 3 = 0 THEN NULL ELSE l_orderkey END"
    )
    return shown(duplicates.mark_duplicates(items, hot_keys(items, "transaction_id")), *_MARKED)


@query
def q11_refund_net(spark, sf_dir):
    base = duplicates.mark_duplicates(base_transactions(spark, sf_dir))
    joined = cancellations.attach_cancellations(
        base, cancellations.latest_cancellations(silver_cancellations(spark, sf_dir))
    )
    priced = asof.attach_rates(joined, stored_intervals(spark, sf_dir))
    return shown(
        priced.transform(facts.with_rate_state)
        .transform(facts.with_net_amount)
        .transform(facts.with_cancellation_state),
        "transaction_id", "created_at", "cancellation_id", "cancelled_at", "refund_amount", "amount_tgrk",
        "gross_amount_tgrk", "refund_amount_tgrk", "net_amount_tgrk", "is_cancelled", "time_to_cancel_minutes",
    )


@query
def q12_business_flags(spark, sf_dir):
    return facts.with_business_flags(silver_transactions(spark, sf_dir)).select(
        "transaction_type", "status", "is_purchase_type", "is_completed_status", "is_completed_purchase",
        "is_failed_status", "is_refund_type", "is_transfer_type",
    )


@query
def q13_enriched_window(spark, sf_dir):
    names = [
        n for n in facts.FACT_COLUMNS
        if n not in ("raw_bucket", "raw_object_path", "transaction_processed_at", "gold_processed_at")
    ]
    return shown(fact(spark, sf_dir), *names)


@query
def q14_hourly_cube(spark, sf_dir):
    return shown(cube.hourly_cube(fact(spark, sf_dir), START, END))


@query
def q15_partition_overwrite(spark, sf_dir):
    """All days are written, then the days from the middle of the month on again without bad rows."""
    lake = scratch_lake(spark)
    loaded = silver_rates(spark, sf_dir)
    lake.overwrite_partitions(jobs.RATES, loaded)
    lake.overwrite_partitions(jobs.RATES, loaded.where((F.col("file_date") >= "2024-01-15") & F.col("is_valid_record")))
    return shown(lake.read(jobs.RATES), "file_date", "update_id_raw", "timestamp_raw", "is_valid_record")


@query
def q16_window_replace(spark, sf_dir):
    """The cube of the month is written, then a window of it is replaced: once by the same days of
    the completed purchases alone, once by nothing."""
    lake = scratch_lake(spark)
    lake.replace(jobs.FACT, fact(spark, sf_dir))
    lake.overwrite_days(jobs.CUBE, cube.hourly_cube(lake.read(jobs.FACT), START, END), START, END)
    completed = lake.read(jobs.FACT).where("is_completed_purchase")
    lake.overwrite_days(
        jobs.CUBE, cube.hourly_cube(completed, date(2024, 1, 10), date(2024, 1, 12)),
        date(2024, 1, 10), date(2024, 1, 12),
    )
    emptied = lake.read(jobs.CUBE).where(F.lit(False))
    lake.overwrite_days(jobs.CUBE, emptied, date(2024, 1, 20), date(2024, 1, 21))
    return shown(lake.read(jobs.CUBE))


@query
def q17_json_lines(spark, sf_dir):
    """Silver amounts as JSON lines, read back as text."""
    folder = f"{shared_folder(spark)}/lines-{uuid4()}"
    rows = silver_transactions(spark, sf_dir).select(
        "transaction_id", "amount", "currency", "created_at", "created_date", "is_valid_record"
    )
    write_json_lines(rows, folder)
    fields = ("transaction_id", "amount", "currency", "created_at", "created_date", "is_valid_record")
    back = spark.read.schema(", ".join(f"{f} STRING" for f in fields)).json(folder)
    has_keys = [F.col("value").contains(f'"{f}":').cast("int") for f in fields]
    keys = spark.read.text(folder).select(sum(has_keys[1:], has_keys[0]).alias("n")).agg(F.min("n").alias("fewest_keys"))
    return back.withColumn("fewest_keys", keys.scalar())


@query
def q18_audit_log(spark, sf_dir):
    """Each table is loaded once under audit, one load fails, and the log is read back."""
    lake = scratch_lake(spark)
    loads = {
        jobs.TRANSACTIONS: (silver_transactions(spark, sf_dir).drop("slot").withColumn("slot", F.lit("all"))),
        jobs.RATES: silver_rates(spark, sf_dir),
        jobs.CANCELLATIONS: silver_cancellations(spark, sf_dir).withColumn("file_date", F.lit(END)),
    }
    for target, rows in loads.items():
        event = LoadEvent("run", "load", target.split("/")[-1], target, "provided", file_date=END)
        with audited(lake, event):
            event.rows_read = event.rows_written = lake.overwrite_partitions(target, rows)
    try:
        with audited(lake, LoadEvent("run", "load", "broken", "none", "provided", file_date=END)):
            roles.table(spark, sf_dir, "no_such_table")
    except Exception:
        pass
    log = lake.read(AUDIT_TABLE).select(
        "run_id", "source_name", "target_table", "status", "rows_read", "rows_written",
        F.col("error_message").isNotNull().alias("has_error"),
        (F.col("finished_at") >= F.col("started_at")).alias("in_order"),
    )
    counts = table_counts(lake, list(loads)).withColumnsRenamed({"table_name": "target_table", "row_count": "stored"})
    return log.join(counts, "target_table", "left")


@query
def q19_expected_partitions(spark, sf_dir):
    """Every slot of the days of the events, with the number of events that fell into it."""
    per_slot = (
        roles.transactions(spark, sf_dir)
        .groupBy(F.col("file_date").alias("day"), "slot")
        .agg(F.count(F.lit(1)).alias("events"))
    )
    expected = calendar.expected_slots(spark, START, END)
    joined = expected.join(per_slot, ["day", "slot"], "left")
    return joined.select(F.col("day").cast("string").alias("day"), "slot", F.coalesce("events", F.lit(0)).alias("events"))


@query
def q20_missing_partitions(spark, sf_dir):
    """The oldest slots before the last complete one in which no event arrived: a catch-up batch."""
    arrived = roles.transactions(spark, sf_dir).select(
        F.col("file_date"), "slot", F.lit("loaded").alias("status"), F.lit(jobs.TRANSACTIONS).alias("target_table")
    )
    loaded = calendar.loaded_partitions(arrived, jobs.TRANSACTIONS)
    newest = roles.table(spark, sf_dir, "events").agg(F.max(F.col("ts").cast("timestamp")).alias("at"))
    day, slot = calendar.last_complete_slot(F.col("at"))
    limit = newest.select(F.struct(day.alias("day"), slot.alias("slot")))
    due = calendar.expected_slots(spark, START, END).where(F.struct("day", "slot") <= limit.scalar())
    missing = calendar.missing_slots(due, loaded)
    return missing.select(F.col("day").cast("string").alias("day"), "slot")


@query
def q21_file_stream_ingest(spark, sf_dir):
    """Events are landed as several files per slot and streamed into the silver table; batches cut through slots."""
    lake = scratch_lake(spark)
    root = f"{lake.root}-raw"
    fields = [F.col(name) for name in roles.TRANSACTION_TEXTS]
    (
        roles.transactions(spark, sf_dir)
        .select(
            F.to_json(F.struct(*fields)).alias("value"),
            F.col("file_date").alias("day"),
            F.concat(F.substring("slot", 1, 1), F.lit("0-00")).alias("slot"),
        )
        .repartition("day", "slot", F.pmod(F.xxhash64("value"), F.lit(3)))
        .write.partitionBy("day", "slot")
        .text(f"{root}/transactions")
    )
    ingest_transactions(lake, root, f"{root}/progress", files_per_batch=50, file_glob="*.txt").awaitTermination()
    return shown(
        lake.read(jobs.TRANSACTIONS),
        "file_date", "slot", "transaction_id_raw", "transaction_id", "amount", "created_at", "validation_errors",
    )


@query
def q22_affected_dates(spark, sf_dir):
    """Per cancellation day, nothing is left out: the file days of the events that line items cancel."""
    return calendar.affected_dates(
        base_transactions(spark, sf_dir), silver_cancellations(spark, sf_dir)
    ).select(F.col("file_date").cast("string").alias("file_date"))


@query
def q23_rate_flags(spark, sf_dir):
    return shown(
        silver_rates(spark, sf_dir),
        "update_id_raw", "timestamp_raw", "update_id", "rate_timestamp", "rate_date", "rate_tgrk_punk",
        "rate_tgrk_rub", *[n for n in TABLES[jobs.RATES].schema.names if n.startswith(("missing", "invalid", "non_"))],
        "is_valid_record", "validation_errors",
    )


@query
def q24_cancellation_flags(spark, sf_dir):
    return shown(
        silver_cancellations(spark, sf_dir),
        "cancellation_id", "original_transaction_id", "reason", "cancelled_at_raw", "cancelled_at", "cancelled_date",
        "refund_amount",
        *[n for n in TABLES[jobs.CANCELLATIONS].schema.names if n.startswith(("missing", "invalid", "negative"))],
        "is_valid_record", "validation_errors",
    )


@query
def q25_dictionary_load(spark, sf_dir):
    """Parts landed as promo code lines, loaded as the typed dictionary, replaced by a second load."""
    lake = scratch_lake(spark)
    codes = roles.promo_codes(spark, sf_dir).select(
        "promo_code_id", "code", "max_uses", F.col("expiry_date").cast("string").alias("expiry_date")
    )
    path = f"{lake.root}-raw/promo_codes"
    write_json_lines(codes, path)
    for _ in range(2):
        loaded = typed_dictionary("promo_codes", jsonl.read_dictionary(spark, "promo_codes", path))
        lake.replace("dictionaries/promo_codes", loaded)
    return shown(lake.read("dictionaries/promo_codes"), "promo_code_id", "code", "max_uses", "expiry_date")


@query
def q26_bronze_cancellations(spark, sf_dir):
    """Line items landed as cancellation lines, one folder per day, kept as text in bronze."""
    lake = scratch_lake(spark)
    path = f"{lake.root}-raw/cancellations"
    raw = roles.cancellations(spark, sf_dir)
    line = F.to_json(F.struct(*list(roles.CANCELLATION_TEXTS)))
    raw.select(line.alias("value"), F.date_format("file_date", "yyyy").alias("year")).write.partitionBy("year").text(path)
    lines = jsonl.with_origin(
        jsonl.read_cancellations(spark, path), bucket="raw", object_path=path,
        file_date=F.concat(F.regexp_extract("source_file", "/year=([^/]+)/", 1), F.lit("-01-01")),
    )
    lake.overwrite_partitions(jobs.CANCELLATIONS_BRONZE, lines)
    return lake.read(jobs.CANCELLATIONS_BRONZE).select(*roles.CANCELLATION_TEXTS, "file_date")


@query
def q27_inferred_reference(spark, sf_dir):
    """Customers landed as lines, loaded with the schema found in the data."""
    lake = scratch_lake(spark)
    path = f"{lake.root}-raw/customer"
    roles.table(spark, sf_dir, "customer").write.json(path)
    jobs.load_reference(lake, "customer", path)
    stored = spark.read.parquet(lake.path("reference/customer"))
    return stored.select(
        "c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment",
        (F.col("source_file") == path).alias("from_path"),
    )


@query
def q28_duplicate_marks_hot(spark, sf_dir):
    """Ids that hold a third of all rows each, ranked across tasks."""
    items = _line_items_as_transactions(spark, sf_dir, "CAST(ascii(l_returnflag) AS BIGINT)")
    hot = hot_keys(items, "transaction_id", min_rows=1000)
    return shown(duplicates.mark_duplicates(items, hot), *_MARKED)


@query
def q29_refund_hot(spark, sf_dir):
    """Hot ids joined to their latest cancellation."""
    items = _line_items_as_transactions(spark, sf_dir, "CAST(ascii(l_returnflag) AS BIGINT)")
    hot = hot_keys(items, "transaction_id", min_rows=1000)
    latest = cancellations.latest_cancellations(
        silver_cancellations(spark, sf_dir).withColumn(
            "original_transaction_id", F.ascii(F.upper(F.col("reason"))).cast("bigint")
        )
    )
    joined = cancellations.attach_cancellations(duplicates.mark_duplicates(items, hot), latest, hot)
    return shown(joined, "transaction_id", "user_id", "amount", "cancellation_id", "cancelled_at", "refund_amount")


@query
def q30_rates_per_day(spark, sf_dir):
    """How the interval list of the as-of join is cut: one row per day with its slices."""
    listed = asof.sliced_intervals(stored_intervals(spark, sf_dir))
    return listed.groupBy(F.col("r_day").cast("bigint").alias("day")).agg(
        F.count_distinct("r_interval_id").alias("intervals"), F.max("r_slices").cast("bigint").alias("slices")
    )


@query
def q31_no_row_lost(spark, sf_dir):
    """Row counts per file day before and after all joins."""
    before = silver_transactions(spark, sf_dir).groupBy("file_date").agg(F.count(F.lit(1)).alias("silver_rows"))
    after = fact(spark, sf_dir).groupBy("file_date").agg(F.count(F.lit(1)).alias("fact_rows"))
    joined = before.join(after, "file_date", "full")
    return joined.select(F.col("file_date").cast("string").alias("file_date"), "silver_rows", "fact_rows")


def recent_days(day: date) -> tuple[date, date]:
    return day - timedelta(days=calendar.REBUILD_DAYS_BACK), day


@query
def q32_rebuild_window(spark, sf_dir):
    """The fact of a regular rebuild: three days of files, duplicates counted within them."""
    return shown(
        fact(spark, sf_dir, *recent_days(date(2024, 1, 17))),
        "transaction_id", "file_date", "slot", "created_at", "duplicate_count", "duplicate_rank",
        "is_duplicate_transaction", "net_amount_tgrk", "gold_window_start", "gold_window_end",
    )


LATE_DAYS = 7
# The two days the cancellations are loaded on: all but the newest ship days, and these.
FIRST_LOAD, LATE_LOAD = date(2024, 2, 1), date(2024, 2, 2)


def _cancellations_in_two_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items of the last ship days come late, as a file of their own."""
    every = silver_cancellations(spark, sf_dir)
    newest = every.agg(F.max("file_date")).scalar()
    late = F.col("file_date") > F.date_sub(newest, LATE_DAYS)
    return every.withColumn("file_date", F.when(late, F.lit(LATE_LOAD)).otherwise(F.lit(FIRST_LOAD)))


def _lake_before_late_cancellations(spark: SparkSession, sf_dir: str) -> Lake:
    """Stored layers, with the fact and the cube built from the first load of cancellations."""
    lake = stored_rates(spark, sf_dir)
    lake.replace(jobs.INTERVALS, rates.rate_intervals(lake.read(jobs.RATES), START, END))
    stamped = silver_transactions(spark, sf_dir).withColumns(
        {"processed_at": F.lit(roles.LOADED_AT).cast("timestamp"), "slot": F.concat(F.substring("slot", 1, 1), F.lit("0-00"))}
    )
    lake.replace(jobs.TRANSACTIONS, stamped)
    dictionaries = {"users": roles.users, "test_users": roles.test_users, "promo_codes": roles.promo_codes}
    for name, table in dictionaries.items():
        known = table(spark, sf_dir)
        columns = TABLES[f"dictionaries/{name}"].schema.fields
        missing = {f.name: F.lit(None).cast(f.dataType) for f in columns if f.name not in known.columns}
        lake.replace(f"dictionaries/{name}", known.withColumns(missing) if missing else known)
    both = _cancellations_in_two_loads(spark, sf_dir)
    lake.overwrite_values(jobs.CANCELLATIONS, both, [FIRST_LOAD])
    lake.ensure(latest.LATEST)
    latest.merge_latest(lake, [FIRST_LOAD])
    lake.replace(latest.PENDING, spark.createDataFrame([], TABLES[latest.PENDING].schema))
    jobs.build_fact(lake, START, END)
    jobs.export_cube(lake, START, END)
    lake.overwrite_values(jobs.CANCELLATIONS, both, [LATE_LOAD])
    return lake


def _rewritten(lake: Lake, name: str, before: dict[str, set[str]], column: str) -> Column:
    """Whether the files of a row's day are others than before; at most one entry per day."""
    after = lake.files_of(name, lake.partition_values(name))
    days = [day for day in after if after[day] != before.get(day)]
    return F.col(column).cast("string").isin(days).alias("rewritten")


@query
def q33_late_cancellations(spark, sf_dir):
    """The newest cancellations arrive after the fact was built: only file days they touch are replaced."""
    lake = _lake_before_late_cancellations(spark, sf_dir)
    before = lake.files_of(jobs.FACT, lake.partition_values(jobs.FACT))
    rebuild.apply_cancellations(lake, [LATE_LOAD])
    rewritten = _rewritten(lake, jobs.FACT, before, "file_date")
    return shown(
        lake.read(jobs.FACT).withColumn("rewritten", rewritten),
        "transaction_id", "file_date", "created_at", "currency", "amount_tgrk", "cancellation_id", "cancelled_at",
        "is_cancelled", "refund_amount_tgrk", "net_amount_tgrk", "duplicate_count", "is_duplicate_transaction",
        "user_segment", "is_promo_found", "rate_interval_id", "gold_window_start", "gold_window_end", "rewritten",
    )


@query
def q34_cube_of_touched_days(spark, sf_dir):
    """The cube after late cancellations: only event days of the replaced file days are replaced."""
    lake = _lake_before_late_cancellations(spark, sf_dir)
    before = lake.files_of(jobs.CUBE, lake.partition_values(jobs.CUBE))
    rebuild.apply_cancellations(lake, [LATE_LOAD])
    return shown(lake.read(jobs.CUBE).withColumn("rewritten", _rewritten(lake, jobs.CUBE, before, "event_date")))


@query
def q35_latest_cancellations_kept(spark, sf_dir):
    """The table of latest cancellations after two loads, of which the second is then loaded anew without its
    dated rows, and a third time whole."""
    lake = scratch_lake(spark)
    both = _cancellations_in_two_loads(spark, sf_dir)
    late = both.where(F.col("file_date") == F.lit(LATE_LOAD))
    lake.ensure(latest.PENDING)
    for day, rows in (
        (FIRST_LOAD, both.where(F.col("file_date") == F.lit(FIRST_LOAD))),
        (LATE_LOAD, late),
        (LATE_LOAD, late.where(F.col("cancelled_at").isNull())),
        (LATE_LOAD, late),
    ):
        lake.overwrite_values(jobs.CANCELLATIONS, rows, [day])
        latest.merge_latest(lake, [day])
    return shown(lake.read(latest.LATEST), *[c for c in ("original_transaction_id", *latest.KEPT_COLUMNS)])


@query
def q36_asof_merge_scan(spark, sf_dir):
    """The rates of q06, found by the merge scan."""
    priced = merge_scan.attach_rates_by_scan(
        base_transactions(spark, sf_dir), stored_intervals(spark, sf_dir), rows_per_part=5_000
    )
    return shown(
        facts.with_base_amount(facts.with_rate_state(priced)),
        "transaction_id", "created_at", "currency", "amount", "amount_tgrk", "rate_interval_id", "rate_timestamp",
        "rate_date", "rate_tgrk_punk", "rate_tgrk_rub", "is_rate_found", "is_rate_valid", "rate_selection_strategy",
        "rate_time_diff_minutes",
    )


def _backfilled(spark: SparkSession, sf_dir: str) -> Lake:
    """All events landed as files of slots, some lines cut short, and loaded from the list of missing slots:
    one batch of the usual size, then all the rest."""
    lake = scratch_lake(spark)
    root = f"{lake.root}-raw"
    cut = F.concat(F.lit('{"transaction_id": "'), F.col("transaction_id"), F.lit('", "amount": abc'))
    whole = F.to_json(F.struct(*[F.col(name) for name in roles.TRANSACTION_TEXTS]))
    lines = roles.transactions(spark, sf_dir).select(
        F.when(F.col("amount") == "abc", cut).otherwise(whole).alias("value"),
        F.col("file_date").alias("day"),
        F.concat(F.substring("slot", 1, 1), F.lit("0-00")).alias("slot"),
    )
    lines.repartition("day", "slot", F.pmod(F.xxhash64("value"), F.lit(2))).write.partitionBy("day", "slot").text(f"{root}/transactions")
    expected = lines.select("day", "slot").distinct()
    backfill.catch_up(lake, root, expected, calendar.CATCH_UP_LIMIT, file_glob="*.txt")
    backfill.load_slots(lake, root, backfill.missing_transactions(lake, expected, 1 << 20), file_glob="*.txt")
    return lake


@query
def q37_batch_backfill(spark, sf_dir):
    """Per slot: rows of its files by the audit table, rows stored, malformed lines kept aside."""
    lake = _backfilled(spark, sf_dir)
    slot = ["file_date", "slot"]
    told = lake.read(AUDIT_TABLE).groupBy(slot).agg(F.sum("rows_written").alias("rows_written"))
    stored = lake.read(jobs.TRANSACTIONS).groupBy(slot).agg(F.count(F.lit(1)).alias("stored_rows"))
    aside = lake.read(quarantine.TABLE).groupBy(slot).agg(F.count(F.lit(1)).alias("malformed_lines"))
    met = told.join(stored, slot, "full").join(aside, slot, "full").na.fill(0)
    return met.withColumn("file_date", F.col("file_date").cast("string"))


@query
def q38_quarantined_lines(spark, sf_dir):
    """The text of every malformed line, with its source, day and slot."""
    lines = _backfilled(spark, sf_dir)
    return shown(lines.read(quarantine.TABLE), "source_name", "file_date", "slot", "line")
