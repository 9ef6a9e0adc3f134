"""The loads and builds, each one pass over its input with an audit event at the end.

``raw_root`` is the landing folder or bucket; ``bucket`` is only recorded as lineage.
"""

from __future__ import annotations

from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerwell.operators.cube import hourly_cube
from ledgerwell.operators.dictionaries import typed_dictionary
from ledgerwell.operators.facts import enriched_fact
from ledgerwell.operators.rates import rate_intervals
from ledgerwell.operators.silver import clean_cancellations, clean_rates, clean_transactions
from ledgerwell.plans.audit import LoadEvent, audited, new_run_id
from ledgerwell.schemas import RAW_CANCELLATIONS, RAW_DICTIONARIES, RAW_RATES, RAW_TRANSACTIONS
from ledgerwell.sources import jsonl, quarantine
from ledgerwell.sources.lake import Lake, in_days, write_json_lines

TRANSACTIONS = "silver/transactions_clean"
RATES = "silver/exchange_rates_clean"
CANCELLATIONS = "silver/cancellations_clean"
CANCELLATIONS_BRONZE = "bronze/cancellations_raw"
INTERVALS = "gold/dim_exchange_rate_intervals"
FACT = "gold/fct_transactions_enriched"
FACT_DAYS = "gold/fact_days"
CUBE = "serving/transactions_cube_hourly"


def _file_event(job: str, source: str, target: str, path: str, root: str, bucket: str, **more) -> LoadEvent:
    return LoadEvent(
        run_id=more.pop("run_id", None) or new_run_id(),
        job_name=job,
        source_name=source,
        target_table=target,
        raw_object_path=path.removeprefix(f"{root}/"),
        source_url=path,
        raw_bucket=bucket,
        **more,
    )


def load_transactions(
    lake: Lake, raw_root: str, day: str, slot: str, *, run_id: str | None = None, bucket: str = "raw"
) -> int:
    """Parse one slot file into its own partition, replacing what was there."""
    path = jsonl.transactions_path(raw_root, day, slot)
    event = _file_event(
        "load_transactions", "transactions", TRANSACTIONS, path, raw_root, bucket,
        run_id=run_id, file_date=day, slot=slot,
    )
    with audited(lake, event):
        raw = jsonl.with_origin(
            jsonl.read_transactions(lake.spark, path, keep_malformed=True),
            bucket=bucket, object_path=event.raw_object_path, file_date=day, slot=slot,
        )
        watched, seen = quarantine.watched(raw)
        rows = lake.overwrite_partition(TRANSACTIONS, clean_transactions(watched), {"file_date": day, "slot": slot})
        lines = quarantine.malformed_lines(raw, "transactions", RAW_TRANSACTIONS.names, slot)
        quarantine.replace(lake, lines, [quarantine.cell("transactions", day, slot)], seen.get["malformed"])
        event.rows_read = event.rows_written = rows
    return rows


def load_rates(
    lake: Lake,
    raw_root: str,
    day: str,
    *,
    run_id: str | None = None,
    bucket: str = "raw",
    missing_ok: bool = False,
) -> int | None:
    """Parse one day of rates. With ``missing_ok`` a day without a file is no error and loads nothing."""
    path = jsonl.rates_path(raw_root, day)
    if missing_ok:
        try:
            jsonl.read_rates(lake.spark, path)
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return None
            raise
    event = _file_event(
        "load_rates", "exchange_rates", RATES, path, raw_root, bucket, run_id=run_id, file_date=day
    )
    with audited(lake, event):
        raw = jsonl.with_origin(
            jsonl.read_rates(lake.spark, path, keep_malformed=True),
            bucket=bucket, object_path=event.raw_object_path, file_date=day,
        )
        watched, seen = quarantine.watched(raw)
        event.rows_read = event.rows_written = lake.overwrite_partition(RATES, clean_rates(watched), {"file_date": day})
        lines = quarantine.malformed_lines(raw, "exchange_rates", RAW_RATES.names)
        quarantine.replace(lake, lines, [quarantine.cell("exchange_rates", day)], seen.get["malformed"])
    return event.rows_written


def load_cancellations(
    lake: Lake, raw_root: str, day: str, *, run_id: str | None = None, bucket: str = "raw"
) -> int:
    path = jsonl.cancellations_path(raw_root, day)
    event = _file_event(
        "load_cancellations", "cancellations", CANCELLATIONS, path, raw_root, bucket,
        run_id=run_id, file_date=day,
    )
    with audited(lake, event):
        raw = jsonl.with_origin(
            jsonl.read_cancellations(lake.spark, path, keep_malformed=True),
            bucket=bucket, object_path=event.raw_object_path, file_date=day,
        )
        watched, seen = quarantine.watched(raw)
        event.rows_read = event.rows_written = lake.overwrite_partition(
            CANCELLATIONS, clean_cancellations(watched), {"file_date": day}
        )
        lines = quarantine.malformed_lines(raw, "cancellations", RAW_CANCELLATIONS.names)
        quarantine.replace(lake, lines, [quarantine.cell("cancellations", day)], seen.get["malformed"])
    return event.rows_written


def load_cancellations_bronze(
    lake: Lake, raw_root: str, day: str, *, run_id: str | None = None, bucket: str = "raw"
) -> int:
    """Keep one day of cancellations as text, with lineage."""
    path = jsonl.cancellations_path(raw_root, day)
    event = _file_event(
        "load_cancellations_bronze", "cancellations", CANCELLATIONS_BRONZE, path, raw_root, bucket,
        run_id=run_id, file_date=day,
    )
    with audited(lake, event):
        raw = jsonl.with_origin(
            jsonl.read_cancellations(lake.spark, path),
            bucket=bucket, object_path=event.raw_object_path, file_date=day,
        )
        event.rows_read = event.rows_written = lake.overwrite_partition(
            CANCELLATIONS_BRONZE, raw, {"file_date": day}
        )
    return event.rows_written


def load_dictionary(
    lake: Lake, raw_root: str, name: str, *, run_id: str | None = None, bucket: str = "raw"
) -> int:
    """Replace a dictionary by its current file."""
    path = jsonl.dictionary_path(raw_root, name)
    target = f"dictionaries/{name}"
    event = _file_event("load_dictionaries", "dictionaries", target, path, raw_root, bucket, run_id=run_id)
    with audited(lake, event):
        raw = jsonl.read_dictionary(lake.spark, name, path)
        event.rows_read = event.rows_written = lake.replace(target, typed_dictionary(name, raw))
    return event.rows_written


def load_dictionaries(lake: Lake, raw_root: str, *, run_id: str | None = None, bucket: str = "raw") -> dict[str, int]:
    run_id = run_id or new_run_id()
    return {name: load_dictionary(lake, raw_root, name, run_id=run_id, bucket=bucket) for name in RAW_DICTIONARIES}


def load_reference(lake: Lake, name: str, path: str) -> int:
    """Replace a reference table by a file whose schema is taken from the data; not audited."""
    loaded = jsonl.read_inferred(lake.spark, path).withColumn("loaded_at", F.current_timestamp())
    return lake.replace_untyped(f"reference/{name}", loaded)


def day_map(fact: DataFrame) -> DataFrame:
    """Which event days the files of a day hold, with row counts, and the window the day was built in."""
    keys = ("file_date", "created_date", "gold_window_start", "gold_window_end")
    return fact.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count"))


def _window_event(job: str, source: str, target: str, prefix: str, start, end, run_id: str | None) -> LoadEvent:
    return LoadEvent(
        run_id=run_id or new_run_id(),
        job_name=job,
        source_name=source,
        target_table=target,
        raw_object_path=f"{prefix}/start={start}/end={end}",
        file_date=start,
    )


def build_rate_intervals(lake: Lake, start: str | date, end: str | date, *, run_id: str | None = None) -> int:
    """Rebuild all intervals from all rates; a full replace leaves no stale interval behind."""
    event = _window_event(
        "build_rate_intervals", "exchange_rate_intervals", INTERVALS, "gold_window", start, end, run_id
    )
    with audited(lake, event):
        event.rows_written = lake.replace(INTERVALS, rate_intervals(lake.read(RATES), start, end))
        # Each usable rate gives one interval; the first one also gives the interval before it.
        event.rows_read = max(event.rows_written - 1, 0)
    return event.rows_written


def fact_of(lake: Lake, start: str | date, end: str | date, **sizes: int) -> DataFrame:
    """The enriched fact of a window, from the stored tables; ``sizes`` as in ``enriched_fact``."""
    return enriched_fact(
        lake.read(TRANSACTIONS),
        users=lake.read("dictionaries/users"),
        test_users=lake.read("dictionaries/test_users"),
        promo_codes=lake.read("dictionaries/promo_codes"),
        intervals=lake.read(INTERVALS),
        cancellations=lake.read(CANCELLATIONS),
        start=start,
        end=end,
        **sizes,
    )


def build_fact(lake: Lake, start: str | date, end: str | date, *, run_id: str | None = None, **sizes: int) -> int:
    """Rebuild the fact for files of ``start..end``; every lookup keeps the row count."""
    event = _window_event(
        "build_fact", "gold_transactions_enriched", FACT, "gold_window", start, end, run_id
    )
    with audited(lake, event):
        rows = lake.overwrite_days(FACT, fact_of(lake, start, end, **sizes), start, end)
        lake.overwrite_days(FACT_DAYS, day_map(lake.read(FACT).where(in_days("file_date", start, end))), start, end)
        event.rows_read = event.rows_written = rows
    return rows


def export_cube(
    lake: Lake,
    start: str | date,
    end: str | date,
    *,
    run_id: str | None = None,
    json_path: str | None = None,
) -> int:
    """Replace the cube of the days ``start..end`` and, if asked for, write it as JSON lines."""
    event = _window_event(
        "export_cube", "transactions_cube_hourly", CUBE, "cube_window", start, end, run_id
    )
    with audited(lake, event, keep_counts_on_failure=True):
        lake.ensure(CUBE)
        event.rows_written = lake.overwrite_days(CUBE, hourly_cube(lake.read(FACT), start, end), start, end)
        cube = lake.read(CUBE).where(F.col("event_date").between(F.lit(start).cast("date"), F.lit(end).cast("date")))
        event.rows_read = cube.agg(F.sum("transactions_count")).first()[0] or 0
        if json_path:
            write_json_lines(cube, json_path)
    return event.rows_written
