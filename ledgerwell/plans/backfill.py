"""Many landed slots in one load: what is missing is read in one scan and written in one overwrite.

The list of slots comes from the calendar and the audit table (``calendar.missing_slots``), day and slot of
each row from its file's folder. Every file leaves one audit row, also one without rows.
"""

from __future__ import annotations

import traceback
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerwell.operators.silver import clean_transactions
from ledgerwell.plans.audit import AUDIT_TABLE, LoadEvent, new_run_id, write_failure
from ledgerwell.plans.calendar import loaded_partitions, missing_slots
from ledgerwell.plans.jobs import TRANSACTIONS
from ledgerwell.schemas import RAW_TRANSACTIONS, TABLES
from ledgerwell.sources import jsonl, quarantine
from ledgerwell.sources.lake import Lake

JOB_NAME = "backfill_transactions"
SOURCE = "transactions"


@dataclass(frozen=True)
class SlotFile:
    day: date
    slot: str
    object_path: str
    size: int


@dataclass(frozen=True)
class Backfilled:
    """The files that were loaded, their rows, and the wanted slots that have not landed."""

    files: list[SlotFile]
    rows: int
    absent: list[tuple[date, str]]


def landed_files(lake: Lake, raw_root: str, slots: list[tuple[date, str]], glob: str = jsonl.SLOT_FILE) -> list[SlotFile]:
    """The files of ``slots``, found by listing their folders; none is opened."""
    found = []
    for day, slot in slots:
        folder = f"transactions/day={day}/slot={slot}"
        for name, size in sorted(lake.sizes(f"{raw_root}/{folder}", glob).items()):
            found.append(SlotFile(day, slot, f"{folder}/{name}", size))
    return found


def missing_transactions(lake: Lake, expected: DataFrame, limit: int) -> list[tuple[date, str]]:
    """The oldest slots of ``expected`` (day, slot) without a loaded file, at most ``limit`` of them."""
    lake.ensure(AUDIT_TABLE)
    loaded = loaded_partitions(lake.read(AUDIT_TABLE), TRANSACTIONS)
    return [(row["day"], row["slot"]) for row in missing_slots(expected, loaded, limit).collect()]


def load_slots(
    lake: Lake,
    raw_root: str,
    slots: list[tuple[date, str]],
    *,
    run_id: str | None = None,
    bucket: str = "raw",
    file_glob: str = jsonl.SLOT_FILE,
) -> Backfilled:
    """Load, or load again, all files of ``slots`` at once and replace exactly the partitions of those that
    have landed. A slot whose files have no rows ends up empty. Malformed lines go to quarantine too.

    The list is as long as the calendar is; rows are not seen by the driver. If the load fails, one
    ``failed`` event is left, no file counts as loaded, and the same slots can be loaded again.
    """
    run_id = run_id or new_run_id()
    started = F.current_timestamp()
    files = landed_files(lake, raw_root, slots, file_glob)
    landed = sorted({(f.day, f.slot) for f in files})
    absent = sorted(set(slots) - set(landed))
    if not files:
        return Backfilled([], 0, absent)
    try:
        lines = lake.spark.read.schema(jsonl.with_malformed(RAW_TRANSACTIONS)).option("columnNameOfCorruptRecord", jsonl.MALFORMED)
        folders = [f"{raw_root}/transactions/day={day}/slot={slot}" for day, slot in landed]
        raw = jsonl.with_slot(
            lines.option("pathGlobFilter", file_glob).option("recursiveFileLookup", "true").json(folders),
            [*RAW_TRANSACTIONS.names, jsonl.MALFORMED],
            bucket,
        )
        watched, seen = quarantine.watched(raw)
        cells = [{"file_date": str(day), "slot": slot} for day, slot in landed]
        rows = lake.overwrite_cells(TRANSACTIONS, clean_transactions(watched), cells)
        quarantine.replace(
            lake,
            quarantine.malformed_lines(raw, SOURCE, RAW_TRANSACTIONS.names, F.col("slot")),
            [quarantine.cell(SOURCE, day, slot) for day, slot in landed],
            seen.get["malformed"],
        )
        lake.append(AUDIT_TABLE, _events(lake, files, landed, run_id, bucket, started))
    except Exception:
        event = LoadEvent(
            run_id=run_id,
            job_name=JOB_NAME,
            source_name=SOURCE,
            target_table=TRANSACTIONS,
            raw_object_path="transactions",
            source_url=f"{raw_root}/transactions",
            raw_bucket=bucket,
        )
        write_failure(lake, event, traceback.format_exc())
        raise
    return Backfilled(files, rows, absent)


def _events(lake: Lake, files: list[SlotFile], landed: list[tuple[date, str]], run_id: str, bucket: str, started) -> DataFrame:
    """One event per file, with the rows that the table now holds of it."""
    listed = lake.spark.createDataFrame(
        [(f.day, f.slot, f.object_path, f.size) for f in files],
        "file_date date, slot string, raw_object_path string, file_size_bytes bigint",
    )
    days = sorted({day for day, _ in landed})
    held = lake.read(TRANSACTIONS).where(F.col("file_date").isin(days)).groupBy("file_date", "slot", "raw_object_path")
    counts = held.agg(F.count(F.lit(1)).alias("rows_written"))
    told = {
        "run_id": F.lit(run_id),
        "job_name": F.lit(JOB_NAME),
        "source_name": F.lit(SOURCE),
        "source_url": F.lit(None).cast("string"),
        "raw_bucket": F.lit(bucket),
        "target_table": F.lit(TRANSACTIONS),
        "status": F.lit("loaded"),
        "rows_written": F.coalesce("rows_written", F.lit(0)),
        "error_message": F.lit(None).cast("string"),
        "started_at": started,
        "finished_at": F.current_timestamp(),
        "created_at": F.current_timestamp(),
    }
    # The list of files is no longer than the calendar has slots, times the files of a slot.
    met = F.broadcast(listed).join(counts, ["file_date", "slot", "raw_object_path"], "left").withColumns(told)
    return met.withColumn("rows_read", F.col("rows_written")).select(*TABLES[AUDIT_TABLE].schema.names)


def catch_up(lake: Lake, raw_root: str, expected: DataFrame, limit: int, **options) -> Backfilled:
    """Load the oldest ``limit`` slots of ``expected`` that are missing. Slots that have not landed stay missing."""
    return load_slots(lake, raw_root, missing_transactions(lake, expected, limit), **options)
