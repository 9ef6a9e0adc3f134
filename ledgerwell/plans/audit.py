"""One audit event per load attempt, written on success and on failure."""

from __future__ import annotations

import logging
import traceback
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field
from datetime import date, datetime, timezone
from uuid import uuid4

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerwell.schemas import TABLES
from ledgerwell.sources.lake import Lake, as_date

AUDIT_TABLE = "control/file_load_audit"
ERROR_LENGTH = 4000

log = logging.getLogger(__name__)


def new_run_id() -> str:
    return str(uuid4())


def _now() -> datetime:
    return datetime.now(timezone.utc)


@dataclass
class LoadEvent:
    """What an audit row says; a job fills in the counts as it goes."""

    run_id: str
    job_name: str
    source_name: str
    target_table: str
    raw_object_path: str
    source_url: str | None = None
    raw_bucket: str | None = None
    file_date: str | date | None = None
    slot: str | None = None
    status: str = "loaded"
    rows_read: int | None = None
    rows_written: int | None = None
    file_size_bytes: int | None = None
    error_message: str | None = None
    started_at: datetime = field(default_factory=_now)
    finished_at: datetime | None = None
    created_at: datetime | None = None

    def row(self) -> tuple:
        values = dict(vars(self), created_at=_now())
        if self.file_date is not None:
            values["file_date"] = as_date(self.file_date)
        return tuple(values[name] for name in TABLES[AUDIT_TABLE].schema.names)


def write_event(lake: Lake, event: LoadEvent) -> None:
    lake.append(AUDIT_TABLE, lake.spark.createDataFrame([event.row()], TABLES[AUDIT_TABLE].schema))


def write_failure(lake: Lake, event: LoadEvent, message: str) -> None:
    """Record that a load failed; if even that fails, it is only logged: the load's own error matters more."""
    event.status = "failed"
    event.finished_at = _now()
    event.error_message = message[:ERROR_LENGTH]
    try:
        write_event(lake, event)
    except Exception as audit_error:
        log.warning("audit event not written: %s", audit_error)


@contextmanager
def audited(lake: Lake, event: LoadEvent, *, keep_counts_on_failure: bool = False) -> Iterator[LoadEvent]:
    """Run a load and record how it ended. The error of a failed load is raised again; an audit
    write that fails on top of it is only logged."""
    try:
        yield event
        event.finished_at = _now()
        write_event(lake, event)
    except Exception as error:
        if not keep_counts_on_failure:
            event.rows_read = event.rows_written = None
        write_failure(lake, event, str(error) if keep_counts_on_failure else traceback.format_exc())
        raise


def audit_trail(lake: Lake, run_id: str) -> DataFrame:
    return (
        lake.read(AUDIT_TABLE)
        .where(F.col("run_id") == run_id)
        .select("run_id", "job_name", "raw_object_path", "target_table", "status", "rows_written", "created_at")
        .orderBy("created_at")
    )


def table_counts(lake: Lake, names: list[str]) -> DataFrame:
    """Row count of each table, as one report."""
    counts = [
        lake.read(name).agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name in names
    ]
    report = counts[0]
    for more in counts[1:]:
        report = report.unionByName(more)
    return report
