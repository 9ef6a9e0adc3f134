"""Rebuilds of what late cancellations touch, however old it is.

A late cancellation changes a few file days of the fact, anywhere in its history, and the event days of the
cube that their rows fall on. The day map kept at each fact write (``gold/fact_days``) says which event days a
file day holds and which file days an event day needs, so both tables are read and replaced by partition.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from datetime import date

from pyspark.sql import functions as F

from ledgerwell.operators.cube import hourly_cube_of
from ledgerwell.operators.facts import enriched_days
from ledgerwell.operators.joins import BROADCAST_ROWS, is_small
from ledgerwell.operators.latest import LATEST, PENDING, merge_latest
from ledgerwell.plans.audit import LoadEvent, audited, new_run_id
from ledgerwell.plans.calendar import affected_dates
from ledgerwell.plans.jobs import CUBE, FACT, FACT_DAYS, INTERVALS, TRANSACTIONS, day_map
from ledgerwell.schemas import TABLES
from ledgerwell.sources.lake import Lake, as_date


@dataclass(frozen=True)
class Rebuilt:
    """The partitions that were replaced."""

    file_days: list[date]
    event_days: list[date]


def _event(job: str, target: str, what: str, days: list[date], run_id: str | None) -> LoadEvent:
    return LoadEvent(
        run_id=run_id or new_run_id(),
        job_name=job,
        source_name=target.split("/")[-1],
        target_table=target,
        raw_object_path=f"{what}/{','.join(d.isoformat() for d in days)}"[:1000],
        file_date=days[0],
    )


def _event_days_of(lake: Lake, file_days: list[date]) -> set[date]:
    """At most as many as there are calendar days."""
    held = lake.read(FACT_DAYS).where(F.col("file_date").isin(file_days) & F.col("created_date").isNotNull())
    return {row[0] for row in held.select("created_date").distinct().collect()}


def _touched_file_days(lake: Lake) -> list[date]:
    """File days with a transaction whose latest cancellation is pending; at most all calendar days."""
    pending, fact = lake.read(PENDING), lake.read(FACT).select("transaction_id", "file_date")
    if is_small(pending, BROADCAST_ROWS):
        same = F.col("transaction_id") == F.col("original_transaction_id")
        touched = fact.join(F.broadcast(pending), same, "left_semi").select("file_date").distinct()
    else:
        touched = affected_dates(fact, pending)
    return sorted(row[0] for row in touched.collect())


def rebuild_days(lake: Lake, days: Iterable[str | date], *, run_id: str | None = None, **sizes: int) -> int:
    """Build the fact of single file days again, each in the window it was last built in, and replace these
    partitions alone. A day never built before gets a window of its own. Sizes as in ``enriched_fact``."""
    days = sorted(map(as_date, days))
    if not days:
        return 0
    with audited(lake, _event("rebuild_fact_days", FACT, "days", days, run_id)) as event:
        known = lake.read(FACT_DAYS).where(F.col("file_date").isin(days))
        windows = {day: (day, day) for day in days} | {
            row[0]: (row[1], row[2]) for row in known.select("file_date", "gold_window_start", "gold_window_end").distinct().collect()
        }
        fact = enriched_days(
            lake.read(TRANSACTIONS),
            windows,
            users=lake.read("dictionaries/users"),
            test_users=lake.read("dictionaries/test_users"),
            promo_codes=lake.read("dictionaries/promo_codes"),
            intervals=lake.read(INTERVALS),
            latest=lake.read(LATEST).drop("processed_at", "source_day", "bucket"),
            **sizes,
        )
        event.rows_read = event.rows_written = lake.overwrite_values(FACT, fact, days)
        lake.overwrite_values(FACT_DAYS, day_map(lake.read(FACT).where(F.col("file_date").isin(days))), days)
    return event.rows_written


def refresh_cube(lake: Lake, event_days: Iterable[str | date], *, run_id: str | None = None) -> int:
    """Replace single event days of the cube. The fact is read from the file days that hold their rows."""
    event_days = sorted(map(as_date, event_days))
    if not event_days:
        return 0
    with audited(lake, _event("refresh_cube_days", CUBE, "event_days", event_days, run_id)) as event:
        lake.ensure(CUBE)
        holding = lake.read(FACT_DAYS).where(F.col("created_date").isin(event_days))
        file_days = [row[0] for row in holding.select("file_date").distinct().collect()]
        fact = lake.read(FACT).where(F.col("file_date").isin(file_days))
        event.rows_written = lake.overwrite_values(CUBE, hourly_cube_of(fact, event_days), event_days)
    return event.rows_written


def apply_cancellations(lake: Lake, days: Iterable[str | date], *, run_id: str | None = None, **sizes: int) -> Rebuilt:
    """After cancellation files of ``days`` were loaded: bring the latest cancellations up to date, then
    replace the file days of the fact and the event days of the cube that this changes, and nothing else.

    Ids are pending until the run that rebuilt their facts and cube days ends, so a failed run is made up for
    by the next one, whichever days that is given.
    """
    run_id = run_id or new_run_id()
    lake.ensure(PENDING)
    merge_latest(lake, sorted(map(as_date, days)))
    file_days = _touched_file_days(lake)
    event_days = _event_days_of(lake, file_days)
    rebuild_days(lake, file_days, run_id=run_id, **sizes)
    event_days = sorted(event_days | _event_days_of(lake, file_days))
    refresh_cube(lake, event_days, run_id=run_id)
    lake.replace(PENDING, lake.spark.createDataFrame([], TABLES[PENDING].schema))
    return Rebuilt(file_days, event_days)
