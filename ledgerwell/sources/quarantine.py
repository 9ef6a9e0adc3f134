"""Malformed lines, kept whole beside the rows of NULLs that stand for them in the tables.

A file is read a second time only if its load met such a line, or if an earlier load of it left some here.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ledgerwell.sources.jsonl import MALFORMED
from ledgerwell.sources.lake import Lake

TABLE = "quarantine/malformed_lines"
# The slot of sources that have one file a day.
WHOLE_DAY = "whole-day"


def watched(raw: DataFrame) -> tuple[DataFrame, Observation]:
    """Count malformed lines (``malformed``) while ``raw`` is written elsewhere."""
    seen = Observation()
    return raw.observe(seen, F.count_if(F.col(MALFORMED).isNotNull()).alias("malformed")), seen


def malformed_lines(raw: DataFrame, source: str, fields: Sequence[str], slot: Column | str = WHOLE_DAY) -> DataFrame:
    """The malformed lines of ``raw`` with their origin, and how many ``fields`` were read from each all the same."""
    read = sum((F.col(name).isNotNull().cast("int") for name in fields), F.lit(0))
    return raw.where(F.col(MALFORMED).isNotNull()).select(
        F.col(MALFORMED).alias("line"),
        read.alias("fields_read"),
        "source_file",
        "raw_bucket",
        "raw_object_path",
        "loaded_at",
        F.lit(source).alias("source_name"),
        "file_date",
        (slot if isinstance(slot, Column) else F.lit(slot)).alias("slot"),
    )


def cell(source: str, day: object, slot: str = WHOLE_DAY) -> Mapping[str, str]:
    """The partition that holds the malformed lines of one file day, or of one slot."""
    return {"source_name": source, "file_date": str(day), "slot": slot}


def replace(lake: Lake, lines: DataFrame, cells: Sequence[Mapping[str, str]], met: int) -> None:
    """Replace the malformed lines of ``cells`` by ``lines``. ``met`` is how many the load met; without
    any, and with nothing stored before, nothing is read or written."""
    if met or any(lake.holds(TABLE, keys) for keys in cells):
        lake.overwrite_cells(TABLE, lines, cells)
