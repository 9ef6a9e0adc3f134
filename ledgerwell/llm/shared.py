"""Helpers of the operators: staged tables, the shared folder, input columns."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerwell.session import shared_folder, use_local_folder

# Texts are long: small batches keep a worker's memory low. Runtime settings of the session.
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "2000", "spark.sql.execution.arrow.maxBytesPerBatch": "16m"}

# Words everywhere in this package: runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def prepared(spark: SparkSession) -> SparkSession:
    """The session with the batch sizes these operators use; a local trial gets a shared folder."""
    for key, value in BATCHES.items():
        spark.conf.set(key, value)
    return use_local_folder(spark)


def give_back() -> None:
    """Hand unused memory of this worker back to the system, where the C library can."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` for ``mapInArrow``; at a partition's end unused memory goes back to the system, because the
    worker lives on for other stages."""

    def through(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()

    return through


def documents(spark: SparkSession, sf_dir: str, table: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir``, which all executors share."""
    return f"{shared_folder(spark)}/llm-{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: lineage ends here, and a lost
    executor costs a re-read of this table and not the work before it."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(name: str, taken: Iterable[str]) -> str:
    """``name``, with underscores before it until no column is called so; Spark ignores case."""
    known = {c.lower() for c in taken}
    while name.lower() in known:
        name = f"_{name}"
    return name


def crc32_of_id(doc_id: str = "doc_id") -> F.Column:
    """crc32 of the id's decimal text; a missing id counts as the empty text."""
    return F.crc32(F.encode(F.coalesce(F.col(doc_id).cast("string"), F.lit("")), "UTF-8"))
