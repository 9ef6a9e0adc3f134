"""New slot files as a stream: the slots they belong to are loaded anew from all of their files."""

from __future__ import annotations

import traceback
from urllib.parse import unquote

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerwell.operators.silver import clean_transactions
from ledgerwell.plans.audit import AUDIT_TABLE, LoadEvent, write_failure
from ledgerwell.plans.jobs import TRANSACTIONS
from ledgerwell.schemas import RAW_TRANSACTIONS
from ledgerwell.sources import jsonl
from ledgerwell.sources.jsonl import SLOT_FILE
from ledgerwell.sources.lake import Lake

JOB_NAME = "stream_transactions"


def transaction_stream(
    lake: Lake, raw_root: str, *, bucket: str = "raw", files_per_batch: int = 1000, file_glob: str = SLOT_FILE
) -> DataFrame:
    """The raw rows of all slot files, with day and slot taken from the folders."""
    lines = (
        lake.spark.readStream.schema(RAW_TRANSACTIONS)
        .option("maxFilesPerTrigger", files_per_batch)
        .option("pathGlobFilter", file_glob)
        .option("recursiveFileLookup", "true")
        .json(f"{raw_root}/transactions")
    )
    return jsonl.with_slot(lines, RAW_TRANSACTIONS.names, bucket)


def ingest_transactions(
    lake: Lake,
    raw_root: str,
    checkpoint: str,
    *,
    bucket: str = "raw",
    files_per_batch: int = 1000,
    file_glob: str = SLOT_FILE,
) -> StreamingQuery:
    """Load every slot file not seen before, then stop; run it again for what arrived meanwhile.

    A slot may have several files, which may arrive in different batches: the slots of a batch's new
    files are read anew with all their files and replaced, so no file is lost, and a batch that is
    repeated after a failure changes nothing. Audit events, one per new file, are derived from the
    written rows; a batch that fails leaves one ``failed`` event, and the stream ends with its error.
    """

    def load(batch: DataFrame, batch_id: int) -> None:
        try:
            load_slots(batch, batch_id)
        except Exception:
            event = LoadEvent(
                run_id=f"{JOB_NAME}-{batch_id}",
                job_name=JOB_NAME,
                source_name="transactions",
                target_table=TRANSACTIONS,
                raw_object_path="transactions",
                source_url=f"{raw_root}/transactions",
                raw_bucket=bucket,
            )
            write_failure(lake, event, traceback.format_exc())
            raise

    def load_slots(batch: DataFrame, batch_id: int) -> None:
        started = F.current_timestamp()
        keys = ["file_date", "slot", "raw_object_path"]
        files = batch.select(*keys, F.regexp_extract("source_file", "^(.*/slot=[^/]+)/", 1).alias("folder")).distinct().persist()
        # At most as many folders as a batch has files.
        folders = sorted(unquote(r.folder) for r in files.select("folder").distinct().collect())
        if not folders:
            files.unpersist()
            return
        lines = (
            lake.spark.read.schema(RAW_TRANSACTIONS)
            .option("pathGlobFilter", file_glob)
            .option("recursiveFileLookup", "true")
            .json(folders)
        )
        lake.overwrite_partitions(TRANSACTIONS, clean_transactions(jsonl.with_slot(lines, RAW_TRANSACTIONS.names, bucket)))
        counts = (
            lake.read(TRANSACTIONS)
            .join(F.broadcast(files.select(*keys)), keys, "left_semi")
            .groupBy(*keys)
            .agg(F.count(F.lit(1)).alias("rows_read"))
        )
        events = counts.select(
            F.lit(f"{JOB_NAME}-{batch_id}").alias("run_id"),
            F.lit(JOB_NAME).alias("job_name"),
            F.lit("transactions").alias("source_name"),
            F.lit(None).cast("string").alias("source_url"),
            F.lit(bucket).alias("raw_bucket"),
            "raw_object_path",
            F.lit(TRANSACTIONS).alias("target_table"),
            "file_date",
            "slot",
            F.lit("loaded").alias("status"),
            "rows_read",
            F.col("rows_read").alias("rows_written"),
            F.lit(None).cast("bigint").alias("file_size_bytes"),
            F.lit(None).cast("string").alias("error_message"),
            started.alias("started_at"),
            F.current_timestamp().alias("finished_at"),
            F.current_timestamp().alias("created_at"),
        )
        lake.append(AUDIT_TABLE, events)
        files.unpersist()

    return (
        transaction_stream(lake, raw_root, bucket=bucket, files_per_batch=files_per_batch, file_glob=file_glob)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
