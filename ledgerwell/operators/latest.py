"""The latest cancellation of each transaction as a table that grows with each load.

Ids are dealt over a fixed number of buckets, each a partition. A load compares its own rows with what its
buckets hold, so neither the history of cancellations nor untouched buckets are read again. Only an id whose
latest row came from a day that was loaded anew is looked up in the history.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from uuid import uuid4

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerwell.operators.cancellations import KEPT_COLUMNS, candidate_cancellations
from ledgerwell.operators.dictionaries import one_row_per_key
from ledgerwell.schemas import TABLES
from ledgerwell.session import shared_folder
from ledgerwell.sources.lake import Lake

LATEST = "gold/latest_cancellations"
PENDING = "control/pending_cancellations"
CANCELLATIONS = "silver/cancellations_clean"
ID = "original_transaction_id"
BUCKETS = 64


def _of_days(silver: DataFrame) -> DataFrame:
    return candidate_cancellations(silver, F.col("file_date").alias("source_day"))


def _newest(candidates: DataFrame) -> DataFrame:
    return one_row_per_key(candidates, ID, "cancelled_at", "processed_at", "cancellation_id")


def _staged(df: DataFrame) -> DataFrame:
    """Written once to the shared folder: what follows replaces the tables ``df`` was made from."""
    folder = f"{shared_folder(df.sparkSession)}/latest-{uuid4()}"
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def merge_latest(lake: Lake, days: Sequence[date]) -> DataFrame:
    """Bring the table up to date after cancellation files of ``days`` were loaded, or loaded anew.

    Ids whose latest cancellation came, changed or went are added to the pending ids before the table is
    replaced, so none is forgotten if a run ends between this step and the rebuild of their facts; they are
    returned too. Running it again changes nothing.
    """
    lake.ensure(LATEST)
    state, silver = lake.read(LATEST).drop("bucket"), lake.read(CANCELLATIONS)
    loaded = _of_days(silver.where(F.col("file_date").isin(list(days))))
    kept, outdated = state.where(~F.col("source_day").isin(list(days))), state.where(F.col("source_day").isin(list(days)))
    outdated_ids = outdated.select(ID)
    touched = _staged(loaded.select(ID).unionByName(outdated_ids).distinct())
    candidates = loaded.unionByName(kept.join(touched, ID, "left_semi"))
    if not outdated.isEmpty():
        elsewhere = silver.where(~F.col("file_date").isin(list(days)))
        candidates = candidates.unionByName(_of_days(elsewhere).join(outdated_ids, ID, "left_semi"))
    newest = _staged(_newest(candidates))
    bucket = F.pmod(F.xxhash64(ID), F.lit(BUCKETS))
    # At most BUCKETS numbers.
    buckets = [row[0] for row in touched.select(bucket.alias("bucket")).distinct().collect()]
    if not buckets:
        return touched
    was = state.join(touched, ID, "left_semi").select(ID, F.struct(*KEPT_COLUMNS).alias("was"))
    now = newest.select(ID, F.struct(*KEPT_COLUMNS).alias("now"))
    changed = _staged(touched.join(was, ID, "left").join(now, ID, "left").where(~F.col("was").eqNullSafe(F.col("now"))).select(ID))
    lake.append(PENDING, changed)
    untouched = lake.read(LATEST).where(F.col("bucket").isin(buckets)).drop("bucket").join(touched, ID, "left_anti")
    merged = _staged(untouched.unionByName(newest).withColumn("bucket", bucket))
    lake.overwrite_values(LATEST, merged.select(*TABLES[LATEST].schema.names), buckets)
    return changed
