"""Marks for rows that share a transaction id. A mark is a warning; no row is removed."""

from __future__ import annotations

from collections.abc import Sequence
from uuid import uuid4

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerwell.operators.hotkeys import HOT_SPREAD, SCATTER, SPREAD, with_spread
from ledgerwell.session import shared_folder

KEY = "transaction_id"

# The rank orders by the first four, newest first; the others only make ties reproducible.
_NEWEST_FIRST = ("created_at", "file_date", "slot", "transaction_processed_at")
_TIE_BREAKS = (
    "source_file",
    "user_id",
    "user_uuid",
    "amount",
    "currency",
    "transaction_type",
    "status",
    "promo_code_id",
    "transaction_validation_errors",
)


def _rank_order() -> list[Column]:
    return [F.col(name).desc_nulls_last() for name in _NEWEST_FIRST] + [F.col(name) for name in _TIE_BREAKS]


def mark_duplicates(df: DataFrame, hot: Sequence[int] = (), within: Sequence[str] = ()) -> DataFrame:
    """Add ``duplicate_count``, ``duplicate_rank``, ``is_duplicate_transaction`` and ``_spread``.

    ``df`` carries ``_scatter`` (see ``with_scatter``). Rows without an id get NULL marks and are spread over tasks. Ids listed in ``hot`` are ranked
    across many tasks (see ``_rank_hot``), all others within their own group. ``within`` names columns that
    part the rows further: ids are compared only where these are equal.
    """
    spread = with_spread(df, KEY)
    if not hot:
        marked = _rank_grouped(spread, within)
    else:
        is_hot = F.coalesce(F.col(KEY).isin(*hot), F.lit(False))
        marked = _rank_grouped(spread.where(~is_hot), within).unionByName(_rank_hot(spread.where(is_hot), within))
    has_id = F.col(KEY).isNotNull()
    return marked.withColumns(
        {
            "duplicate_count": F.when(has_id, F.col("_count")),
            "duplicate_rank": F.when(has_id, F.col("_rank").cast("bigint")),
            "is_duplicate_transaction": F.coalesce(has_id & (F.col("_count") > 1), F.lit(False)),
        }
    ).drop("_count", "_rank")


def _rank_grouped(df: DataFrame, within: Sequence[str]) -> DataFrame:
    if within:
        # Dealt out by the keys of the cancellation join, which then needs no shuffle of its own.
        df = df.repartition(KEY, SPREAD)
    group = Window.partitionBy(KEY, SPREAD, *within)
    return df.withColumns(
        {
            "_rank": F.row_number().over(group.orderBy(*_rank_order())),
            "_count": F.count(F.lit(1)).over(group),
        }
    )


def _rank_hot(df: DataFrame, within: Sequence[str]) -> DataFrame:
    """Exact ranks of few ids with very many rows each.

    The rows are cut into blocks along the rank order; a row's rank is the number of rows of its
    id in earlier blocks plus its position in its own block. A running number makes even exact
    copies separable. Block borders come from sampling, so the blocks are written to the shared
    folder once and both steps read the same ones, also after a lost executor.
    """
    spark = df.sparkSession
    blocks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [*_rank_order(), F.col("_seat")]
    folder = f"{shared_folder(spark)}/ranked-{uuid4()}"
    (
        df.withColumn("_seat", F.monotonically_increasing_id())
        .repartitionByRange(blocks, F.col(KEY), *within, *order)
        .withColumn("_block", F.spark_partition_id())
        .write.parquet(folder)
    )
    staged = spark.read.parquet(folder)
    by_key = Window.partitionBy(KEY, *within)
    earlier = by_key.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    # Blocks follow one another, so there are fewer of these rows than groups and blocks together.
    sizes = (
        staged.groupBy(KEY, *within, "_block")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select(
            KEY,
            *within,
            "_block",
            F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"),
            F.sum("_rows").over(by_key).alias("_count"),
        )
    )
    position = F.row_number().over(Window.partitionBy(KEY, *within, "_block").orderBy(*order))
    return (
        staged.join(F.broadcast(sizes), [KEY, *within, "_block"])
        .withColumns({"_rank": (F.col("_before") + position).cast("int"), SPREAD: F.col(SCATTER) % HOT_SPREAD})
        .select(*df.columns, "_rank", "_count")
    )
