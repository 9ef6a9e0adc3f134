"""Finding keys that hold so many rows that one task should not get them all."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A key with fewer rows is left to one task.
HOT_ROWS = 2_000_000
# Sketches are kept per hash group; the answer has at most GROUPS * KEYS_PER_GROUP keys.
GROUPS = 64
KEYS_PER_GROUP = 64
TRACKED = 2048

# Columns that spread rows: a running number below SCATTER_WIDTH, and the second half of a join or
# grouping key made from it.
SCATTER = "_scatter"
SPREAD = "_spread"
SCATTER_WIDTH = 4096
HOT_SPREAD = 256


def hot_keys(df: DataFrame, key: str, min_rows: int = HOT_ROWS) -> list:
    """Keys with about ``min_rows`` rows or more, found by one pass over the key column alone.

    Only frequency sketches of fixed size are shuffled. The list has at most 4096 keys however
    large ``df`` is; a key that is left out holds under about a thousandth of all rows.
    """
    group = F.pmod(F.xxhash64(key), F.lit(GROUPS)).alias("_group")
    found = (
        df.where(F.col(key).isNotNull())
        .select(key, group)
        .groupBy("_group")
        .agg(F.expr(f"approx_top_k({key}, {KEYS_PER_GROUP}, {TRACKED})").alias("tops"))
        .select(F.explode("tops").alias("top"))
        .where(F.col("top.count") >= min_rows)
        .select("top.item")
    )
    return [row[0] for row in found.collect()]


def with_scatter(df: DataFrame) -> DataFrame:
    """Add ``_scatter``: it tells rows apart even when they are all alike, as a hash would not.

    It is made once, at the scan; made later it would keep filters from moving below it.
    """
    return df.withColumn(SCATTER, F.pmod(F.monotonically_increasing_id(), F.lit(SCATTER_WIDTH)).cast("int"))


def with_spread(df: DataFrame, key: str, hot: Sequence = ()) -> DataFrame:
    """Add ``_spread``: 0 for ordinary keys, part of ``_scatter`` for hot keys, all of it for NULLs.

    Partitioning by (key, _spread) keeps an ordinary key together but neither the NULLs nor a hot key.
    """
    spread = F.when(F.col(key).isNull(), F.col(SCATTER))
    if hot:
        spread = spread.when(F.col(key).isin(*hot), F.col(SCATTER) % HOT_SPREAD)
    return df.withColumn(SPREAD, spread.otherwise(F.lit(0)))
