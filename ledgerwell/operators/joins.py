"""Left joins to a side with at most one match per row, safe for crowded keys.

A small side is broadcast, after counting that it is small. A larger one is shuffled by (key,
spread): rows of a crowded key and rows without a key get many spread values, and the few crowded
keys of the other side are repeated once per value.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerwell.operators.hotkeys import HOT_ROWS, HOT_SPREAD, SPREAD, hot_keys, with_spread

# The narrow lookup rows here take well under 100 bytes each.
BROADCAST_ROWS = 1_000_000


def is_small(lookup: DataFrame, rows: int, unreduced: DataFrame | None = None) -> bool:
    """At most ``rows`` rows. ``unreduced`` is what ``lookup`` was reduced from; counting it is enough
    when it is small itself, and often needs the file footers only."""
    return (unreduced is not None and unreduced.count() <= rows) or lookup.count() <= rows


def lookup_join(
    df: DataFrame,
    lookup: DataFrame,
    key: str,
    lookup_key: str,
    *,
    condition: Column | None = None,
    unreduced: DataFrame | None = None,
    keys_from: DataFrame | None = None,
    broadcast_rows: int = BROADCAST_ROWS,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Left-join ``lookup``; ``df`` carries ``_scatter`` (see ``with_scatter``).

    ``keys_from`` is a cheaper frame with the same keys as ``df``, used to find the crowded ones.
    """
    if is_small(lookup, broadcast_rows, unreduced):
        return df.join(F.broadcast(lookup), _matches(key, lookup_key, condition), "left")
    hot = hot_keys(df if keys_from is None else keys_from, key, hot_rows)
    return spread_join(with_spread(df, key, hot), lookup, key, lookup_key, hot, condition)


def spread_join(
    df: DataFrame,
    lookup: DataFrame,
    key: str,
    lookup_key: str,
    hot: Sequence,
    condition: Column | None = None,
) -> DataFrame:
    """Left-join by (key, _spread) and drop ``_spread``."""
    # Always 0, but not a constant the optimizer would take out of the join keys.
    place = F.pmod(F.xxhash64(lookup_key), F.lit(1)).cast("int")
    if hot:
        every_place = F.sequence(F.lit(0), F.lit(HOT_SPREAD - 1))
        place = F.explode(F.when(F.col(lookup_key).isin(*hot), every_place).otherwise(F.array(place)))
    placed = lookup.withColumn("_place", place)
    matches = _matches(key, lookup_key, condition) & (F.col(SPREAD) == F.col("_place"))
    return df.join(placed, matches, "left").drop("_place", SPREAD)


def _matches(key: str, lookup_key: str, condition: Column | None) -> Column:
    same = F.col(key) == F.col(lookup_key)
    return same if condition is None else same & condition
