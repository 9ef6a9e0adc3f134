"""As-of lookup of the rate interval that covers each row's time.

A join on ``valid_from <= t < valid_to`` alone compares every row with every interval. Here each
interval is listed under the days it covers, and days with many intervals are cut into equal
slices, so that a row finds its few candidates by an equi-join on (day, slice); the range test
remains as the residual condition. The list stays linear in the number of intervals and days.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerwell.functions.money import BASE_CURRENCY
from ledgerwell.operators.joins import lookup_join

DAY_MICROS = 86_400_000_000
RATES_PER_SLICE = 4
# More than the slices of a day with one rate every second.
MAX_SLICES = 1 << 20

RATE_COLUMNS = {
    "rate_interval_id": "r_interval_id",
    "valid_from": "r_from",
    "valid_to": "r_to",
    "rate_timestamp": "r_timestamp",
    "rate_date": "r_date",
    "rate_tgrk_punk": "r_punk",
    "rate_tgrk_rub": "r_rub",
    "rate_selection_strategy": "r_strategy",
}


def _slice_of(micros: Column, slices: Column) -> Column:
    return F.floor(F.pmod(micros, F.lit(DAY_MICROS)) * slices / F.lit(DAY_MICROS)).cast("int")


def _day_of(micros: Column) -> Column:
    return F.floor(micros / F.lit(DAY_MICROS)).cast("int")


def sliced_intervals(intervals: DataFrame) -> DataFrame:
    """One row per interval, day and slice, with ``r_day``, ``r_slice`` and ``r_slices``.

    The first and the last interval are unbounded in effect, so the list ends one day before the
    first rate and one day after the last; rows outside are looked up under those two days.
    """
    first_day, last_day = _edge_days(intervals)
    from_micros = F.unix_micros("r_from")
    last_micros = F.unix_micros("r_to") - 1
    per_day = (
        intervals.select(*[F.col(name).alias(short) for name, short in RATE_COLUMNS.items()])
        .withColumn(
            "r_day",
            F.explode(
                F.sequence(
                    F.greatest(_day_of(from_micros), first_day),
                    F.coalesce(_day_of(last_micros), last_day),
                )
            ),
        )
        .withColumn(
            "r_slices",
            F.ceil(F.count(F.lit(1)).over(Window.partitionBy("r_day")) / RATES_PER_SLICE).cast("int"),
        )
    )
    first_slice = F.when(_day_of(from_micros) == F.col("r_day"), _slice_of(from_micros, F.col("r_slices"))).otherwise(0)
    last_slice = F.when(_day_of(last_micros) == F.col("r_day"), _slice_of(last_micros, F.col("r_slices"))).otherwise(
        F.col("r_slices") - 1
    )
    return per_day.withColumn("r_slice", F.explode(F.sequence(first_slice, last_slice)))


def _edge_days(intervals: DataFrame) -> tuple[Column, Column]:
    """The days just outside the rates, as a scalar subquery: nothing comes to the driver."""
    day = _day_of(F.unix_micros("rate_timestamp"))
    edges = intervals.agg(F.struct((F.min(day) - 1).alias("first"), (F.max(day) + 1).alias("last"))).scalar()
    return edges.getField("first"), edges.getField("last")


def attach_rates(
    df: DataFrame, intervals: DataFrame, *, keys_from: DataFrame | None = None, **sizes
) -> DataFrame:
    """Left-join the covering interval as ``r_*`` columns; at most one per row.

    Rows in the base currency, without a currency or without a time get no interval. The interval
    list is broadcast while it is small; beyond that see ``joins.lookup_join``, which also explains
    ``keys_from``.
    """
    listed = sliced_intervals(intervals).withColumn("r_key", _key(F.col("r_day"), F.col("r_slice")))
    keyed = _with_key(df, intervals, listed)
    covers = (F.col("created_at") >= F.col("r_from")) & (
        F.col("r_to").isNull() | (F.col("created_at") < F.col("r_to"))
    )
    return lookup_join(
        keyed,
        listed.drop("r_day", "r_slice", "r_slices"),
        "_key",
        "r_key",
        condition=covers,
        keys_from=None if keys_from is None else _with_key(keys_from, intervals, listed),
        **sizes,
    ).drop("_key", "r_key", "r_from", "r_to")


def _with_key(df: DataFrame, intervals: DataFrame, listed: DataFrame) -> DataFrame:
    """Add ``_key``, the (day, slice) a row is looked up under; NULL when it cannot match."""
    first_day, last_day = _edge_days(intervals)
    at = F.unix_micros(F.when(F.col("currency") != BASE_CURRENCY, F.col("created_at")))
    # At most one row per calendar day.
    crowded_days = F.broadcast(
        listed.where(F.col("r_slices") > 1)
        .select(F.col("r_day").alias("_day"), F.col("r_slices").alias("_slices"))
        .distinct()
    )
    timed = df.withColumn("_at", at).withColumn(
        "_day", F.when(F.col("_at").isNotNull(), F.least(F.greatest(_day_of(F.col("_at")), first_day), last_day))
    )
    slices = F.coalesce(F.col("_slices"), F.lit(1))
    return (
        timed.join(crowded_days, "_day", "left")
        .withColumn("_key", _key(F.col("_day"), _slice_of(F.col("_at"), slices)))
        .drop("_at", "_day", "_slices")
    )


def _key(day: Column, slice_number: Column) -> Column:
    return day.cast("bigint") * MAX_SLICES + slice_number
