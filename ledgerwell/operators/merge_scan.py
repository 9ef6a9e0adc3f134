"""As-of lookup as a merge of rows and rates along time, for rate series of any size and span.

Time is cut into parts of about equal numbers of rows and rates. Each part is read once in the order of
time, and a row takes the last rate seen before it; a part begins with the rate in force at its border,
which a prefix over the parts' last rates gives. Nothing is listed per calendar day, so a rate in a far
year costs one row. Rows are shuffled once, and neither rows nor rates are compared in pairs.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerwell.functions.money import BASE_CURRENCY
from ledgerwell.operators.asof import RATE_COLUMNS
from ledgerwell.operators.hotkeys import SCATTER, SCATTER_WIDTH

# Rows of a part that one task sorts and scans.
ROWS_PER_PART = 500_000
# So many places along time are measured; parts lie between some of them.
MEASURED = 2048

_PART, _SHARE, _AT, _IS_ROW, _RATE, _ROW, _SEEN = "_part", "_share", "_at", "_is_row", "_rate", "_row", "_seen"
_UNTIMED = -1


@dataclass(frozen=True)
class Cuts:
    """``borders`` between parts, and over how many tasks the rows of each part are dealt."""

    borders: tuple[float, ...]
    shares: tuple[int, ...]


def cuts_of(measured: list[int], rows: int, rows_per_part: int) -> Cuts:
    """Parts of about ``rows_per_part`` from evenly spaced quantiles. A time that many rows share
    cannot be cut; its part gets several shares instead."""
    each = rows / max(len(measured), 1)
    borders: list[float] = []
    held = [0.0]
    for place, value in enumerate(measured):
        fresh = place > 0 and value > measured[place - 1]
        if fresh and held[-1] >= rows_per_part:
            borders.append(float(value))
            held.append(0.0)
        held[-1] += each
    return Cuts(tuple(borders), tuple(max(1, -(-int(n) // rows_per_part)) for n in held))


def measure(times: DataFrame, rows_per_part: int = ROWS_PER_PART) -> Cuts:
    """``Cuts`` for the column ``_at`` of ``times`` in microseconds, by one pass over it alone. A fixed
    number of quantiles comes to the driver."""
    places = F.array(*[F.lit((i + 0.5) / MEASURED) for i in range(MEASURED)])
    seen = times.agg(F.count(_AT).alias("n"), F.approx_percentile(_AT, places, F.lit(10 * MEASURED)).alias("q")).first()
    return cuts_of(sorted(seen["q"] or []), seen["n"], rows_per_part)


def _with_part(df: DataFrame, cuts: Cuts) -> DataFrame:
    """Add ``_part``, the number of borders at or before ``_at``. Doubles may round a far time, but never
    across another, so parts stay in order."""
    if not cuts.borders:
        return df.withColumn(_PART, F.lit(0))
    splits = [float("-inf"), *cuts.borders, float("inf")]
    cut = Bucketizer(splits=splits, inputCol="_place", outputCol="_bucket", handleInvalid="keep")
    placed = cut.transform(df.withColumn("_place", F.col(_AT).cast("double")))
    return placed.withColumn(_PART, F.col("_bucket").cast("int")).drop("_place", "_bucket")


def _shares(cuts: Cuts) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in cuts.shares]), F.col(_PART) + 1)


def _rates_in_force(rates: DataFrame, cuts: Cuts) -> DataFrame:
    """All rates, and per part the one in force at its border; at most one row per part is ordered in one task."""
    last = rates.groupBy(_PART).agg(F.max_by(_RATE, _AT).alias(_RATE))
    parts = rates.sparkSession.range(len(cuts.shares)).select(F.col("id").cast("int").alias(_PART))
    before = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    carried = parts.join(last, _PART, "left").withColumn(_RATE, F.last(_RATE, ignorenulls=True).over(before))
    smallest = F.lit(-(1 << 63)).cast("bigint")
    return rates.select(_PART, _AT, _RATE).unionByName(carried.where(F.col(_RATE).isNotNull()).select(_PART, smallest.alias(_AT), _RATE))


def attach_rates_by_scan(df: DataFrame, intervals: DataFrame, *, rows_per_part: int = ROWS_PER_PART) -> DataFrame:
    """Left-join the covering interval as ``r_*`` columns, as ``asof.attach_rates`` does.

    ``df`` has ``_scatter`` (see ``hotkeys.with_scatter``). Intervals do not overlap; gaps between them give
    no rate. Rows in the base currency, without a currency or without a time get no interval and are dealt
    evenly. The rows of a crowded time are dealt over several tasks, each with all rates of that part.
    """
    at = F.unix_micros(F.when(F.col("currency") != BASE_CURRENCY, F.col("created_at")))
    rate = F.struct(*[F.col(name).alias(short) for name, short in RATE_COLUMNS.items()])
    rates = intervals.select(F.unix_micros("valid_from").alias(_AT), rate.alias(_RATE))
    rows = df.select(at.alias(_AT), SCATTER, F.struct(*df.columns).alias(_ROW))
    cuts = measure(rows.select(_AT).unionByName(rates.select(_AT)), rows_per_part)

    untimed = F.col(_AT).isNull()
    timed = _with_part(rows, cuts).withColumn(_PART, F.when(untimed, F.lit(_UNTIMED)).otherwise(F.col(_PART)))
    share = F.when(untimed, F.col(SCATTER) % SCATTER_WIDTH).otherwise(F.col(SCATTER) % _shares_or_one(cuts))
    dealt = timed.withColumn(_SHARE, share.cast("int")).withColumn(_IS_ROW, F.lit(True)).drop(SCATTER)
    known = _rates_in_force(_with_part(rates, cuts), cuts)
    repeated = known.withColumn(_SHARE, F.explode(F.sequence(F.lit(0), _shares(cuts) - 1))).withColumn(_IS_ROW, F.lit(False))

    along = Window.partitionBy(_PART, _SHARE).orderBy(_AT, _IS_ROW).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    merged = dealt.unionByName(repeated, allowMissingColumns=True).withColumn(_SEEN, F.last(_RATE, ignorenulls=True).over(along))
    over = F.col(f"{_SEEN}.r_to").isNotNull() & (F.col(_AT) >= F.unix_micros(f"{_SEEN}.r_to"))
    names = [short for short in RATE_COLUMNS.values() if short not in ("r_from", "r_to")]
    found = [F.when(~over, F.col(f"{_SEEN}.{name}")).alias(name) for name in names]
    return merged.where(F.col(_IS_ROW)).select(f"{_ROW}.*", *found)


def _shares_or_one(cuts: Cuts) -> Column:
    """Untimed rows lie outside the parts."""
    return F.when(F.col(_PART) < 0, F.lit(1)).otherwise(_shares(cuts))
