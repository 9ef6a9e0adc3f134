"""Dictionaries: typing on load, and one row per key for lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Fixed value: the text form of a promo code's last day.
EXPIRY_FORMAT = "yyyy-MM-dd"


def typed_dictionary(name: str, raw: DataFrame) -> DataFrame:
    stamped = raw.withColumn("loaded_at", F.current_timestamp())
    if name == "promo_codes":
        return stamped.withColumn("expiry_date", F.try_to_date("expiry_date", EXPIRY_FORMAT))
    return stamped


def one_row_per_key(df: DataFrame, key: str, *newest_first: str) -> DataFrame:
    """The newest row of each non-NULL key.

    All other columns break ties, so the choice does not depend on the order of arrival. Spark
    keeps one row per key on each side of the shuffle (WindowGroupLimit), so a frequent key
    costs one row per task.
    """
    rest = sorted(set(df.columns) - {key, *newest_first})
    order = [F.col(name).desc_nulls_last() for name in (*newest_first, *rest)] or [F.lit(1)]
    ranked = df.where(F.col(key).isNotNull()).withColumn(
        "_row", F.row_number().over(Window.partitionBy(key).orderBy(*order))
    )
    return ranked.where(F.col("_row") == 1).drop("_row")
