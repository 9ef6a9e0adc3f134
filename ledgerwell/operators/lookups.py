"""Users, test users and promo codes of a transaction: left joins to one row per key, so rows never
multiply. ``keys_from`` and crowded keys: see ``joins.lookup_join``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerwell.operators.dictionaries import one_row_per_key
from ledgerwell.operators.joins import lookup_join


def attach_users(df: DataFrame, users: DataFrame, **sizes) -> DataFrame:
    newest = one_row_per_key(users.select("user_id", "is_test_user", "loaded_at"), "user_id", "loaded_at")
    known = newest.select(F.col("user_id").alias("u_id"), F.col("is_test_user").alias("u_is_test"))
    return lookup_join(df, known, "user_id", "u_id", unreduced=users, **sizes)


def attach_test_users(df: DataFrame, test_users: DataFrame, **sizes) -> DataFrame:
    listed = test_users.select(F.col("test_user_uuid").alias("tu_uuid")).distinct()
    return lookup_join(df, listed, "user_uuid", "tu_uuid", unreduced=test_users, **sizes)


def attach_promo_codes(df: DataFrame, promo_codes: DataFrame, **sizes) -> DataFrame:
    newest = one_row_per_key(
        promo_codes.select("promo_code_id", "code", "max_uses", "expiry_date", "loaded_at"),
        "promo_code_id",
        "loaded_at",
    )
    known = newest.select(
        F.col("promo_code_id").alias("p_id"),
        F.col("code").alias("p_code"),
        F.col("max_uses").alias("p_max_uses"),
        F.col("expiry_date").alias("p_expiry_date"),
    )
    return lookup_join(df, known, "promo_code_id", "p_id", unreduced=promo_codes, **sizes)
