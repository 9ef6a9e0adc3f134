"""The provided tables in the roles of this engine's inputs.

Events play transactions (all of them) and rate updates (the signups), line items play
cancellations, orders a user dictionary with several snapshots per user, suppliers the test users
and parts the promo codes. The texts are made dirty by the row number. The same templates make the
input on both sides of a check; everything after that is written twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LOADED_AT = "2024-03-01 00:00:00"

SPARK = {
    "secs": "unix_seconds(CAST(ts AS TIMESTAMP))",
    "div": "div",
    "promo": "get_json_object(props, '$.k')",
    "slot": "date_format(timestamp_seconds({secs} div 600 * 600), 'HH-mm')",
    "ship": "date_format(l_shipdate, 'yyyy MMM dd')",
}
SPARK["slot"] = SPARK["slot"].format(**SPARK)
DUCK = {
    "secs": "(epoch_us(ts) // 1000000)",
    "div": "//",
    "promo": "(props->>'$.k')",
    "slot": "strftime(time_bucket(INTERVAL '10 minutes', ts), '%H-%M')",
    "ship": "strftime(l_shipdate, '%Y %b %d')",
}

_CENTS = "CAST(FLOOR(value * 100 + 0.5) AS BIGINT)"


def _decimal_text(cents: str, mark: str) -> str:
    whole = f"CAST({cents} {{div}} 100 AS STRING)"
    return f"{whole} || '{mark}' || lpad(CAST({cents} % 100 AS STRING), 2, '0')"


TRANSACTION_TEXTS = {
    "transaction_id": """CASE WHEN event_id % 101 = 1 THEN 'none' WHEN event_id % 101 = 2 THEN ''
        WHEN event_id % 101 = 3 THEN 'x' || CAST(event_id AS STRING)
        WHEN event_id % 10 = 9 THEN ' ' || CAST(event_id - 1 AS STRING) || ' '
        ELSE CAST(event_id AS STRING) END""",
    "user_id": """CASE WHEN event_id % 13 = 0 THEN NULL WHEN event_id % 13 = 1 THEN '12.5'
        WHEN event_id % 13 = 2 THEN ' NaN ' ELSE CAST(user_id * 20 AS STRING) END""",
    "user_uuid": """CASE WHEN event_id % 17 = 0 THEN ' None ' ELSE ' u-' || CAST(user_id * 3 AS STRING) END""",
    "amount": f"""CASE WHEN event_id % 19 = 0 THEN '-' || {_decimal_text(_CENTS, ',')}
        WHEN event_id % 19 = 1 THEN '0.004' WHEN event_id % 19 = 2 THEN 'abc'
        WHEN event_id % 19 = 3 THEN '1,234.50' WHEN event_id % 19 = 4 THEN 'null'
        WHEN event_id % 19 = 5 THEN '99999999999999999'
        ELSE {_decimal_text(_CENTS, '.')} END""",
    "currency": """CASE WHEN event_id % 23 = 0 THEN NULL WHEN event_id % 4 = 0 THEN 'TGRK'
        WHEN event_id % 4 = 1 THEN ' rub ' WHEN event_id % 4 = 2 THEN 'Punk'
        WHEN event_id % 8 = 3 THEN 'USD' ELSE 'RUB' END""",
    "transaction_type": """CASE event_type WHEN 'purchase' THEN ' Purchase' WHEN 'view' THEN 'transfer'
        WHEN 'click' THEN 'REFUND' WHEN 'signup' THEN 'gift' ELSE 'null' END""",
    "promo_code_id": """CASE WHEN event_id % 3 = 0 THEN NULL WHEN event_id % 29 = 0 THEN 'promo'
        ELSE CAST(CAST({promo} AS BIGINT) * 50 AS STRING) END""",
    "status": """CASE WHEN event_id % 5 = 0 THEN 'Failed' WHEN event_id % 5 = 1 THEN ' pending'
        WHEN event_id % 35 = 2 THEN '' ELSE 'completed' END""",
    "created_at": """CASE WHEN event_id % 31 = 0 THEN 'bad' WHEN event_id % 31 = 1 THEN NULL
        WHEN event_id % 31 = 2 THEN CAST({secs} * 1000 AS STRING) ELSE CAST({secs} AS STRING) END""",
}

RATE_TEXTS = {
    "update_id": "CASE WHEN event_id % 41 = 0 THEN 'none' ELSE CAST(event_id AS STRING) END",
    "timestamp": "CASE WHEN event_id % 43 = 0 THEN 'soon' ELSE CAST({secs} AS STRING) END",
    "rate_tgrk_punk": f"""CASE WHEN event_id % 37 = 0 THEN '0' WHEN event_id % 37 = 1 THEN 'abc'
        ELSE {_decimal_text(f'({_CENTS} + 50)', '.')} END""",
    "rate_tgrk_rub": f"""CASE WHEN event_id % 47 = 0 THEN '-1' WHEN event_id % 47 = 1 THEN NULL
        ELSE {_decimal_text(f'({_CENTS} * 7 + 1000)', '.')} END""",
}

_REFUND_CENTS = "CAST(FLOOR(l_extendedprice * 100 + 0.5) AS BIGINT)"
CANCELLATION_TEXTS = {
    "cancellation_id": """CASE WHEN l_partkey % 53 = 0 THEN 'null' WHEN l_partkey % 53 = 1 THEN 'c1'
        ELSE CAST(l_orderkey * 10 + l_linenumber AS STRING) END""",
    "original_transaction_id": """CASE WHEN l_suppkey % 59 = 0 THEN NULL
        WHEN l_suppkey % 59 = 1 THEN '#' ELSE CAST(l_orderkey AS STRING) END""",
    "reason": "CASE l_returnflag WHEN 'R' THEN ' Fraud' WHEN 'A' THEN 'none' ELSE 'Late' END",
    "cancelled_at": """CASE WHEN l_linenumber = 7 THEN 'none' WHEN l_linenumber = 6 THEN ''
        ELSE {ship} || ' 0' || CAST(l_linenumber AS STRING) || ':30' END""",
    "refund_amount": f"""CASE WHEN l_partkey % 61 = 0 THEN '-' || {_decimal_text(_REFUND_CENTS, ',')}
        WHEN l_partkey % 61 = 1 THEN 'x' WHEN l_partkey % 61 = 2 THEN NULL
        ELSE {_decimal_text(_REFUND_CENTS, ',')} END""",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _texts(columns: dict[str, str]) -> list[str]:
    return [f"{sql.format(**SPARK)} AS {name}" for name, sql in columns.items()]


def _loaded(df: DataFrame, source: str) -> DataFrame:
    """Lineage, and a running line number that is used but not kept: it stops the optimizer from
    unfolding the long text expressions into every flag, which it cannot do with a file scan."""
    numbered = df.withColumn("_line", F.monotonically_increasing_id()).where("_line >= 0").drop("_line")
    return numbered.withColumns(
        {
            "source_file": F.lit(source),
            "raw_bucket": F.lit("raw"),
            "raw_object_path": F.lit(source),
            "loaded_at": F.lit(LOADED_AT).cast("timestamp"),
        }
    )


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as the texts of a transaction, with its file day and slot."""
    rows = table(spark, sf_dir, "events").selectExpr(
        *_texts(TRANSACTION_TEXTS), "CAST(ts AS DATE) AS file_date", f"{SPARK['slot']} AS slot"
    )
    return _loaded(rows, "events")


def rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every signup as the texts of a rate update."""
    signups = table(spark, sf_dir, "events").where("event_type = 'signup'")
    return _loaded(signups.selectExpr(*_texts(RATE_TEXTS), "CAST(ts AS DATE) AS file_date"), "signups")


def cancellations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line item as the texts of a cancellation."""
    rows = table(spark, sf_dir, "lineitem").selectExpr(
        *_texts(CANCELLATION_TEXTS), "CAST(l_shipdate AS DATE) AS file_date"
    )
    return _loaded(rows, "lineitem")


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order as a snapshot of its customer; the newest snapshot counts."""
    return table(spark, sf_dir, "orders").selectExpr(
        "o_custkey AS user_id",
        "'u-' || CAST(o_custkey AS STRING) AS user_uuid",
        "CASE o_orderstatus WHEN 'P' THEN true WHEN 'F' THEN false END AS is_test_user",
        "CAST(o_orderdate AS TIMESTAMP) AS loaded_at",
    )


def test_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").selectExpr("'u-' || CAST(s_suppkey * 6 AS STRING) AS test_user_uuid")


def promo_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr(
        "p_partkey AS promo_code_id",
        "p_brand AS code",
        "CAST(p_size AS BIGINT) AS max_uses",
        "CASE WHEN p_size % 5 > 0 THEN date_add(DATE'2023-12-20', p_size) END AS expiry_date",
        f"TIMESTAMP'{LOADED_AT}' AS loaded_at",
    )
