"""Scans of line-JSON files: malformed lines become rows of NULLs, nothing is dropped."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ledgerwell.schemas import RAW_CANCELLATIONS, RAW_DICTIONARIES, RAW_RATES, RAW_TRANSACTIONS

# Where a file of each kind lies below the landing root.
TRANSACTIONS_FILE = "transactions/day={day}/slot={slot}/transactions.jsonl"
RATES_FILE = "exchange_rates/day={day}/rates.jsonl"
CANCELLATIONS_FILE = "cancellations/day={day}/cancellations.jsonl"
# The name of the one file in a slot's folder.
SLOT_FILE = "transactions.jsonl"
DICTIONARY_FILE = "dictionaries/{name}.jsonl"


# Holds the text of a line that is no JSON object, and NULL for all others.
MALFORMED = "malformed_line"


def with_malformed(schema: StructType) -> StructType:
    """``schema`` and the column for malformed lines; the reader needs ``columnNameOfCorruptRecord`` for it."""
    return StructType([*schema.fields, StructField(MALFORMED, StringType())])


def transactions_path(root: str, day: str, slot: str) -> str:
    return f"{root}/{TRANSACTIONS_FILE.format(day=day, slot=slot)}"


def rates_path(root: str, day: str) -> str:
    return f"{root}/{RATES_FILE.format(day=day)}"


def cancellations_path(root: str, day: str) -> str:
    return f"{root}/{CANCELLATIONS_FILE.format(day=day)}"


def dictionary_path(root: str, name: str) -> str:
    return f"{root}/{DICTIONARY_FILE.format(name=name)}"


def read_lines(spark: SparkSession, schema: StructType, paths: str | Sequence[str], *, keep_malformed: bool = False) -> DataFrame:
    """Declared columns plus ``source_file``, taken from the file each row came from, and with
    ``keep_malformed`` the text of malformed lines."""
    schema = with_malformed(schema) if keep_malformed else schema
    reader = spark.read.schema(schema).option("columnNameOfCorruptRecord", MALFORMED)
    rows = reader.json(paths if isinstance(paths, str) else list(paths))
    return rows.select(*schema.names, F.col("_metadata.file_path").alias("source_file"))


def read_transactions(spark: SparkSession, paths: str | Sequence[str], **options: bool) -> DataFrame:
    return read_lines(spark, RAW_TRANSACTIONS, paths, **options)


def read_rates(spark: SparkSession, paths: str | Sequence[str], **options: bool) -> DataFrame:
    return read_lines(spark, RAW_RATES, paths, **options)


def read_cancellations(spark: SparkSession, paths: str | Sequence[str], **options: bool) -> DataFrame:
    return read_lines(spark, RAW_CANCELLATIONS, paths, **options)


def with_slot(lines: DataFrame, fields: Sequence[str], bucket: str) -> DataFrame:
    """``fields`` of scanned transaction files with their origin; day and slot are taken from the folders."""
    found = lines.select(*fields, F.col("_metadata.file_path").alias("source_file"))
    return with_origin(
        found,
        bucket=bucket,
        object_path=F.regexp_extract("source_file", "transactions/day=.*$", 0),
        file_date=F.regexp_extract("source_file", "/day=([^/]+)/", 1),
        slot=F.regexp_extract("source_file", "/slot=([^/]+)/", 1),
    )


def read_dictionary(spark: SparkSession, name: str, path: str) -> DataFrame:
    return read_lines(spark, RAW_DICTIONARIES[name], path)


def read_inferred(spark: SparkSession, path: str) -> DataFrame:
    """Schema taken from the data; ``source_file`` is the path that was asked for."""
    return spark.read.json(path).withColumn("source_file", F.lit(path))


def with_origin(
    df: DataFrame,
    *,
    bucket: str | Column,
    object_path: str | Column,
    file_date: str | Column,
    slot: str | Column | None = None,
) -> DataFrame:
    """Lineage of a load: where the rows came from and when they were read."""

    def column(value: str | Column) -> Column:
        return value if isinstance(value, Column) else F.lit(value)

    origin = {
        "raw_bucket": column(bucket),
        "raw_object_path": column(object_path),
        "file_date": column(file_date).cast("date"),
        "loaded_at": F.current_timestamp(),
    }
    if slot is not None:
        origin["slot"] = column(slot).cast("string")
    return df.withColumns(origin)
