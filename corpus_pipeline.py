"""The training-data pipeline: each stage is written as Parquet and read again by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerwell.llm import jaccard, mixing, packing, pii, toxicity
from ledgerwell.llm.queries import TOKENIZER, toxic_model
from ledgerwell.llm.shared import documents, free_name, prepared, stage

REJECTED_FROM = 0.7


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the toxicity score that rejects; the model learns from the labels of ``sf_dir``."""
    name = free_name("_score", docs.columns)
    scored = toxicity.score(docs, toxic_model(prepared(spark), sf_dir), keep=docs.columns, name=name)
    return scored.where(F.col(name) < REJECTED_FROM).select(docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One text of each group linked by five-word shingles at a similarity of 0.8 or more."""
    prepared(spark)
    return jaccard.without_near_copies(docs, width=5, parts=4, whole=5)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind; the stated length follows the new text."""
    redacted = pii.redact(docs)
    if "n_chars" not in docs.columns:
        return redacted
    return redacted.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), "n_chars"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the target weights of their sources ask."""
    return mixing.mixed_rows(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents and their places in sequences."""
    prepared(spark)
    return packing.pack_documents(docs, TOKENIZER)


STAGES = [
    ("toxicity", drop_toxic),
    ("n-gram Jaccard join", drop_near_copies),
    ("PII", redact_personal_data),
    ("mixing to target weights", mix),
    ("best-fit packing", pack),
]

# Learned models, tokens and set names are beyond SQL. Tests check columns, counts, ids and capacity of the
# stages, and the operators on small tables; no test compares a whole stage to brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(prepared(spark), sf_dir)
    for nth, (_, work) in enumerate(STAGES):
        docs = work(spark, docs, sf_dir)
        if nth < len(STAGES) - 1:
            docs = stage(docs, f"stage{nth}")
    return docs
