"""Session settings the engine relies on."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# All of these are runtime SQL settings, so they also apply to a session the caller already has.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # The JVM does not compile methods above this size; wide projections must be generated in parts.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # The flags of a record are dozens of predicates over the same few columns; inferring more
    # predicates from them takes the optimizer minutes and finds none: NULL keys are filtered here
    # by hand, and filters are pushed down without it.
    "spark.sql.constraintPropagation.enabled": "false",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings the results depend on; sizes and memory stay with the cluster."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def object_store_settings(endpoint: str, access_key: str, secret_key: str, *, tls: bool = False) -> dict[str, str]:
    """Settings for an S3-compatible store; pass them to the session builder."""
    return {
        "spark.hadoop.fs.s3a.endpoint": endpoint,
        "spark.hadoop.fs.s3a.access.key": access_key,
        "spark.hadoop.fs.s3a.secret.key": secret_key,
        "spark.hadoop.fs.s3a.path.style.access": "true",
        "spark.hadoop.fs.s3a.connection.ssl.enabled": str(tls).lower(),
    }


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, named by the cluster in ``spark.checkpoint.dir``."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    return named


def use_local_folder(spark: SparkSession) -> SparkSession:
    """For tests and trials: name a temporary folder where ``spark.checkpoint.dir`` is unset and
    driver and executors are one process. The library's jobs never call this."""
    if not spark.conf.get("spark.checkpoint.dir", None) and spark.sparkContext.master.split("[")[0] == "local":
        spark.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="ledgerwell-"))
    return spark
