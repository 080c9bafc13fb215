"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Split a skewed join partition even where a grouping follows on the same key.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def get_session(app: str = "brisa", master: str | None = None, **extra: str) -> SparkSession:
    """Build (or reuse) a session with the settings the operators expect."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def tune(spark: SparkSession) -> SparkSession:
    """Apply the settings to a session somebody else made; its own choices stay."""
    for key, value in SETTINGS.items():
        if key.startswith("spark.sql.adaptive.") and spark.conf.get(key, None) != value:
            if not spark.sparkContext.getConf().contains(key):
                spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder that the driver and every executor can reach.

    ``spark.checkpoint.dir`` names it; a session without that setting has the
    warehouse, which is as shared. No temporary folder of one machine ever serves.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
    return configured.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for one run below the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """A table written once below the shared folder and read from there, for plans that
    need several passes: the source is read once, and a lost executor costs no more."""
    path = scratch_path(df.sparkSession, name)
    writer = df.write if by is None else df.write.partitionBy(by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
