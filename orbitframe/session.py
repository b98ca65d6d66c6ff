"""Session settings."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: What results depend on (time zone) or large inputs need (adaptive plans, sized partitions).
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.python.filterPushdown.enabled": "true",
}


def session(app: str = "orbitframe", master: str | None = None, **more: str) -> SparkSession:
    """A session with SETTINGS; on a cluster the master comes from spark-submit."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in (SETTINGS | more).items():
        builder = builder.config(k, v)
    return builder.getOrCreate()
