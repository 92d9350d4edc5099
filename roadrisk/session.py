"""Session settings the jobs rely on.  Only SQL settings: sizing belongs to the cluster."""

from __future__ import annotations

from pyspark.sql import SparkSession

SQL_SETTINGS = {
    # The JVM does not compile methods above 8000 bytes; wide projections are then faster split up.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


# Settings of the Python side that only a new session takes.
START_SETTINGS = {
    # Recording the call site of every column expression makes building wide plans slow.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the SQL settings to a running session."""
    for name, value in SQL_SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def session(app: str = "roadrisk", master: str | None = None, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**SQL_SETTINGS, **START_SETTINGS, **settings}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()
