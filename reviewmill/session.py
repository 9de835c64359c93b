"""A session with the settings the jobs expect."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build(app: str = "reviewmill", **conf: str) -> SparkSession:
    """Adaptive execution with skew-join splitting, UTC times; ``conf`` wins."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **conf,
    }
    builder = SparkSession.builder.appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
