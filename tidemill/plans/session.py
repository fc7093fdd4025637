"""The session that the engine expects."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(name: str = "tidemill", master: str | None = None, **config: str) -> SparkSession:
    """Adaptive execution on, UTC, dynamic partition overwrite; the rest is the
    cluster's."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    for k, v in (defaults | config).items():
        builder = builder.config(k, v)
    return builder.getOrCreate()
