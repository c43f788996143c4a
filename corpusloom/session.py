"""Spark sessions with the settings the operators expect."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(name: str = "corpusloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session in UTC with adaptive execution; a cluster's own settings win where it has them."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.parquet.aggregatePushdown": "true",
    }
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
