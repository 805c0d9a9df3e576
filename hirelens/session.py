"""Session settings that the package relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def session(master: str | None = None, **more: str) -> SparkSession:
    """A session with the package's settings; the master and any more settings are the caller's."""
    builder = SparkSession.builder.appName("hirelens")
    if master:
        builder = builder.master(master)
    return builder.config(map=SETTINGS | more).getOrCreate()
