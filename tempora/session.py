"""The Spark session that every entry point shares."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # a window by team and a join by (team, sequence) can share one shuffle
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    # wide plans are built of thousands of columns; none needs its place in the source noted
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def session(app: str = "tempora", master: str | None = None, **more: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in {**SETTINGS, **more}.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()
