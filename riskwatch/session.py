"""Session settings the jobs are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # Dates are cut from timestamps, so the time zone is part of the result.
    "spark.sql.session.timeZone": "UTC",
    # Strict casts have to raise.
    "spark.sql.ansi.enabled": "true",
    # AQE coalesces small shuffle partitions, turns joins with a small measured
    # side into broadcasts and splits skewed join partitions.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Column calls need no call-site capture, which costs a round trip each.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(app_name: str = "riskwatch", master: str | None = None, **extra: str) -> SparkSession:
    """A session with ``SETTINGS``; ``extra`` uses ``__`` for dots in keys.

    Shuffle width is left to the cluster's configuration: set
    ``spark.sql.shuffle.partitions`` high (AQE merges what is too small).
    """
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()
