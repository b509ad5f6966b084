"""Spark session with the settings the engine is designed for."""

from __future__ import annotations

from pyspark.sql import SparkSession

DEFAULTS = {
    # Run-time re-planning: coalesces small shuffle partitions, splits skewed ones.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Fewer, larger scan tasks over inputs of many terabytes.
    "spark.sql.files.maxPartitionBytes": "256m",
    # Hour, weekday and year of a timestamp depend on the session zone.
    "spark.sql.session.timeZone": "UTC",
    # Shuffles of wide rows move a third less than with lz4.
    "spark.io.compression.codec": "zstd",
    # Plans name the whole path of what they read.
    "spark.sql.maxMetadataStringLength": "1000",
    "spark.ui.enabled": "false",
}


def build_session(app_name: str = "starnorm", **settings: str) -> SparkSession:
    """Get or create a session; keyword names use ``__`` for the dots of a setting."""
    builder = SparkSession.builder.appName(app_name)
    overrides = {name.replace("__", "."): value for name, value in settings.items()}
    for name, value in {**DEFAULTS, **overrides}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()
