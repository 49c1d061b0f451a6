"""Session settings for local runs; a cluster brings its own session."""

import os

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", memory: str = "8g", partitions: int = 8) -> SparkSession:
    """A session on this machine with the settings the engine is written for."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tidemark")
        .config("spark.driver.memory", os.environ.get("TIDEMARK_DRIVER_MEMORY", memory))
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def set_default(spark: SparkSession, key: str, value: str) -> None:
    """Set a setting unless the session already has one."""
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, value)
