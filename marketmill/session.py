"""Sessions and the settings the plans count on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings that matter for the plans at any size. Zone-less timestamps need no zone, but a
# fixed session zone keeps casts from text the same everywhere.
PLAN_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

TARGET_PARTITION_BYTES = 128 * 1024 * 1024


def shuffle_partitions(shuffled_bytes: int, cores: int) -> int:
    """Partitions of about 128 MB each, at least one per core; AQE merges the small ones."""
    return max(cores, -(-shuffled_bytes // TARGET_PARTITION_BYTES))


def local_session(cores: int | str = 8, app: str = "marketmill") -> SparkSession:
    """A session for tests and measurements on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(cores))
    )
    for key, value in PLAN_SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
