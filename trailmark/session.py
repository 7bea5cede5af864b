"""Spark settings the library expects."""

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.caseSensitive": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Recording the call site of every column expression makes plans slow to build.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def with_settings(builder: SparkSession.Builder, shuffle_partitions: int | None = None) -> SparkSession.Builder:
    """The settings, and how many partitions a shuffle starts with.

    Adaptive execution merges small shuffle partitions but does not split those of aggregates
    and range writes, so start with the largest shuffle's size over 200 MB, and at least the
    number of cores.
    """
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.adaptive.coalescePartitions.initialPartitionNum", shuffle_partitions)
    return builder
