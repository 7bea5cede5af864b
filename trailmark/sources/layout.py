"""Rows in ranges of their layout columns, computed once.

Spark's range partitioning samples its input for bounds, which computes it a second time. Here the
rows are written aside once, as they come. The bounds are quantiles of a sample of the layout
columns only, so many rows for each range, chosen one by one with the same chance: so it costs a narrow scan,
and a task hands on its share of the sample alone. They enter the plan as a scalar subquery; a binary search finds each row's range.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trailmark.sources.folders import delete_folder, folder_bytes
from trailmark.sources.scratch import scratch_folder

#: Sampled rows for each range.
SAMPLED = 100
#: Bytes of shuffled rows for each byte of their files, for rows whose values repeat.
SHUFFLED = 4
#: Columns added for a while.
SPREAD, BOUNDS, RANGE = "_spread", "_bounds", "_range"


def range_count(spark: SparkSession, size: int) -> int:
    """Ranges for files of so many bytes: each of the advised size when shuffled, however many that makes; if adaptive execution
    does not merge partitions, at least what a shuffle starts with.
    """
    conf = spark.conf
    advised = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes"))
    ranges = max(1, ceil(SHUFFLED * size / advised))
    if conf.get("spark.sql.adaptive.enabled") == "true" and conf.get("spark.sql.adaptive.coalescePartitions.enabled") == "true":
        return ranges
    least = conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None) or conf.get("spark.sql.shuffle.partitions")
    return max(ranges, int(least))


def sampled(rows: DataFrame, key: Column, ranges: int, count: int) -> DataFrame:
    """(key) of about SAMPLED rows for each range, of so many rows: each row with the same chance, so that a task
    hands on its share only, however many tasks there are.
    """
    chance = min(1.0, SAMPLED * ranges / max(1, count))
    return rows.where(F.rand(seed=7) < chance).select(key.alias("key"))


def quantile_bounds(rows: DataFrame, key: Column, ranges: int, count: int) -> Column:
    """The keys that part the rows in so many ranges of about equal size, as one rising array."""
    met = sampled(rows, key, ranges, count).agg(F.sort_array(F.collect_list("key")).alias("met"))
    place = lambda i: F.floor(i * F.size("met") / ranges).cast("int")
    return met.select(F.transform(F.sequence(F.lit(1), F.lit(ranges - 1)), lambda i: F.get("met", place(i)))).scalar()


def range_of(bounds: Column, key: Column, ranges: int) -> Column:
    """How many bounds are at most the key."""

    def halved(found: Column, _: Column) -> Column:
        middle = F.shiftright(found["low"] + found["high"], 1)
        above = F.struct((middle + 1).alias("low"), found["high"].alias("high"))
        below = F.struct(found["low"].alias("low"), middle.alias("high"))
        narrowed = F.when(F.get(bounds, middle) <= key, above).otherwise(below)
        return F.when(found["low"] < found["high"], narrowed).otherwise(found)

    start = F.struct(F.lit(0).alias("low"), F.lit(ranges - 1).alias("high"))
    steps = F.sequence(F.lit(1), F.lit((ranges - 1).bit_length()))
    return F.aggregate(steps, start, halved, lambda found: found["low"])


@contextmanager
def in_ranges(rows: DataFrame, layout: Sequence[str]) -> Iterator[DataFrame]:
    """The rows, each range of the layout columns sorted in a partition of its own. While the context is
    open they are kept in the scratch folder.

    The row's hash comes last in the order of ranges, so that one value held by many rows still
    spreads over several.
    """
    spark = rows.sparkSession
    aside = scratch_folder(spark, "unsorted")
    spread = rows.withColumn(SPREAD, F.xxhash64(*rows.columns))
    try:
        spread.write.parquet(aside)
        written = spark.read.schema(spread.schema).parquet(aside)
        ranges = range_count(spark, folder_bytes(spark, aside))
        if ranges == 1:
            parted = written.coalesce(1)
        else:
            key = F.struct(*layout, SPREAD)
            bounded = written.withColumn(BOUNDS, quantile_bounds(written, key, ranges, written.count()))
            parted = bounded.withColumn(RANGE, range_of(F.col(BOUNDS), key, ranges)).repartitionById(ranges, RANGE)
        yield parted.select(*rows.columns).sortWithinPartitions(*layout)
    finally:
        delete_folder(spark, aside)
