"""What several operators share: tables, stored steps, bounded samples, learner's split."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import DataType
from pyspark.sql.window import Window

from trailmark.sources.folders import delete_folder
from trailmark.sources.scratch import scratch_folder

#: Maps A-Z to a-z and leaves every other byte, so that offsets stay.
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
#: The white space that separates words, for SQL patterns.
SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(frame: DataFrame, name: str) -> str:
    """The name, lengthened until the frame has no column of it."""
    taken = {c.lower() for c in frame.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


#: While a step is written: its shuffle files are of no use afterwards, and batches that go to Python
#: are small, since they stand beside the sorts of joins in an executor's memory.
STEP_SETTINGS = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
}


@contextmanager
def step_settings(spark: SparkSession) -> Iterator[None]:
    before = {key: spark.conf.get(key) for key in STEP_SETTINGS}
    for key, value in STEP_SETTINGS.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def stored(frame: DataFrame, purpose: str) -> DataFrame:
    """Written to the shared folder and read again: cuts lineage, survives lost executors."""
    spark = frame.sparkSession
    path = scratch_folder(spark, purpose)
    with step_settings(spark):
        frame.write.parquet(path)
    written = spark.read.schema(frame.schema).parquet(path)
    written.stored_at = path
    return written


def discard(*steps: DataFrame) -> None:
    """Deletes stored steps. Only for those that nothing but stored steps was made from."""
    for step in steps:
        delete_folder(step.sparkSession, step.stored_at)


def shared(spark: SparkSession, thing: object) -> Callable[[], object]:
    """Broadcasts the thing. The function returned gives it inside tasks, the same one to all tasks of
    a worker, so that what it builds or remembers there is kept. Only for things of bounded size.
    """
    held = spark.sparkContext.broadcast({"packed": cloudpickle.dumps(thing)})

    def get() -> object:
        here = held.value
        if "thing" not in here:
            here["thing"] = cloudpickle.loads(here["packed"])
        return here["thing"]

    return get


def text_function(returns: DataType, make: Callable[[], Callable[[pa.Array], pa.Array]]):
    """A column function on texts. make runs once in each task and gives the function of a batch."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        work = make()
        for batch in batches:
            yield work(batch)

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return arrow_udf(run, returns)


def utf8(texts: pa.Array) -> list[bytes]:
    """The texts' UTF-8 bytes; null is empty."""
    return [x or b"" for x in texts.cast(pa.binary()).to_pylist()]


def held_out(doc_id: Column | str) -> Column:
    """True for the quarter of the documents from which nothing may be learned; false without an id."""
    key = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 4 == 2, F.lit(False))


#: Map tasks whose rows of a group meet in one task, a power of two, and how often they are merged so.
MERGED_BITS, MERGES = 6, 2


def bounded_sample(rows: DataFrame, group: str, order: str, per_group: int) -> DataFrame:
    """At most per_group rows of each group, the same whatever the partitions: those that come
    first by a hash of the order column. A task hands on at most per_group rows of a group, and those
    of 64 tasks meet, then those of 64 such, so no task's share grows with the number of tasks.
    """
    by_hash = [F.xxhash64(F.lit(11), F.col(order)), F.col(order)]
    part, rank = free_name(rows, "part"), free_name(rows, "rank")
    found = rows.withColumn(part, F.spark_partition_id())
    levels = [[F.shiftright(part, MERGED_BITS * (k + 1))] for k in range(MERGES)]
    for level in [*levels, []]:
        first = Window.partitionBy(group, *level).orderBy(*by_hash)
        found = found.withColumn(rank, F.row_number().over(first)).where(F.col(rank) <= per_group).drop(rank)
    return found.drop(part)
