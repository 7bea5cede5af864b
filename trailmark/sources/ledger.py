"""Loads published whole: rows aside first, one ledger row last.

A load writes its rows to a new folder, which no reader looks at. Then a row of the ledger publishes
it. Readers take, for each load's key, the folder that the newest row names, so they see a load
whole or not at all, a repeat replaces what the load brought before (also by no rows), and a
write that fails leaves what was there. A load's key is kept as text in the ledger and in the rows,
not in folder names, so `07` stays `07`.

A set of files that is replaced as a whole is a ledger of one key.

Ledger rows are files of their own, in folders of their own, so loads may be published at the same
time. There are as many as loads; readers gather them, as they would a table's list of folders.
"""

from __future__ import annotations

import json
import time
from collections.abc import Sequence
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trailmark.sources.folders import delete_folder, folder_names
from trailmark.sources.writers import LOAD_KEYS, write_files

ROWS, LEDGER = "rows", "ledger"
LEDGER_COLUMNS = T.StructType([
    T.StructField("source", T.StringType()),
    T.StructField("day", T.StringType()),
    T.StructField("number", T.LongType()),
    T.StructField("folder", T.StringType()),
    T.StructField("columns", T.StringType()),
])


def ledger(spark: SparkSession, path: str) -> DataFrame:
    """All rows ever published: source, day, number (rising with every publication), folder, columns."""
    if not folder_names(spark, f"{path}/{LEDGER}"):
        return spark.createDataFrame([], LEDGER_COLUMNS)
    return spark.read.schema(LEDGER_COLUMNS).option("mode", "FAILFAST").json(f"{path}/{LEDGER}/*")


def newest(spark: SparkSession, path: str, sources: Sequence[str] | None = None, days: Sequence[str] | None = None) -> list[T.Row]:
    """The newest ledger row of each load, in the order they were published."""
    rows = ledger(spark, path)
    for column, wanted in (("source", sources), ("day", days)):
        if wanted is not None:
            rows = rows.where(F.col(column).isin(list(wanted)))
    last = F.max_by(F.struct(*LEDGER_COLUMNS.names), F.struct("number", "folder")).alias("last")
    found = rows.groupBy("source", "day").agg(last).select("last.*").collect()
    return sorted(found, key=lambda r: (r.number, r.folder))


def _publish(
    rows: DataFrame, path: str, source: str, day: str, cluster_by: Sequence[str] = (), partition_by: Sequence[str] = ()
) -> None:
    spark = rows.sparkSession
    folder = uuid4().hex
    write_files(rows, f"{path}/{ROWS}/{folder}", "error", cluster_by, partition_by)
    number = (ledger(spark, path).agg(F.max("number")).first()[0] or 0) + 1
    row = spark.createDataFrame([(source, day, number, folder, rows.schema.json())], LEDGER_COLUMNS)
    row.coalesce(1).write.json(f"{path}/{LEDGER}/{number:012}-{folder}")


def publish_load(rows: DataFrame, path: str, source: str, run_day: str) -> None:
    """Load the rows under a key of source and day of the run, both text. A repeat replaces the former rows."""
    taken = {c.lower() for c in rows.columns} & set(LOAD_KEYS)
    if taken:
        raise ValueError(f"rows carry a load's key already: {sorted(taken)}")
    if not (isinstance(source, str) and isinstance(run_day, str)):
        raise TypeError("a load's key is text")
    stamped = rows.withColumns({name: F.lit(value) for name, value in zip(LOAD_KEYS, (source, run_day), strict=True)})
    _publish(stamped, path, source, run_day)


def published_loads(
    spark: SparkSession, path: str, sources: Sequence[str] | None = None, days: Sequence[str] | None = None
) -> DataFrame:
    """The rows of all published loads, or of those of some sources and days: no other folder is read.

    Columns are those of the load published last; rows of loads that lack some have NULL there.
    """
    return _read(spark, path, newest(spark, path, sources, days))


def _read(spark: SparkSession, path: str, found: list[T.Row]) -> DataFrame:
    if not found:
        raise ValueError(f"nothing is published in {path}")
    schema = T.StructType.fromJson(json.loads(found[-1].columns))
    return spark.read.schema(schema).parquet(*[f"{path}/{ROWS}/{r.folder}" for r in found])


def replace_files(rows: DataFrame, path: str, cluster_by: Sequence[str] = (), partition_by: Sequence[str] = ()) -> None:
    """Replace the set of files at a path; `current_files` gives the former ones until all are written.

    The rows may be made from the set that they replace. Former files stay until `sweep`.
    """
    _publish(rows, path, "", "", cluster_by, partition_by)


def current_files(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, path, newest(spark, path))


def sweep(spark: SparkSession, path: str, older_than_hours: float = 24.0) -> list[str]:
    """Delete the rows that no reader can ask for any more, and name their folders: those of former and of
    failed loads, once they have not changed for so long. Give readers and running loads time to end.
    """
    kept = {r.folder for r in newest(spark, path)}
    before = (time.time() - older_than_hours * 3600) * 1000
    old = [name for name, changed in folder_names(spark, f"{path}/{ROWS}").items() if name not in kept and changed <= before]
    for name in sorted(old):
        delete_folder(spark, f"{path}/{ROWS}/{name}")
    return sorted(old)
