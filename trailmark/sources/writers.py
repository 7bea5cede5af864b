"""Table and file writes."""

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from uuid import uuid4

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

from trailmark.sources.layout import in_ranges

#: Columns that name the load a row came with.
LOAD_KEYS = ("load_source", "load_day")
#: Properties of a replaceable table: the tables that hold its rows, and its former rows.
CURRENT, FORMER = "trailmark.current", "trailmark.former"


def table_name(table: str, schema: str | None = None, default_schema: str | None = None) -> str:
    """Qualified name: the given schema as is, else the default, else the bare table."""
    chosen = schema.strip() if schema is not None else default_schema
    return f"{chosen}.{table}" if chosen else table


@contextmanager
def _prepared(
    rows: DataFrame, mode: str, cluster_by: Sequence[str], partition_by: Sequence[str]
) -> Iterator[DataFrameWriter]:
    def writer(prepared: DataFrame) -> DataFrameWriter:
        writes = prepared.write.format("parquet").mode(mode).option("partitionOverwriteMode", "static")
        return writes.partitionBy(*partition_by) if partition_by else writes

    if cluster_by:
        # Ranges of the layout columns give files with narrow min/max statistics.
        layout = [*partition_by, *[c for c in cluster_by if c not in partition_by]]
        with in_ranges(rows, layout) as ordered:
            yield writer(ordered)
    elif partition_by:
        # One task per folder where it is small, several where it is large.
        yield writer(rows.hint("rebalance", *[F.col(c) for c in partition_by]))
    else:
        yield writer(rows)


def _quoted(name: str) -> str:
    return ".".join(f"`{part}`" for part in name.split("."))


def _kind(spark: SparkSession, name: str) -> str | None:
    """What the catalog holds under a qualified name: VIEW, MANAGED, EXTERNAL, or nothing."""
    return spark.catalog.getTable(name).tableType if spark.catalog.tableExists(name) else None


def _properties(spark: SparkSession, name: str) -> dict[str, str]:
    if _kind(spark, name) != "VIEW":
        return {}
    return {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {_quoted(name)}").collect()}


def _replace_table(
    rows: DataFrame, name: str, cluster_by: Sequence[str], partition_by: Sequence[str]
) -> None:
    spark = rows.sparkSession
    aside = f"{name}__{uuid4().hex}"
    try:
        with _prepared(rows, "error", cluster_by, partition_by) as writer:
            writer.saveAsTable(aside)
    except BaseException:
        spark.sql(f"DROP TABLE IF EXISTS {_quoted(aside)}")
        raise
    before = _properties(spark, name)
    former = before.get(CURRENT, "")
    if _kind(spark, name) in ("MANAGED", "EXTERNAL"):  # not written by this function
        former = f"{name}__{uuid4().hex}"
        spark.sql(f"ALTER TABLE {_quoted(name)} RENAME TO {_quoted(former)}")
    spark.sql(
        f"CREATE OR REPLACE VIEW {_quoted(name)} TBLPROPERTIES ('{CURRENT}' = '{aside}', '{FORMER}' = '{former}')"
        f" AS SELECT * FROM {_quoted(aside)}"
    )
    if before.get(FORMER):
        spark.sql(f"DROP TABLE IF EXISTS {_quoted(before[FORMER])}")


def write_table(
    rows: DataFrame,
    table: str,
    schema: str | None = None,
    mode: str = "overwrite",
    cluster_by: Sequence[str] = (),
    partition_by: Sequence[str] = (),
    default_schema: str | None = None,
) -> None:
    """Create or replace (or append to) a catalog table.

    A replacement is written to a table aside, and the name, a view over the table that holds the
    rows, is switched to it in one step at the end. So a write that fails leaves the former rows,
    readers go on meanwhile, and rows may be made from the table they replace. Those who began
    on the former rows have them until the next replacement. Only a table of the name that was not
    written by this function is renamed first, which leaves a moment without it.
    """
    spark = rows.sparkSession
    name = table_name(table, schema, default_schema)
    if "." not in name:
        name = f"{spark.catalog.currentDatabase()}.{name}"
    if mode == "overwrite":
        _replace_table(rows, name, cluster_by, partition_by)
        return
    with _prepared(rows, mode, cluster_by, partition_by) as writer:
        writer.saveAsTable(_properties(spark, name).get(CURRENT, name))


def drop_table(spark: SparkSession, table: str, schema: str | None = None) -> None:
    """Drop a table of ``write_table`` with its current and former rows, or any other table or view."""
    name = table_name(table, schema)
    if "." not in name:
        name = f"{spark.catalog.currentDatabase()}.{name}"
    held = _properties(spark, name)
    spark.sql(f"DROP {'VIEW' if _kind(spark, name) == 'VIEW' else 'TABLE'} IF EXISTS {_quoted(name)}")
    for rows in (held.get(CURRENT), held.get(FORMER)):
        if rows:
            spark.sql(f"DROP TABLE IF EXISTS {_quoted(rows)}")


def write_files(
    rows: DataFrame,
    path: str,
    mode: str = "overwrite",
    cluster_by: Sequence[str] = (),
    partition_by: Sequence[str] = (),
) -> None:
    """The same, to a folder. Here "overwrite" deletes before it writes; ``ledger.replace_files`` does not."""
    with _prepared(rows, mode, cluster_by, partition_by) as writer:
        writer.save(path)


def load_run(rows: DataFrame, path: str, source: str, run_day: str) -> None:
    """Append the rows of one load, known by its source and the day of its run, to a plain folder.

    Repeating a load replaces what it loaded before and nothing else, so several sources may
    load the same day, and the days of their events may overlap. A repeat without rows leaves
    the former ones, and a reader must name the keys' types (a source `07` is else read as a
    number): ``ledger.publish_load`` has neither limit.
    """
    taken = {c.lower() for c in rows.columns} & set(LOAD_KEYS)
    if taken:
        raise ValueError(f"rows carry a load's key already: {sorted(taken)}")
    stamped = rows.withColumns({name: F.lit(value) for name, value in zip(LOAD_KEYS, (source, run_day), strict=True)})
    with _prepared(stamped, "overwrite", (), LOAD_KEYS) as writer:
        writer.option("partitionOverwriteMode", "dynamic").save(path)


def publish_view(rows: DataFrame, name: str) -> None:
    rows.createOrReplaceTempView(name)
