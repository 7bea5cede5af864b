"""Readers for day shards, headed CSV files and landed JSON pages."""

import re
from collections.abc import Sequence
from datetime import date, timedelta

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trailmark.sources.folders import folder_names


def shard_glob(root: str, prefix: str, date_from: date | None = None, date_to: date | None = None) -> str:
    """Path glob of ``<root>/<prefix>*``, or of the named days' shards only.

    Without bounds every shard is matched, same-day "intraday" shards included.
    """
    if date_from is None and date_to is None:
        return f"{root}/{prefix}*"
    if date_from is None or date_to is None or date_from > date_to:
        raise ValueError("give both date bounds, in order")
    days = [date_from + timedelta(days=n) for n in range((date_to - date_from).days + 1)]
    names = [f"{kind}{day:%Y%m%d}" for day in days for kind in ("", "intraday_")]
    return f"{root}/{prefix}{{{','.join(names)}}}*"


def read_shards(
    spark: SparkSession,
    root: str,
    prefix: str,
    schema: T.StructType,
    date_from: date | None = None,
    date_to: date | None = None,
) -> DataFrame:
    """A family of day-sharded parquet tables as one frame.

    Bounds prune the listing to those days. A bounded read changes the member id fill,
    which looks at a visitor's whole history.
    """
    return spark.read.schema(schema).parquet(shard_glob(root, prefix, date_from, date_to))


#: Column with what follows the prefix in the name of a row's shard.
SUFFIX = "_TABLE_SUFFIX"


def scan_shards(
    spark: SparkSession,
    root: str,
    prefix: str,
    schema: T.StructType,
    first: str | None = None,
    last: str | None = None,
) -> DataFrame:
    """A family of sharded parquet tables as one frame, with the shard's suffix as a text column.

    ``first`` and ``last`` bound the suffix, either alone too, by text order: folders of other shards
    are not listed. A filter on the column prunes the files of other shards ahead of the scan.
    Suffixes of days are eight digits, so those of same-day shards come after all of them. Shards
    that are not there are no rows.
    """
    names = [n for n in sorted(folder_names(spark, root)) if n.startswith(prefix)]
    suffixes = [n.removeprefix(prefix) for n in names]
    wanted = [s for s in suffixes if (first is None or s >= first) and (last is None or s <= last)]
    suffix = F.regexp_extract("_metadata.file_path", f"/{re.escape(prefix)}([^/]+)/[^/]*$", 1)
    if not wanted:
        return spark.createDataFrame([], schema).withColumn(SUFFIX, F.lit(None).cast("string"))
    shards = spark.read.schema(schema).parquet(*[f"{root}/{prefix}{s}" for s in wanted])
    return shards.select(*schema.names, suffix.alias(SUFFIX))


def read_csv_positional(
    spark: SparkSession, path: str | list[str], schema: T.StructType, quoted_newlines: bool = True
) -> DataFrame:
    """UTF-8 CSV with one header row; columns are taken by position, whatever it says.

    A quoted newline forces a file to be read by one task. Turn ``quoted_newlines`` off
    for large files known to have none. A row that does not fit the schema is an error.
    """
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", True)
        .option("multiLine", quoted_newlines)
        .option("escape", '"')
        .option("mode", "FAILFAST")
        .csv(path)
    )


def leaf_columns(schema: T.StructType, parent: str = "") -> list[Column]:
    """Leaves of nested structs as columns named by their dotted path."""
    leaves: list[Column] = []
    for field in schema.fields:
        path = f"{parent}.{field.name}" if parent else field.name
        if isinstance(field.dataType, T.StructType):
            leaves += leaf_columns(field.dataType, path)
        else:
            leaves.append(F.col(path).alias(path))
    return leaves


def page_schema(record_schema: T.StructType) -> T.StructType:
    page = T.StructType([T.StructField("records", T.ArrayType(record_schema))])
    return T.StructType([T.StructField("data", T.ArrayType(page))])


def page_records(pages: DataFrame) -> DataFrame:
    """One row per record of ``data[0].records``, nested objects as dotted columns."""
    records = pages.select(F.inline(F.get("data", F.lit(0))["records"]))
    return records.select(*leaf_columns(records.schema))


def read_json_pages(
    spark: SparkSession, path: str, record_schema: T.StructType, document_per_file: bool = True
) -> DataFrame:
    """Records of landed response pages, one JSON document per file, or per line.

    The second form packs many pages in large files that Spark can split.
    """
    reader = spark.read.schema(page_schema(record_schema)).option("multiLine", document_per_file)
    return page_records(reader.option("mode", "FAILFAST").json(path))


def small_table(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType) -> DataFrame:
    """A fixed lookup table held in the plan, so that Spark knows how small it is."""
    columns = zip(*rows, strict=True)
    table = pa.table({f.name: list(c) for f, c in zip(schema.fields, columns, strict=True)})
    return spark.createDataFrame(table, schema)
