"""Append load of landed files, each exactly once.

A scheduled append that is retried, or whose file is uploaded again under the same
name, doubles its rows. The file source keeps the list of loaded files in the
checkpoint and the sink commits each batch once, so a run after a failure goes on
where the last one stopped. ``available now`` makes it a batch job: it loads what has
landed and ends.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from trailmark.sources.readers import page_records, page_schema


def landed_csv(
    spark: SparkSession, folder: str, schema: T.StructType, quoted_newlines: bool = True
) -> DataFrame:
    """As ``read_csv_positional``: without quoted newlines Spark can split large files."""
    reader = spark.readStream.schema(schema).option("header", True).option("enforceSchema", True)
    reader = reader.option("multiLine", quoted_newlines).option("escape", '"')
    return reader.option("mode", "FAILFAST").csv(folder)


def landed_json_pages(
    spark: SparkSession, folder: str, record_schema: T.StructType, document_per_file: bool = True
) -> DataFrame:
    """As ``read_json_pages``: a document per line lets Spark split large files."""
    reader = spark.readStream.schema(page_schema(record_schema)).option("multiLine", document_per_file)
    return page_records(reader.option("mode", "FAILFAST").json(folder))


def append_new(landed: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Load the files not loaded yet; both folders must be on storage all nodes share."""
    return (
        landed.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start(target)
    )
