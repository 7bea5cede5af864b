"""Folder for intermediate tables."""

from uuid import uuid4

from pyspark.sql import SparkSession


def scratch_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder name where every executor can read and write.

    That is the cluster's checkpoint folder, or the session's warehouse if none is set.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        shared = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    return f"{shared.rstrip('/')}/{purpose}-{uuid4().hex}"
