"""Folders on whatever storage a path names, through Spark's own file systems."""

from pyspark.sql import SparkSession


def _opened(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def folder_exists(spark: SparkSession, path: str) -> bool:
    system, place = _opened(spark, path)
    return system.exists(place)


def folder_names(spark: SparkSession, path: str) -> dict[str, int]:
    """The names of the folders in a folder, with the millisecond they last changed; none if it is not there."""
    system, place = _opened(spark, path)
    if not system.exists(place):
        return {}
    found = system.listStatus(place)
    return {f.getPath().getName(): f.getModificationTime() for f in found if f.isDirectory()}


def delete_folder(spark: SparkSession, path: str) -> None:
    system, place = _opened(spark, path)
    system.delete(place, True)


def folder_bytes(spark: SparkSession, path: str) -> int:
    system, place = _opened(spark, path)
    return system.getContentSummary(place).getLength()
