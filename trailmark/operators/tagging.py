"""Tag interest series with keyword attributes."""

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def tag_series(series: DataFrame, keywords: DataFrame, run_at: datetime) -> DataFrame:
    """Interest table from fetched series (keyword, date, value, isPartial).

    ``keywords`` (keyword, is_luxe) lists the wanted keywords, others are left out.
    ``run_at`` (with a zone) stamps all rows of the run alike.
    """
    if run_at.tzinfo is None:
        raise ValueError("run_at needs a time zone")
    stamp = F.timestamp_micros(F.lit(round(run_at.timestamp() * 1_000_000)))
    return series.join(keywords, "keyword").select(
        "date",
        F.col("value").cast("bigint").alias("hits"),
        "keyword",
        "is_luxe",
        stamp.alias("updated_datetime"),
    )
