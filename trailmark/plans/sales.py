"""Sales by brand."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def brand_sales(sales: DataFrame) -> DataFrame:
    return sales.groupBy("brand").agg(F.sum("sales").alias("sales"))
