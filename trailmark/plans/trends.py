"""Search-interest trend report."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailmark.fixed_values import TREND_HORIZONS
from trailmark.functions import utc_date
from trailmark.operators.slopes import merged_points, points_of, pooled_slopes, slopes_of, weighted_score


def trend_slopes(interest: DataFrame, pooled: bool = True) -> DataFrame:
    return pooled_slopes(
        interest,
        key="keyword",
        day=F.col("date"),
        value=F.col("hits"),
        as_of=utc_date(F.col("updated_datetime")),
        horizons={name: days for name, (days, _) in TREND_HORIZONS.items()},
        pooled=pooled,
    )


def trend_report(interest: DataFrame, pooled: bool = True) -> DataFrame:
    """Slopes and score, one row per keyword and update time, in one scan of the series."""
    horizons = {name: days for name, (days, _) in TREND_HORIZONS.items()}
    series = interest.select(
        F.col("keyword").alias("key"),
        F.col("date").alias("day"),
        utc_date(F.col("updated_datetime")).alias("as_of"),
        F.col("hits").alias("y"),
        "updated_datetime",
    )
    merged = merged_points(series, horizons, ["updated_datetime"])
    # Every update has a row there. To ask for the counts keeps both uses of the rows equal, so that
    # they are shuffled once.
    base = merged.where("n > 0").select("key", "updated_datetime").distinct()
    slopes = slopes_of(points_of(merged, horizons), horizons, pooled).withColumnRenamed("key", "_key")
    # Null-safe, so that no filter on the key makes the slopes' points differ from those of the means.
    same = F.col("key").eqNullSafe(F.col("_key")) & F.col("key").isNotNull()
    score = weighted_score({name: weight for name, (_, weight) in TREND_HORIZONS.items()})
    return base.join(slopes, same, "left").select(
        F.col("key").alias("keyword"), *TREND_HORIZONS, score.alias("score"), "updated_datetime"
    )
