"""Plain forms of the operators the library formulates its own way.

They serve as references in tests and for timing; windows over one key and a distinct
aggregate per output do not hold up on large or skewed data.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trailmark.fixed_values import (
    JOURNEY_CATEGORY_TEXTS,
    JOURNEY_CHANNELS,
    JOURNEY_EVENTS,
    JOURNEY_MEDIUMS,
    TREND_HORIZONS,
)
from trailmark.functions import utc_date
from trailmark.plans import journey, site


def whole(*by: str):
    return Window.partitionBy(*by).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)


def plain_stitch(hits: DataFrame) -> DataFrame:
    """Last visitor of each known member, by a window."""
    last = F.last("fullVisitorId").over(whole("marsId").orderBy("visitStartDateTime", "fullVisitorId"))
    stitched = F.when(F.col("marsId").isNotNull(), last).otherwise(F.col("fullVisitorId"))
    return hits.withColumn("fullVisitorId", stitched)


def plain_first_day(hits: DataFrame) -> DataFrame:
    """First day of each member, by a window; all anonymous rows are one group."""
    ranked = F.dense_rank().over(Window.partitionBy("marsId").orderBy(F.to_date("visitStartDateTime")))
    return hits.withColumn("isNewVisit", ranked == 1)


def plain_journey(hits, mediums):
    """The journey: identity by windows over hits, a distinct aggregate per column."""
    visits = journey.with_medium_group(hits.where(F.col("totals.visits") == 1), mediums)
    visits = plain_stitch(plain_first_day(visits))
    session, time = F.col("sessionId"), F.col("totals.timeOnSite") / F.col(site.HITS)
    category, action = F.col("hit.eventInfo.eventCategory"), F.col("hit.eventInfo.eventAction")

    def sessions(condition):
        return F.count_distinct(F.when(condition, session))

    def total(column):
        return F.round(F.sum(F.col(f"totals.{column}") / F.col(site.HITS)))

    aggregates = {
        "isNewVisit": F.bool_or("isNewVisit"),
        "sessions": F.count_distinct(session),
        "channels": F.count_distinct("channelGrouping"),
        "mediums": F.count_distinct("mediumGrouping"),
        "events": F.count_distinct(F.when(F.col("hit.isInteraction"), category)),
        "browsing_time": total("timeOnSite"),
        "pageviews": total("pageviews"),
        "hits": total("hits"),
    }
    for column, values in (("channelGrouping", JOURNEY_CHANNELS), ("mediumGrouping", JOURNEY_MEDIUMS)):
        for name, value in values.items():
            match = F.col(column) == value
            aggregates[f"{name}_sessions"] = sessions(match)
            aggregates[f"{name}_browsing_time"] = F.round(F.sum(F.when(match, time).otherwise(F.lit(0))))
    for name, (c, a) in JOURNEY_EVENTS.items():
        aggregates[f"{name}_sessions"] = sessions((category == c) & (action == a))
    for name, (text, ignore_case) in JOURNEY_CATEGORY_TEXTS.items():
        found = (F.lower(category) if ignore_case else category).like(f"%{text}%")
        aggregates[f"{name}_sessions"] = sessions(found)
    keys = ["brand", "marsId", "fullVisitorId", F.to_date("visitStartDateTime").alias("date")]
    return visits.groupBy(*keys).agg(*[c.alias(n) for n, c in aggregates.items()])


def plain_slope(interest: DataFrame, days: int) -> DataFrame:
    """Slopes of one horizon, with the means by a window over everything."""
    numbering = Window.partitionBy("keyword").orderBy("date", "hits")
    everything = Window.partitionBy()
    recent = F.col("date") >= F.date_sub(utc_date(F.col("updated_datetime")), days)
    numbered = interest.where(recent).select(
        "keyword", F.row_number().over(numbering).alias("x"), F.col("hits").alias("y")
    )
    centred = numbered.withColumns({f"{c}_bar": F.avg(c).over(everything) for c in "xy"})
    dx, dy = F.col("x") - F.col("x_bar"), F.col("y") - F.col("y_bar")
    return centred.groupBy("keyword").agg((F.sum(dx * dy) / F.sum(dx * dx)).alias("slope"))


def plain_slopes(interest: DataFrame) -> DataFrame:
    """Slopes of all horizons, one pass each."""
    result = interest.select("keyword").distinct()
    for name, (days, _) in TREND_HORIZONS.items():
        result = result.join(plain_slope(interest, days).withColumnRenamed("slope", name), "keyword", "left")
    return result
