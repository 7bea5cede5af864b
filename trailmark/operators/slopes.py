"""Trend slopes of many series over several horizons in one pass."""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def within_days(day: Column, as_of: Column, days: Column | int) -> Column:
    """``day`` is at most ``days`` before ``as_of``, bounds included."""
    return day >= F.date_sub(as_of, days)


def merged_points(series: DataFrame, horizons: Mapping[str, int], by: Sequence[str] = ()) -> DataFrame:
    """Equal points of a key as one row with a count ``n``; input columns key, day, as_of, y and ``by``.

    Points older than any horizon are left without day and value, one row for each key, as_of and ``by``.
    """
    recent = within_days(F.col("day"), F.col("as_of"), max(horizons.values()))
    kept = {name: F.when(recent, F.col(name)) for name in ("day", "y")}
    return series.withColumns(kept).groupBy("key", "day", "as_of", "y", *by).agg(F.count("*").alias("n"))


def points_of(merged: DataFrame, horizons: Mapping[str, int]) -> DataFrame:
    """Merged points within each horizon: horizon, key, day, y, n. The rows of a day of a key are in one task."""
    days = F.array(*[F.struct(F.lit(h).alias("horizon"), F.lit(d).alias("days")) for h, d in horizons.items()])
    # as_of differs only between loads; merge again without it after the filter.
    return (
        merged.where(F.when(F.col("day").isNotNull(), F.col("n")) > 0)
        .repartition("key", "day")
        .select("*", F.inline(days))
        .where(F.coalesce(within_days(F.col("day"), F.col("as_of"), F.col("days")), F.lit(False)))
        .groupBy("horizon", "key", "day", "y")
        .agg(F.sum("n").alias("n"))
    )


def recent_points(series: DataFrame, horizons: Mapping[str, int]) -> DataFrame:
    """Points within each horizon, equal ones of a key merged to one row with a count ``n``.

    Input columns: key, day, as_of, y. Older points than any horizon are left out ahead of the
    first shuffle.
    """
    recent = series.where(within_days(F.col("day"), F.col("as_of"), max(horizons.values())))
    return points_of(merged_points(recent, horizons), horizons)


def _ranked_in_day(points: DataFrame) -> DataFrame:
    """``ahead``: the points of the same day of the key with a smaller value."""
    smaller = Window.partitionBy("horizon", "key", "day").orderBy("y").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return points.withColumn("ahead", F.sum("n").over(smaller) - F.col("n"))


def numbered(points: DataFrame) -> DataFrame:
    """The points' row numbers in their series: ``before + 1 .. before + n``.

    In two levels: the points of earlier days, from the days' counts, of which a horizon bounds the
    number, and the rank within the day by value. So no window or task holds a series.
    """
    days = points.groupBy("horizon", "key", "day").agg(F.sum("n").alias("n"))
    of_key = days.groupBy("horizon", "key").agg(F.sort_array(F.collect_list(F.struct("day", "n"))).alias("days"))
    earlier = F.aggregate(F.slice("days", 1, F.col("no")), F.lit(0).cast("long"), lambda total, d: total + d["n"])
    starts = of_key.select("horizon", "key", "days", F.posexplode("days").alias("no", "d"))
    starts = starts.select("horizon", "key", F.col("d.day").alias("day"), earlier.alias("earlier"))
    found = _ranked_in_day(points).join(starts, ["horizon", "key", "day"])
    return found.select(*points.columns, (F.col("earlier") + F.col("ahead")).alias("before"))


def _run_sums() -> tuple[Column, Column]:
    """Sums of j and j*j over one run of equal points, j = ahead + 1 .. ahead + n their numbers in the day."""
    n, b = F.col("n").cast("double"), F.col("ahead").cast("double")
    sum_x = n * b + n * (n + 1) / 2
    sum_xx = n * b * b + b * n * (n + 1) + n * (n + 1) * (2 * n + 1) / 6
    return sum_x, sum_xx


def series_sums(points: DataFrame) -> DataFrame:
    """Per horizon and key: the sums a least-squares slope is made of, x the points' numbers.

    First by day, with the numbers in the day; then over a key's days, moving the numbers of each
    behind the points of the earlier ones.
    """
    sum_j, sum_jj = _run_sums()
    known = F.col("y").isNotNull()
    n = F.when(known, F.col("n"))
    zero = F.lit(0.0)
    by_day = _ranked_in_day(points).groupBy("horizon", "key", "day").agg(
        F.sum("n").cast("double").alias("n"),
        F.sum(sum_j).alias("sx"),
        F.sum(sum_jj).alias("sxx"),
        F.coalesce(F.sum(n).cast("double"), zero).alias("n_y"),
        F.coalesce(F.sum(F.when(known, sum_j)), zero).alias("sx_y"),
        F.sum(n * F.col("y")).cast("double").alias("sy"),
        F.sum(F.when(known, sum_j) * F.col("y")).alias("sxy"),
    )
    sums = ["n", "sx", "sxx", "n_y", "sx_y", "sy", "sxy"]
    days = F.sort_array(F.collect_list(F.struct("day", *sums)))
    start = F.struct(*[F.lit(0.0).alias(name) for name in sums])

    def moved(so_far: Column, d: Column) -> Column:
        """x = so_far.n + j for every point of the day."""
        b = so_far["n"]
        of_day = {
            "n": d["n"],
            "sx": d["n"] * b + d["sx"],
            "sxx": d["n"] * b * b + 2 * b * d["sx"] + d["sxx"],
            "n_y": d["n_y"],
            "sx_y": d["n_y"] * b + d["sx_y"],
            "sy": F.coalesce(d["sy"], zero),
            "sxy": F.coalesce(b * d["sy"] + d["sxy"], zero),
        }
        return F.struct(*[(so_far[name] + value).alias(name) for name, value in of_day.items()])

    folded = by_day.groupBy("horizon", "key").agg(F.aggregate(days, start, moved).alias("s")).select("horizon", "key", "s.*")
    # Without a known value these sums are NULL, not 0.
    return folded.withColumns({name: F.when(F.col("n_y") > 0, F.col(name)) for name in ("n_y", "sx_y", "sy", "sxy")})


def pooled_means(sums: DataFrame) -> DataFrame:
    """Means over all series of a horizon, one row each, from the sums of the series."""
    return sums.groupBy("horizon").agg(
        (F.sum("sx") / F.sum("n")).alias("x_bar"),
        F.try_divide(F.sum("sy"), F.sum("n_y")).alias("y_bar"),
    )


def with_means(sums: DataFrame, means: DataFrame | None = None) -> DataFrame:
    """Add the means: the given ones of a horizon, or those of each series alone."""
    if means is None:
        own = {"x_bar": F.col("sx") / F.col("n"), "y_bar": F.try_divide(F.col("sy"), F.col("n_y"))}
        return sums.withColumns(own)
    # One row per horizon.
    return sums.join(F.broadcast(means), "horizon")


def pooled_slopes(
    series: DataFrame,
    key: str,
    day: Column,
    value: Column,
    as_of: Column,
    horizons: Mapping[str, int],
    pooled: bool = True,
) -> DataFrame:
    """Per key one slope column per horizon (output -> days back).

    slope = sum((x - x_bar)(y - y_bar)) / sum((x - x_bar)^2), x the point's number in
    its series. The means are taken over all series unless ``pooled`` is off, so the
    slope of a series shorter than the others differs from its own regression.
    """
    rows = series.select(F.col(key).alias("key"), day.alias("day"), as_of.alias("as_of"), value.alias("y"))
    return slopes_of(recent_points(rows, horizons), horizons, pooled).withColumnRenamed("key", key)


def slopes_of(points: DataFrame, horizons: Mapping[str, int], pooled: bool = True) -> DataFrame:
    """``pooled_slopes`` from points within the horizons. Sums and means come from one aggregate."""
    each = series_sums(points)
    sums = with_means(each, pooled_means(each) if pooled else None)
    c = F.col
    covariance = c("sxy") - c("x_bar") * c("sy") - c("y_bar") * c("sx_y") + c("n_y") * c("x_bar") * c("y_bar")
    variance = c("sxx") - 2 * c("x_bar") * c("sx") + c("n") * c("x_bar") * c("x_bar")
    slopes = sums.select("key", "horizon", (covariance / variance).alias("slope"))
    return slopes.groupBy("key").agg(
        *[F.max(F.when(F.col("horizon") == name, F.col("slope"))).alias(name) for name in horizons]
    )


def weighted_score(weights: Mapping[str, int]) -> Column:
    """Weighted mean of slope columns; NULL if any is missing."""
    total = sum((F.col(name) * weight for name, weight in weights.items()), F.lit(0))
    return total / F.lit(sum(weights.values()))
