import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tests.helpers import final_plan, plan
from trailmark import schemas
from trailmark.operators.slopes import numbered, recent_points
from trailmark.plans.trends import trend_report, trend_slopes
from workload.plain import plain_slope

ASOF = datetime(2022, 6, 30, 20, 0)  # UTC; already 1 July at +8


def interest(spark, points):
    rows = [(day, hits, keyword, False, at) for keyword, day, hits, at in points]
    return spark.createDataFrame(rows, schemas.INTEREST)


def series(keyword, n, step=7, seed=0, at=ASOF):
    chance = random.Random(f"{keyword}{seed}")
    return [(keyword, at.date() - timedelta(days=step * i), chance.randrange(100), at) for i in range(n)]


def check(rows):
    got = {r.keyword: r for r in trend_slopes(rows).collect()}
    for name, days in (("slope_3m", 90), ("slope_6m", 180), ("slope_1y", 365)):
        expected = dict(plain_slope(rows, days).collect())
        assert {k for k, r in got.items() if r[name] is not None} == {k for k, v in expected.items() if v is not None}
        for keyword, slope in expected.items():
            assert got[keyword][name] == (None if slope is None else pytest.approx(slope, rel=1e-9, abs=1e-12))


def test_equals_three_passes_with_unequal_series(spark):
    check(interest(spark, series("a", 60) + series("b", 20) + series("c", 9) + series("d", 3)))


def test_repeated_days_and_missing_values(spark):
    points = series("a", 30) + series("a", 30) + series("a", 30, seed=1) + series("b", 25)
    points += [("b", ASOF.date() - timedelta(days=3), None, ASOF), ("b", None, 5, ASOF)]
    check(interest(spark, points))


def test_only_pooling_the_means_differs_from_a_regression_of_each_series(spark):
    rows = interest(spark, series("a", 12) + series("b", 5))
    alone = {
        r.keyword: r.slope
        for r in rows.withColumn(
            "x", F.row_number().over(Window.partitionBy("keyword").orderBy("date"))
        ).groupBy("keyword").agg(F.regr_slope(F.col("hits").cast("double"), F.col("x").cast("double")).alias("slope")).collect()
    }
    pooled = {r.keyword: r.slope_3m for r in trend_slopes(rows).collect()}
    own = {r.keyword: r.slope_3m for r in trend_slopes(rows, pooled=False).collect()}
    assert own == {k: pytest.approx(v) for k, v in alone.items()}
    assert pooled["b"] != pytest.approx(alone["b"])
    # With as many points in each series the means of x agree, and the slopes with them.
    rows = interest(spark, series("a", 6) + series("b", 6))
    pooled = {r.keyword: r.slope_3m for r in trend_slopes(rows).collect()}
    own = {r.keyword: r.slope_3m for r in trend_slopes(rows, pooled=False).collect()}
    assert pooled == {k: pytest.approx(v) for k, v in own.items()}


def test_horizon_bounds_are_inclusive_utc_days(spark):
    def points(oldest):
        return interest(spark, [("a", ASOF.date() - timedelta(days=d), h, ASOF) for d, h in ((0, 1), (1, 5), (oldest, 9))])

    inside, outside = (trend_slopes(points(d)).first().slope_3m for d in (90, 91))
    assert inside == pytest.approx(-4) and outside == pytest.approx(-4)
    counts = {d: points(d).where(F.col("date") >= date(2022, 4, 1)).count() for d in (90, 91)}
    assert counts == {90: 3, 91: 2}
    check(points(90))
    check(points(91))


def test_score_is_null_if_a_slope_is_missing(spark):
    old = [("old", ASOF.date() - timedelta(days=d), h, ASOF) for d, h in ((200, 1), (210, 4), (220, 9))]
    report = {r.keyword: r for r in trend_report(interest(spark, series("a", 50) + old)).collect()}
    row = report["a"]
    assert row.score == pytest.approx((row.slope_3m * 2 + row.slope_6m * 2 + row.slope_1y) / 5)
    assert report["old"].slope_1y is not None and report["old"].slope_3m is None and report["old"].score is None


def test_one_row_per_keyword_and_update(spark):
    earlier = ASOF - timedelta(days=1)
    rows = interest(spark, series("a", 20) + series("a", 20, at=earlier))
    assert trend_report(rows).count() == 2
    check(rows)


def test_no_single_partition(spark):
    assert "SinglePartition" not in plan(trend_report(interest(spark, series("a", 20))))


def test_runs_are_built_once_from_recent_points(spark, tmp_path):
    interest(spark, series("a", 50) + series("b", 20)).write.parquet(str(tmp_path / "interest"))
    text = final_plan(trend_slopes(spark.read.parquet(str(tmp_path / "interest"))))
    final = text.split("Initial Plan")[0]
    assert len([line for line in final.splitlines() if "Window [" in line or " Window " in line]) == 1
    # Old points go ahead of the first grouping.
    lines = final.splitlines()
    scan = next(n for n, line in enumerate(lines) if "FileScan" in line)
    assert any("Filter" in line and "date_sub" in line for line in lines[scan - 4 : scan])


def test_numbers_follow_days_then_values(spark):
    points = series("a", 20) + series("a", 20) + series("b", 5) + [("b", ASOF.date(), None, ASOF)]
    rows = interest(spark, points).selectExpr("keyword AS key", "date AS day", "DATE'2022-06-30' AS as_of", "hits AS y")
    found = numbered(recent_points(rows, {"all": 365}))
    window = Window.partitionBy("key").orderBy("day", "y")
    plain = sorted((r.key, r.day, r.x) for r in rows.withColumn("x", F.row_number().over(window)).collect())
    assert sorted((r.key, r.day, r.before + 1 + k) for r in found.collect() for k in range(r.n)) == plain
    windows = [line for line in plan(found).splitlines() if "Window [" in line]
    assert windows and all(line.count("day") for line in windows)


def test_one_scan_of_the_series_and_no_window_over_a_key(spark, tmp_path):
    rows = interest(spark, series("a", 50) + series("b", 20) + [("old", date(2001, 1, 1), 3, ASOF)])
    rows.write.parquet(str(tmp_path / "interest"))
    report = trend_report(spark.read.parquet(str(tmp_path / "interest")))
    assert {r.keyword for r in report.collect()} == {"a", "b", "old"}
    final = final_plan(report).split("Initial Plan")[0]
    assert final.count("FileScan") == 1 and "ReusedExchange" in final
    windows = [line for line in final.splitlines() if "Window [" in line]
    assert len(windows) == 1 and "day" in windows[0].split("], [")[1]
