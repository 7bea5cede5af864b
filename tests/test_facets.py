import pytest
from pyspark.sql import functions as F

from tests.helpers import plan, random_hits, same_rows
from trailmark import schemas
from trailmark.fixed_values import MEDIUM_GROUPS
from trailmark.operators.facets import Facet, Total, facet_report
from trailmark.plans import journey, site
from trailmark.sources import small_table
from workload.plain import plain_journey


@pytest.fixture(scope="module")
def hits(spark):
    return random_hits(spark, 1500, seed=5).cache()


def mediums(spark):
    return small_table(spark, MEDIUM_GROUPS, schemas.MEDIUM_LOOKUP)


def test_journey_equals_the_plain_form(spark, hits):
    got = journey.customer_journey(hits, mediums(spark))
    assert len(got.columns) == 55
    same_rows(got, plain_journey(hits, mediums(spark)))


def test_journey_plan(spark, hits):
    text = plan(journey.customer_journey(hits, mediums(spark)))
    expand = next(line for line in text.splitlines() if " Expand " in line)
    # One copy per facet and two for totals, not one per distinct count; the last list names the output.
    assert len([part for part in expand.split("], [") if "_mask" in part]) == 6 + 1
    assert "Window" not in text and "collect_" not in text and "ObjectHashAggregate" not in text
    assert "BroadcastHashJoin" in text


def test_site_counts_equal_the_plain_form(spark, hits):
    visit, new = F.col("totals.visits") == 1, F.col("visitNumber") == 1
    session, visitor = F.col("sessionId"), F.col("fullVisitorId")
    info = F.col("hit.eventInfo")
    key = F.concat_ws("-", session, info["eventCategory"], info["eventAction"], info["eventLabel"])
    complete = session.isNotNull() & info["eventCategory"].isNotNull()
    complete &= info["eventAction"].isNotNull() & info["eventLabel"].isNotNull()
    expected = hits.groupBy("brand", F.to_date("visitStartDateTime").alias("date")).agg(
        F.count_distinct(visitor).alias("users"),
        F.count_distinct(F.when(new, visitor)).alias("new_users"),
        F.count_distinct(F.when(visit, session)).alias("sessions"),
        F.count_distinct(F.when(visit & new, session)).alias("new_sessions"),
        F.count_distinct(F.when(visit & (F.col("totals.bounces") == 1), session)).alias("bounced_sessions"),
        F.count_distinct(F.when(complete, key)).alias("unique_events"),
        F.sum(F.when(visit, F.col("totals.pageviews") / F.col("totals.hits"))).alias("visit_pageviews"),
        F.sum(F.col("totals.timeOnSite") / F.col("totals.hits")).alias("time_on_site"),
        F.sum(F.col("totals.transactions") / F.col("totals.hits")).alias("transactions"),
    )
    same_rows(site.site_counts(hits).select(*expected.columns), expected)


def test_conditional_totals_keep_null_and_zero_apart(spark):
    rows = spark.createDataFrame(
        [("k1", "s", "A", None), ("k2", "s", "A", None), ("k2", "t", "B", 5.0), ("k3", "s", "B", 1.0)],
        "k string, s string, c string, x double",
    )
    got = facet_report(
        rows,
        {"k": F.col("k")},
        [Facet(F.col("c"), totals={"a": Total("x", "A"), "every": Total("x")})],
        {"x": F.col("x")},
    )
    # Only NULLs: NULL. Rows of other values count as 0.
    assert sorted(got.collect()) == [("k1", None, None), ("k2", 0.0, 5.0), ("k3", 0.0, 1.0)]


def test_missing_values_are_not_counted(spark):
    rows = spark.createDataFrame([("k", None, 1), ("k", "s", None), ("j", None, 1)], "k string, s string, n int")
    got = facet_report(
        rows, {"k": F.col("k")}, [Facet(F.col("s"), {"every": None, "ones": F.col("n") == 1})]
    )
    assert sorted(got.collect()) == [("j", 0, 0), ("k", 1, 0)]


def test_more_predicates_than_one_mask_holds(spark):
    rows = spark.range(2)
    counts = {f"p{n}": F.col("id") == n % 2 for n in range(150)}
    found = facet_report(rows, {"k": F.lit(1)}, [Facet(F.col("id"), counts), Facet(F.lit("x"), {"any": None})]).first()
    assert set(found[1:]) == {1}


def test_totals_do_not_depend_on_the_order_of_summation(spark):
    """Totals above 45 million in seven shares each, dealt out in different ways."""
    shares = spark.range(700).select(
        (F.col("id") % 2).alias("k"), (F.col("id") / 7).cast("int").alias("s"),
        (F.lit(90000001) + F.floor(F.col("id") / 7)).alias("total"), F.lit(7).alias("parts"),
    )
    session = Facet(F.col("s"), {"sessions": None}, {"total": Total("total")})

    def report(rows):
        return sorted(facet_report(rows, {"k": F.col("k")}, [session], {"total": F.col("total")}, F.col("parts")).collect())

    first = report(shares.withColumn("k", F.lit(0)))
    assert first == [(0, 100, float(sum(90000001 + n for n in range(100))))]
    assert all(report(shares.repartition(n)) == report(shares) for n in (1, 3, 7))


def shares(spark, rows):
    frame = spark.createDataFrame(rows, "k string, s string, amount double, parts long")
    facet = Facet(F.col("s"), {"n": None}, {"total": Total("amount"), "of_a": Total("amount", "a")})
    report = facet_report(frame, {"k": F.col("k")}, [facet], {"amount": F.col("amount")}, divisor=F.col("parts"))
    return {r.k: (r.n, r.total, r.of_a) for r in report.collect()}


def test_a_measure_over_zero_is_an_error(spark):
    fine = [("k", "a", 6.0, 2), ("k", "a", 6.0, 2), ("k", "b", 1.0, None), ("l", "a", None, 0), ("l", "b", 2.0, 4)]
    assert shares(spark, fine) == {"k": (2, 6.0, 6.0), "l": (2, 0.5, 0.0)}
    for amount in (10.0, 0.0):
        with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
            shares(spark, [*fine, ("m", "a", amount, 0)])
