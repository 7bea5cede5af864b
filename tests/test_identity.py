import pytest
from pyspark.sql import functions as F

from tests.helpers import final_plan, plan, random_hits, rows_of, same_rows
from trailmark.operators.attach import attach_by_key, full_outer_report
from trailmark.operators.identity import fill_identity, first_day_flag, packed_order, stitch_identity
from workload.plain import plain_first_day, plain_stitch, whole

COLUMNS = ["brand", "marsId", "sessionId", "fullVisitorId", "visitStartDateTime"]


@pytest.fixture(scope="module")
def hits(spark):
    return random_hits(spark, 600).select(*COLUMNS).cache()


def test_stitch_equals_the_window_and_crosses_brands(spark, hits):
    got = stitch_identity(hits, "marsId", "fullVisitorId", "visitStartDateTime")
    same_rows(got.select(*COLUMNS), plain_stitch(hits).select(*COLUMNS))
    known = got.where("marsId IS NOT NULL").groupBy("marsId").agg(
        F.count_distinct("fullVisitorId").alias("n"), F.count_distinct("brand").alias("brands")
    )
    assert known.agg(F.max("n"), F.max("brands")).first()[:] == (1, 2)


def test_first_day_equals_the_window_with_one_anonymous_group(spark, hits):
    got = first_day_flag(hits, "marsId", "visitStartDateTime")
    same_rows(got.select(*COLUMNS, "isNewVisit"), plain_first_day(hits).select(*COLUMNS, "isNewVisit"))
    anonymous = got.where("marsId IS NULL AND isNewVisit").select(F.to_date("visitStartDateTime")).distinct()
    assert anonymous.count() == 1


def test_a_missing_day_ranks_first(spark):
    rows = spark.createDataFrame([("m", None), ("m", "2024-01-01"), ("n", "2024-01-02")], "p string, t string")
    rows = rows.withColumn("t", F.col("t").cast("timestamp_ntz"))
    got = first_day_flag(rows, "p", "t", "first")
    assert sorted(rows_of(got.select("p", F.col("t").isNull(), "first"))) == [
        ("m", False, False), ("m", True, True), ("n", False, True),
    ]


def test_fill_equals_the_window(spark):
    hits = random_hits(spark, 500, seed=3).select("brand", "fullVisitorId", "marsId", "visitNumber", "hit.hitNumber")
    order = ["visitNumber", "hitNumber"]
    window = whole("brand", "fullVisitorId").orderBy(*order, F.asc_nulls_first("marsId"))
    expected = hits.withColumn("marsId", F.last("marsId", ignorenulls=True).over(window))
    got = fill_identity(hits, "marsId", ["brand", "fullVisitorId"], order, ["fullVisitorId", *order]).select(*hits.columns)
    same_rows(got, expected)


def test_no_window_and_no_single_partition(spark, hits):
    text = plan(stitch_identity(hits, "marsId", "fullVisitorId", "visitStartDateTime"))
    assert "Window" not in text and "SinglePartition" not in text


def test_missing_keys_are_spread(spark):
    rows = spark.range(2000).select(F.lit(None).cast("string").alias("k"), "id")
    lookup = spark.createDataFrame([(None, "none"), ("a", "known")], "k string, v string")
    joined = attach_by_key(rows, lookup, ["k"], ["id"], salts=16)
    assert joined.columns == ["k", "id", "v"]
    assert rows_of(joined.groupBy("v").count()) == [("none", 2000)]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        spread = attach_by_key(rows, lookup, ["k"], ["id"], salts=16).groupBy(F.spark_partition_id()).count()
        assert spread.count() > 4
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(10 * 1024 * 1024))
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_a_hot_key_is_split_and_stays_whole(spark):
    """A third of the rows with one key: the join's hot partition is cut up."""
    changed = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in changed}
    for key, value in changed.items():
        spark.conf.set(key, value)
    try:
        key = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 997).cast("string")))
        rows = spark.range(0, 60000, 1, 8).select(key.alias("k"), "id")
        lookup = rows.groupBy("k").agg(F.max("id").alias("last"))
        # The grouping on the same key must not keep the join from being split.
        counted = attach_by_key(rows, lookup, ["k"], ["id"]).groupBy("k", "last").count()
        assert "skew=true" in final_plan(counted)
        total, keys, hot = counted.agg(
            F.sum("count"), F.count("*"), F.max(F.when(F.col("k") == "hot", F.col("count")))
        ).first()
        assert (total, keys, hot) == (60000, 998, 20000)
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def test_full_outer_report_keeps_both_sides_of_null_keys(spark):
    left = spark.createDataFrame([(None, 1, 10), ("a", 1, 20)], "brand string, date int, clicks int")
    right = spark.createDataFrame([(None, 1, 5), ("a", 1, 6), ("b", 2, 7)], "brand string, date int, users int")
    got = full_outer_report(left, right, ["brand", "date"])
    assert sorted(rows_of(got), key=str) == sorted(
        [(None, 1, 10, None), (None, 1, None, 5), ("a", 1, 20, 6), ("b", 2, None, 7)], key=str
    )


def test_packed_order_is_the_order_of_the_numbers(spark):
    values = [None, 0, 1, 2, 500, 2**31 - 2]
    pairs = [(a, b) for a in values for b in values]
    frame = spark.createDataFrame(pairs, "a long, b int")
    packed = {(r.a, r.b): r.p for r in frame.withColumn("p", packed_order([F.col("a"), F.col("b")])).collect()}
    rank = {v: n for n, v in enumerate(values)}
    by_rank = sorted(pairs, key=lambda p: (rank[p[0]], rank[p[1]]))
    assert sorted(pairs, key=packed.get) == by_rank and len(set(packed.values())) == len(pairs)
    for bad in (-1, 2**31 - 1):
        with pytest.raises(Exception, match="no order below"):
            spark.createDataFrame([(bad,)], "a long").select(packed_order([F.col("a")])).collect()


def test_identity_fill_sorts_no_hits(spark):
    """Rows meet in hash aggregates; only (visitor, member) pairs are compared as text."""
    rows = spark.createDataFrame([("v", 1, 1, "m")], "v string, n long, h long, m string")
    lines = plan(fill_identity(rows, "m", ["v"], ["n", "h"], spread_by=["n"])).splitlines()
    grouped = [line for line in lines if "Aggregate(" in line]
    assert any("HashAggregate(keys=[v" in line and ", m" in line and "partial_max(_packed" in line for line in grouped)
    sorted_ = [line for line in grouped if "SortAggregate" in line]
    assert sorted_ and all("struct(_packed" in line or "_last" in line for line in sorted_)
