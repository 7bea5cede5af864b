import json
from datetime import date, datetime, timedelta, timezone
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from tests.helpers import hit, plan, rows_of, session, session_frame
from trailmark import schemas
from trailmark.fixed_values import MEDIUM_GROUPS
from trailmark.operators.tagging import tag_series
from trailmark.plans import journey, tracking
from trailmark.sources import (
    SUFFIX,
    current_files,
    drop_table,
    load_run,
    publish_load,
    publish_view,
    published_loads,
    read_csv_positional,
    read_json_pages,
    read_shards,
    replace_files,
    scan_shards,
    scratch_folder,
    small_table,
    sweep,
    table_name,
    write_files,
    write_table,
)
from trailmark.sources import layout
from trailmark.sources.layout import in_ranges
from trailmark.streaming.landing import append_new, landed_csv, landed_json_pages

CSV = '''name,whatever,c,d,e,f,g,h,i
enter_shop,2024-01-01,2024-01-31,"U
1",enter,2024-01-01 08:30:00+08:00,2023-12-01 00:00:00.123456+00:00,2024-01-02,01
push_"x",2024-01-01,2024-01-31,U2,push,2024-01-01 08:30:00+08:00,,"",07
'''


def csv_file(folder, text=CSV, name="landed.csv"):
    folder.mkdir(exist_ok=True)
    path = folder / name
    path.write_text(text, encoding="utf-8-sig")
    return str(path)


def test_csv_by_position_with_bom_and_quoted_newline(spark, tmp_path):
    rows = read_csv_positional(spark, csv_file(tmp_path / "in"), schemas.BEACON)
    assert rows.columns == schemas.BEACON.names
    first, second = rows.collect()
    assert (first.event_name, first.receiver_uid, first.brand_id) == ("enter_shop", "U\n1", "01")
    assert rows.select(F.unix_seconds("event_time")).first()[0] == 1704069000
    assert rows.select(F.unix_micros("first_follow")).first()[0] == 1701388800123456
    assert (second.first_follow, second.bind_date) == (None, None)


def test_csv_rows_that_do_not_fit_are_errors(spark, tmp_path):
    bad = csv_file(tmp_path / "in", "a,b\n1,x\noops,y\n")
    schema = schemas.record(a=schemas.BIGINT, b=schemas.STRING)
    with pytest.raises(Exception, match="FAILED_READ_FILE|MALFORMED_RECORD"):
        read_csv_positional(spark, bad, schema).collect()


def test_interest_csv_with_booleans(spark, tmp_path):
    text = "date,hits,keyword,is_luxe,updated_datetime\n2022-01-02,37,Kiosk,True,2022-01-03 08:00:00.5+08:00\n"
    rows = read_csv_positional(spark, csv_file(tmp_path / "in", text), schemas.INTEREST)
    assert rows.select("date", "hits", "keyword", "is_luxe").first()[:] == (date(2022, 1, 2), 37, "Kiosk", True)


RECORD = schemas.record(
    id=schemas.BIGINT,
    who=schemas.record(name=schemas.STRING, home=schemas.record(city=schemas.STRING)),
    tags=schemas.T.ArrayType(schemas.STRING),
)


def page(*records):
    return json.dumps({"data": [{"pagination": {"page_count": 2}, "records": list(records)}, {"records": [{"id": 99}]}]}, indent=1)


def test_json_pages(spark, tmp_path):
    (tmp_path / "p1.json").write_text(page({"id": 1, "who": {"name": "a", "home": {"city": "x"}}, "tags": ["t"]}, {"id": 2}))
    (tmp_path / "p2.json").write_text(page({"id": 3, "extra": True}))
    (tmp_path / "p3.json").write_text(page())
    rows = read_json_pages(spark, str(tmp_path), RECORD)
    assert rows.columns == ["id", "who.name", "who.home.city", "tags"]
    assert sorted(rows_of(rows), key=str) == [(1, "a", "x", ["t"]), (2, None, None, None), (3, None, None, None)]


def test_json_pages_as_lines(spark, tmp_path):
    lines = "\n".join(page({"id": n}).replace("\n", "") for n in range(3))
    (tmp_path / "pages.json").write_text(lines)
    rows = read_json_pages(spark, str(tmp_path), RECORD, document_per_file=False)
    assert sorted(r[0] for r in rows_of(rows)) == [0, 1, 2]


def test_day_shards(spark, tmp_path):
    for day in ("20240101", "20240102", "20240103", "intraday_20240103"):
        session_frame(spark, [session(visitor=day, hits=[hit(1)])]).write.parquet(f"{tmp_path}/ga_sessions_{day}")
    session_frame(spark, [session(visitor="other")]).write.parquet(f"{tmp_path}/other_20240101")

    def visitors(*bounds):
        return sorted(r[0] for r in rows_of(read_shards(spark, str(tmp_path), "ga_sessions_", schemas.SESSIONS, *bounds).select("fullVisitorId")))

    assert visitors() == ["20240101", "20240102", "20240103", "intraday_20240103"]
    assert visitors(date(2024, 1, 2), date(2024, 1, 3)) == ["20240102", "20240103", "intraday_20240103"]
    assert visitors(date(2023, 12, 1), date(2024, 1, 1)) == ["20240101"]
    with pytest.raises(ValueError, match="both date bounds"):
        visitors(date(2024, 1, 2))


def test_table_names():
    assert table_name("t") == "t"
    assert table_name("t", None, "fallback") == "fallback.t"
    assert table_name("t", " marts ", "fallback") == "marts.t"


def test_tables_are_replaced_or_appended_to(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS marts")
    write_table(spark.range(3), "numbers", "marts")
    write_table(spark.range(2), "numbers", "marts")
    assert spark.table("marts.numbers").count() == 2
    write_table(spark.range(2), "numbers", default_schema="marts", mode="append")
    assert spark.table("marts.numbers").count() == 4
    publish_view(spark.range(7), "seven")
    assert spark.table("seven").count() == 7


def test_loads_of_several_sources_and_days_stay_apart(spark, tmp_path):
    path = str(tmp_path / "loads")

    def load(ids, source, day):
        load_run(spark.createDataFrame([(i, f"event day {i % 2}") for i in ids], "id int, day string"), path, source, day)

    load([1, 2], "lan", "d1")
    load([3], "gab", "d1")
    load([4, 5], "lan", "d2")
    load([6, 7], "lan", "d2")
    found = spark.read.parquet(path).select("id", "load_source", "load_day")
    expected = [(1, "lan", "d1"), (2, "lan", "d1"), (3, "gab", "d1"), (6, "lan", "d2"), (7, "lan", "d2")]
    assert sorted(rows_of(found)) == expected
    with pytest.raises(ValueError, match="load_day"):
        load_run(spark.read.parquet(path), path, "lan", "d3")


def test_loads_keep_local_days_that_share_a_utc_date(spark, tmp_path):
    path = str(tmp_path / "loads")
    # Hours of two local days at +8; each spans two UTC dates.
    hours = spark.range(48).withColumn("at", F.timestamp_seconds(F.lit(1704038400) + F.col("id") * 3600))
    for n in (0, 1):
        load_run(hours.where(F.floor(F.col("id") / 24) == n), path, "lan", f"day {n}")
    assert spark.read.parquet(path).count() == 48


def test_clustered_files_cover_narrow_ranges(spark, tmp_path):
    path = str(tmp_path / "clustered")
    rows = spark.range(0, 4000, 1, 8).select(F.pmod(F.xxhash64("id"), F.lit(1000)).alias("k"), "id")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_files(rows, path, cluster_by=["k"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    back = spark.read.parquet(path)
    assert back.count() == 4000
    spans = back.groupBy(F.input_file_name()).agg((F.max("k") - F.min("k")).alias("span")).collect()
    assert len(spans) > 4 and max(r.span for r in spans) < 300


def test_a_clustered_write_spreads_one_hot_value(spark, tmp_path):
    path = str(tmp_path / "hot")
    rows = spark.range(0, 8000, 1, 8).select(F.lit("same").alias("k"), "id")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_files(rows, path, cluster_by=["k"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    counts = [r["count"] for r in spark.read.parquet(path).groupBy(F.input_file_name()).count().collect()]
    assert sum(counts) == 8000 and max(counts) < 3000


def test_journey_table_layout(spark):
    sessions = session_frame(spark, [session(f"v{n}", n, brand=("01", "07")[n % 2]) for n in range(6)])
    hits = tracking.branded_hits(sessions)
    tracking.write_hits(hits, "hits_of_all")
    report = journey.customer_journey(
        spark.table("hits_of_all"), small_table(spark, MEDIUM_GROUPS, schemas.MEDIUM_LOOKUP)
    )
    journey.write_journey(report, "journeys")
    stored = spark.table("journeys")
    assert stored.count() == 6
    assert "PartitionFilters: [isnotnull(brand" in plan(stored.where("brand = '01'"))


def test_small_table_is_broadcast(spark):
    lookup = small_table(spark, MEDIUM_GROUPS, schemas.MEDIUM_LOOKUP)
    assert lookup.count() == 34 and lookup.select("utm_medium").distinct().count() == 34
    big = spark.range(10).select(F.col("id").cast("string").alias("utm_medium"))
    assert "BroadcastHashJoin" in plan(big.join(lookup, "utm_medium", "left"))


def test_scratch_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    one, other = scratch_folder(spark, "x"), scratch_folder(spark, "x")
    assert one != other and one.startswith(shared)

    # Without a shared folder, under the warehouse, whatever the master.
    settings = {"spark.master": "local[2]", "spark.sql.warehouse.dir": "/shared/warehouse"}
    bare = SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: settings.get(key, default)))
    assert scratch_folder(bare, "x").startswith("/shared/warehouse/_scratch/x-")


def test_tag_series(spark):
    series = spark.createDataFrame(
        [("a", date(2024, 1, 1), 5, False), ("b", date(2024, 1, 1), 6, True), ("c", date(2024, 1, 1), 7, True)],
        "keyword string, date date, value int, isPartial boolean",
    )
    wanted = small_table(spark, [("a", True), ("b", False)], schemas.KEYWORDS)
    at = datetime(2024, 1, 2, 8, tzinfo=timezone(timedelta(hours=8)))
    got = tag_series(series, wanted, at)
    assert got.columns == schemas.INTEREST.names
    assert sorted(rows_of(got.select("keyword", "hits", "is_luxe"))) == [("a", 5, True), ("b", 6, False)]
    assert rows_of(got.select(F.unix_seconds("updated_datetime")).distinct()) == [(1704153600,)]
    with pytest.raises(ValueError, match="time zone"):
        tag_series(series, wanted, datetime(2024, 1, 2))


def test_landed_files_are_appended_once(spark, tmp_path):
    landing, target, progress = tmp_path / "landing", str(tmp_path / "target"), str(tmp_path / "progress")

    def run():
        append_new(landed_csv(spark, str(landing), schemas.BEACON), target, progress).awaitTermination()
        return spark.read.parquet(target).count()

    csv_file(landing, name="one.csv")
    assert run() == 2
    assert run() == 2
    csv_file(landing, name="two.csv")
    assert run() == 4


def test_landed_pages_are_appended_once(spark, tmp_path):
    landing, target, progress = tmp_path / "pages", str(tmp_path / "target"), str(tmp_path / "progress")
    landing.mkdir()
    for n in range(2):
        (landing / f"p{n}.json").write_text(page({"id": n, "who": {"name": "a"}}))
        rows = landed_json_pages(spark, str(landing), RECORD).withColumnsRenamed({"who.name": "name", "who.home.city": "city"})
        append_new(rows, target, progress).awaitTermination()
        assert spark.read.parquet(target).count() == n + 1


def failing(rows):
    """Fails on the last of the rows, when others are written."""
    last = rows.agg(F.max("id")).first()[0]
    return rows.withColumn("id", F.when(F.col("id") == last, F.raise_error(F.lit("broken off"))).otherwise(F.col("id")))


def ids(frame):
    return sorted(r[0] for r in rows_of(frame.select("id")))


def test_shards_by_suffix(spark, tmp_path):
    days = ("20240101", "20240102", "20240105", "intraday_20240105")
    for n, day in enumerate(days):
        session_frame(spark, [session(visitor=f"v{n}")]).write.parquet(f"{tmp_path}/ga_sessions_{day}")
    session_frame(spark, [session(visitor="other")]).write.parquet(f"{tmp_path}/other_20240101")

    def scan(**bounds):
        return scan_shards(spark, str(tmp_path), "ga_sessions_", schemas.SESSIONS, **bounds)

    def found(frame):
        return sorted(rows_of(frame.select("fullVisitorId", SUFFIX)))

    every = [(f"v{n}", day) for n, day in enumerate(days)]
    assert found(scan()) == every
    assert found(scan(first="20240102")) == every[1:]
    assert found(scan(last="20240102")) == every[:2]
    assert found(scan(first="20240102", last="20240131")) == every[1:3]
    assert scan(first="z").count() == 0 and scan(first="z").columns == [*schemas.SESSIONS.names, SUFFIX]
    # Bounds list their shards only; a filter on the column reads their files only.
    assert len(scan(first="20240105").inputFiles()) == sum("20240105" in f for f in scan().inputFiles())
    pruned = scan().where(F.col(SUFFIX) >= "20240105")
    pruned.collect()
    assert found(pruned) == every[2:]
    scans = pruned._jdf.queryExecution().executedPlan().collectLeaves()
    assert scans.apply(0).metrics().get("numFiles").get().value() < len(scan().inputFiles())


def test_published_loads(spark, tmp_path):
    path = str(tmp_path / "loads")

    def load(numbers, source, day="2024-01-01", schema="id int, brand string"):
        publish_load(spark.createDataFrame([(n, "01") for n in numbers], schema), path, source, day)

    with pytest.raises(ValueError, match="nothing is published"):
        published_loads(spark, path)
    load([1, 2], "07")
    load([3], "7")
    load([4], "15")
    load([5, 6], "07", "2024-01-02")
    loads = published_loads(spark, path)
    assert dict(loads.dtypes)["load_source"] == dict(loads.dtypes)["load_day"] == "string"
    keys = "id", "load_source", "load_day"
    assert sorted(rows_of(loads.select(*keys))) == [
        (1, "07", "2024-01-01"), (2, "07", "2024-01-01"), (3, "7", "2024-01-01"), (4, "15", "2024-01-01"),
        (5, "07", "2024-01-02"), (6, "07", "2024-01-02"),
    ]
    assert ids(published_loads(spark, path, sources=["07"], days=["2024-01-02"])) == [5, 6]
    # A repeat replaces, by no rows too; the other loads stay.
    load([7], "07", "2024-01-02")
    load([], "15")
    assert ids(published_loads(spark, path)) == [1, 2, 3, 7]
    # Half a load is never seen, and the former rows are.
    with pytest.raises(Exception, match="broken off"):
        publish_load(failing(spark.range(100, 200).withColumn("brand", F.lit("01"))), path, "07", "2024-01-02")
    assert ids(published_loads(spark, path)) == [1, 2, 3, 7]
    # Readers that began before a repeat keep their rows until a sweep.
    before = published_loads(spark, path)
    load([8], "7")
    assert ids(before) == [1, 2, 3, 7]
    assert sweep(spark, path) == []
    assert len(sweep(spark, path, older_than_hours=0)) == 4 and sweep(spark, path, older_than_hours=0) == []
    assert ids(published_loads(spark, path)) == [1, 2, 7, 8]
    # Later columns are NULL in earlier loads.
    load([9], "16", schema="id int, store string")
    assert published_loads(spark, path).where("store IS NULL").count() == 4
    with pytest.raises(ValueError, match="load_day"):
        publish_load(published_loads(spark, path), path, "07", "d")
    with pytest.raises(TypeError, match="text"):
        publish_load(spark.range(1), path, 7, "d")


def test_files_are_replaced_whole(spark, tmp_path):
    path = str(tmp_path / "files")
    replace_files(spark.range(5), path)
    replace_files(current_files(spark, path).where("id > 1"), path)
    assert ids(current_files(spark, path)) == [2, 3, 4]
    with pytest.raises(Exception, match="broken off"):
        replace_files(failing(current_files(spark, path)), path)
    assert ids(current_files(spark, path)) == [2, 3, 4]
    replace_files(spark.range(6).withColumn("k", F.col("id") % 2), path, partition_by=["k"])
    assert sorted(rows_of(current_files(spark, path))) == [(i, i % 2) for i in range(6)]


def test_a_table_is_replaced_whole(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS aside")

    def tables():
        return {r.tableName for r in spark.sql("SHOW TABLES IN aside").collect() if r.tableName.startswith("t")}

    write_table(spark.range(3), "t", "aside")
    began = spark.table("aside.t")
    with pytest.raises(Exception, match="broken off"):
        write_table(failing(spark.range(50)), "t", "aside")
    assert ids(spark.table("aside.t")) == [0, 1, 2] and len(tables()) == 2
    # From its own rows, and with other columns.
    write_table(spark.table("aside.t").where("id > 0").withColumn("k", F.lit("x")), "t", "aside", partition_by=["k"])
    assert rows_of(spark.table("aside.t").orderBy("id")) == [(1, "x"), (2, "x")]
    assert ids(began) == [0, 1, 2]
    write_table(spark.range(9, 10), "t", "aside")
    write_table(spark.range(10, 11), "t", "aside", mode="append")
    assert ids(spark.table("aside.t")) == [9, 10]
    # The current and the former rows are kept, no others.
    assert len(tables()) == 3
    drop_table(spark, "t", "aside")
    assert tables() == set()
    # A table that came from elsewhere.
    spark.range(2).write.saveAsTable("aside.t")
    write_table(spark.range(4), "t", "aside", mode="append")
    write_table(spark.range(7), "t", "aside")
    assert spark.table("aside.t").count() == 7 and len(tables()) == 3
    drop_table(spark, "t", "aside")
    assert tables() == set()


@pytest.mark.parametrize("merged", ["true", "false"])
def test_a_clustered_write_computes_its_rows_once(spark, tmp_path, merged):
    computed = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def counted(n):
        computed.add(1)
        return n * 7919 % 1000

    rows = spark.range(0, 3000, 1, 6).select(counted("id").alias("k"), "id", F.lit("x").alias("part"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", merged)
    try:
        write_files(rows, str(tmp_path / "once"), cluster_by=["k"], partition_by=["part"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert computed.value == 3000
    assert spark.read.parquet(str(tmp_path / "once")).count() == 3000


def test_ranges_order_all_kinds_of_columns(spark):
    chance_rows = [(None if n % 11 == 0 else f"ü{n % 7}", None if n % 5 == 0 else n % 3 == 0, datetime(2024, 1, 1) + timedelta(hours=n * 37 % 101), n) for n in range(700)]
    rows = spark.createDataFrame(chance_rows, "a string, b boolean, c timestamp_ntz, n int").repartition(5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        with in_ranges(rows, ["a", "b", "c"]) as ordered:
            parts = ordered.withColumn("p", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id()).orderBy("at").collect()
        with in_ranges(rows.limit(0), ["a"]) as none:
            assert none.count() == 0
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")

    def key(r):
        return [(v is not None, v) for v in (r.a, r.b, r.c)]

    assert len(parts) == 700 and len({r.p for r in parts}) == 8
    assert all(key(x) <= key(y) for x, y in zip(parts, parts[1:], strict=False))
    sizes = [sum(r.p == p for r in parts) for p in range(8)]
    assert max(sizes) < 2 * 700 / 8

def test_a_clustered_write_has_ranges_for_all_bytes(spark):
    """However few partitions a shuffle starts with, no range is over the advised size."""
    advised = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(advised)
    spark.conf.set(advised, "1m")
    try:
        assert layout.range_count(spark, 1000 << 20) == 1000 * layout.SHUFFLED
        assert layout.range_count(spark, 1) == 1
    finally:
        spark.conf.set(advised, before)


def test_a_task_hands_on_its_share_of_the_sample(spark):
    rows = spark.range(0, 400_000, 1, 40)
    met = layout.sampled(rows, F.col("id"), 20, 400_000).groupBy(F.spark_partition_id()).count().collect()
    assert 1500 < sum(r["count"] for r in met) < 2500 and max(r["count"] for r in met) < 200
