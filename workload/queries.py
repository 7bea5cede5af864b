"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame``."""

from collections.abc import Callable, Sequence
from datetime import date
from functools import reduce
from zlib import crc32

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trailmark import schemas
from trailmark.fixed_values import (
    ACCOUNT_PREFIXES,
    BEACON_BRANDS,
    BEACON_EVENT_TYPES,
    BEACON_UID_LENGTH,
    BRAND_ID_KEYS,
    JOURNEY_CHANNELS,
    SEARCH_SLOTS,
    TREND_HORIZONS,
)
from trailmark.functions import (
    civil_date,
    classify_prefix,
    epoch_to_civil,
    joined_key,
    kv_lookup,
    micros,
    round_to_long,
    split_field,
    utc_date,
)
from trailmark.operators import checks, slopes
from trailmark.operators.attach import full_outer_report
from trailmark.operators.facets import Facet, Total, facet_report
from trailmark.operators.hits import HIT_FIELDS, SESSION_STRUCTS, hit_ids, repack, unnest_hits
from trailmark.operators.identity import fill_identity, first_day_flag, stitch_identity
from trailmark.operators.setops import union_all, union_distinct
from trailmark.operators.snapshots import latest_snapshot
from trailmark.plans import ads, journey, site, tracking, trends
from trailmark.plans.beacon import beacon_checks, beacon_stage
from trailmark.plans.sales import brand_sales
from trailmark.sources import (
    LOAD_KEYS,
    SUFFIX,
    current_files,
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
    table_name,
    write_files,
    write_table,
)
from trailmark.streaming.landing import append_new, landed_csv
from workload import adapters as inputs

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

HORIZON_DAYS = {name: days for name, (days, _) in TREND_HORIZONS.items()}
HORIZON_WEIGHTS = {name: weight for name, (_, weight) in TREND_HORIZONS.items()}


def query(function: Query) -> Query:
    """Register a query; "_query" only keeps its name apart from a library function's."""
    QUERIES[function.__name__.removesuffix("_query")] = function
    return function


def rounded(frame: DataFrame, names: Sequence[str], digits: int) -> DataFrame:
    return frame.withColumns({n: F.round(F.col(n), digits) for n in names})


def civil_utc(instant: Column) -> Column:
    """An instant as civil UTC time, to compare without a zone."""
    return epoch_to_civil(F.unix_micros(instant), "us")


# ---- session hits ----------------------------------------------------------------


def flat(spark: SparkSession, sf_dir: str, hit_fields: Sequence[str] = HIT_FIELDS) -> DataFrame:
    return tracking.branded_hits(inputs.sessions(spark, sf_dir), hit_fields=hit_fields)


def visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tracking.branded_visits(inputs.sessions(spark, sf_dir))


def anonymous(
    spark: SparkSession, sf_dir: str, hit_fields: Sequence[str] = ("hitNumber", "eventInfo")
) -> DataFrame:
    """Hits without member ids, for reports that do not use them."""
    return tracking.branded_hits(inputs.sessions(spark, sf_dir), identify=False, hit_fields=hit_fields)


def scalars(hits: DataFrame) -> DataFrame:
    """Flattened hits with the nested fields as columns."""
    nested = {
        "totals": SESSION_STRUCTS["totals"],
        "trafficSource": ("campaign", "source", "medium"),
        "device": ("browser", "operatingSystem", "isMobile", "deviceCategory"),
        "geoNetwork": ("country", "city"),
        "hit": ("type", "hitNumber", "hitDateTime", "isInteraction", "isEntrance", "isExit"),
    }
    names = {"hits": "totals_hits"}
    return hits.select(
        *hits.columns[:9],
        *[F.col(f"{s}.{f}").alias(names.get(f, f)) for s, fields in nested.items() for f in fields],
        F.col("hit.page.pagePath").alias("pagePath"),
        F.col("hit.product")[0]["productSKU"].alias("productSKU"),
        F.col("hit.contentGroup.contentGroup1").alias("contentGroup1"),
        *[F.col(f"hit.eventInfo.{f}").alias(f) for f in ("eventCategory", "eventAction", "eventLabel")],
    )


@query
def flat_hits(spark, sf_dir):
    return scalars(flat(spark, sf_dir))


@query
def union_all_brands(spark, sf_dir):
    """The same from a session table per brand."""
    all_sessions = inputs.sessions(spark, sf_dir)
    by_brand = {code: all_sessions.where(F.col("brand") == code).drop("brand") for code in BRAND_ID_KEYS}
    hits = tracking.all_hits(by_brand)
    return hits.select(
        "brand", "marsId", "sessionId", F.col("hit.hitNumber").alias("hitNumber"), "visitStartDateTime"
    )


@query
def shard_scan(spark, sf_dir):
    """Sessions kept in a folder per day, read back by wildcard."""
    root = scratch_folder(spark, "shards")
    sharded = inputs.sessions(spark, sf_dir).withColumn("sessions_of", F.col("date"))
    write_files(sharded, root, partition_by=["sessions_of"])
    stored = read_shards(spark, root, "sessions_of=", inputs.BRANDED_SESSIONS)
    return stored.select("brand", "date", "visitId", "visitNumber", F.size("hits").alias("hits"))


@query
def shard_scan_bounded(spark, sf_dir):
    """The shards of ten days only."""
    root = scratch_folder(spark, "shards")
    sharded = inputs.sessions(spark, sf_dir).withColumn("sessions_of", F.col("date"))
    write_files(sharded, root, partition_by=["sessions_of"])
    stored = read_shards(
        spark, root, "sessions_of=", inputs.BRANDED_SESSIONS, date(2024, 1, 5), date(2024, 1, 14)
    )
    return stored.select("brand", "date", "visitId", F.size("hits").alias("hits"))


@query
def shard_scan_from(spark, sf_dir):
    """The shards from a day on, with the day as a column; some of them by a filter on the column."""
    root = scratch_folder(spark, "shards")
    sharded = inputs.sessions(spark, sf_dir).withColumn("sessions_of", F.col("date"))
    write_files(sharded, root, partition_by=["sessions_of"])
    stored = scan_shards(spark, root, "sessions_of=", inputs.BRANDED_SESSIONS, first="20240105")
    found = stored.where(F.col(SUFFIX) != "20240110")
    return found.select("brand", "date", "visitId", F.size("hits").alias("hits"), F.col(SUFFIX).alias("shard"))


@query
def unnest_hits_query(spark, sf_dir):
    hits = unnest_hits(inputs.sessions(spark, sf_dir), ["hitNumber", "eventInfo"])
    return hits.select(
        "visitId",
        F.col("hit.hitNumber").alias("hitNumber"),
        F.col("hit.eventInfo.eventCategory").alias("eventCategory"),
        F.col("hit.eventInfo.eventAction").alias("eventAction"),
    )


def _dimension_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unnest_hits(inputs.sessions(spark, sf_dir), ["hitNumber", "customDimensions"])


@query
def kv_lookup_query(spark, sf_dir):
    pairs = F.col("hit.customDimensions")
    return _dimension_hits(spark, sf_dir).select(
        "visitId",
        F.col("hit.hitNumber").alias("hitNumber"),
        kv_lookup(pairs, [178]).alias("key_178"),
        kv_lookup(pairs, [10]).alias("key_10"),
    )


@query
def kv_lookup_fallback(spark, sf_dir):
    return _dimension_hits(spark, sf_dir).select(
        "visitId",
        F.col("hit.hitNumber").alias("hitNumber"),
        kv_lookup(F.col("hit.customDimensions"), [182, 178]).alias("key"),
    )


@query
def struct_repack(spark, sf_dir):
    packed = inputs.sessions(spark, sf_dir).select(
        "visitId", *[repack(name, fields) for name, fields in SESSION_STRUCTS.items()]
    )
    return packed.select(
        "visitId",
        *[F.col(f"totals.{f}").alias(f) for f in SESSION_STRUCTS["totals"]],
        F.col("trafficSource.medium").alias("medium"),
        F.col("device.browser").alias("browser"),
        F.col("geoNetwork.city").alias("city"),
    )


@query
def epoch_to_local(spark, sf_dir):
    start = epoch_to_civil(F.col("visitStartTime"), "s", 8)
    return inputs.sessions(spark, sf_dir).select(
        "visitId", start.alias("visitStartDateTime"), civil_date(start).alias("local_date")
    )


@query
def epoch_ms_to_local(spark, sf_dir):
    hits = unnest_hits(inputs.sessions(spark, sf_dir), ["hitNumber", "time"])
    at = epoch_to_civil(F.col("visitStartTime") * 1000 + F.col("hit.time"), "ms", 8)
    return hits.select("visitId", F.col("hit.hitNumber").alias("hitNumber"), at.alias("hitDateTime"))


@query
def identity_fill(spark, sf_dir):
    own = hit_ids(inputs.sessions(spark, sf_dir), BRAND_ID_KEYS)
    order = ["visitNumber", "hitNumber"]
    return fill_identity(own, "marsId", ["brand", "fullVisitorId"], order, spread_by=["fullVisitorId", *order])


@query
def identity_stitch(spark, sf_dir):
    hits = flat(spark, sf_dir, ("hitNumber",)).select(
        "brand", "marsId", "sessionId", "fullVisitorId", "visitStartDateTime",
        F.col("hit.hitNumber").alias("hitNumber"),
    )
    seen = visits(spark, sf_dir)
    return stitch_identity(hits, "marsId", "fullVisitorId", "visitStartDateTime", ["sessionId"], seen)


@query
def first_day_flag_query(spark, sf_dir):
    hits = flat(spark, sf_dir, ("hitNumber",)).select(
        "marsId", "sessionId", "visitStartDateTime", F.col("hit.hitNumber").alias("hitNumber")
    )
    seen = visits(spark, sf_dir)
    return first_day_flag(hits, "marsId", "visitStartDateTime", spread_by=["sessionId"], seen=seen)


@query
def lookup_left_join(spark, sf_dir):
    hits = journey.with_medium_group(anonymous(spark, sf_dir), inputs.mediums(spark))
    return hits.select(
        "sessionId",
        F.col("hit.hitNumber").alias("hitNumber"),
        F.col("trafficSource.medium").alias("medium"),
        "mediumGrouping",
    )


@query
def visit_filter(spark, sf_dir):
    hits = anonymous(spark, sf_dir).where(F.col("totals.visits") == 1)
    return hits.groupBy("brand").agg(F.count("*").alias("hits"), F.max("visitNumber").alias("last_visit"))


def _local_day() -> Column:
    return civil_date(F.col("visitStartDateTime")).alias("date")


@query
def bool_or_flag(spark, sf_dir):
    return anonymous(spark, sf_dir).groupBy("brand", _local_day()).agg(F.bool_or("isNewVisit").alias("isNewVisit"))


def _brand_day() -> dict[str, Column]:
    return {"brand": F.col("brand"), "date": civil_date(F.col("visitStartDateTime"))}


@query
def cond_distinct(spark, sf_dir):
    category = F.col("hit.eventInfo.eventCategory")
    shop = {
        "sessions": None,
        "visit_sessions": F.col("totals.visits") == 1,
        "shade_sessions": F.lower(category).contains("shade-finder"),
        "try_on_sessions": category.contains("virtual try on"),
    }
    visitors = {"users": None, "new_users": F.col("visitNumber") == 1}
    return facet_report(
        anonymous(spark, sf_dir),
        _brand_day(),
        [Facet(F.col("sessionId"), shop), Facet(F.col("fullVisitorId"), visitors)],
    )


@query
def cond_sum(spark, sf_dir):
    """The two kinds of conditional sum: NULL or 0 when nothing qualifies."""
    time = F.col("totals.timeOnSite")
    direct = F.col("channelGrouping") == "Direct"
    return anonymous(spark, sf_dir).groupBy("brand", "sessionId").agg(
        F.sum(F.when(direct, time)).alias("or_null"),
        F.sum(F.when(direct, time).otherwise(0)).alias("or_zero"),
    )


@query
def composite_distinct(spark, sf_dir):
    events = Facet(site.event_key(), {"unique_events": None})
    return facet_report(anonymous(spark, sf_dir), _brand_day(), [events])


@query
def apportioned_totals(spark, sf_dir):
    names = ("timeOnSite", "pageviews", "hits")
    session = Facet(F.col("sessionId"), totals={n: Total(n) for n in names})
    measures = {n: F.col(f"totals.{n}") for n in names}
    totals = facet_report(
        anonymous(spark, sf_dir), {"sessionId": F.col("sessionId")}, [session], measures, divisor=F.col(site.HITS)
    )
    return rounded(totals, names, 0)


@query
def ratio_metrics(spark, sf_dir):
    return site.site_metrics(anonymous(spark, sf_dir, site.SITE_HIT_FIELDS))


@query
def pivot_sessions(spark, sf_dir):
    channel = F.col("channelGrouping")
    report = facet_report(
        flat(spark, sf_dir, ("eventInfo",)),
        {"brand": F.col("brand"), "marsId": F.col("marsId"), "date": civil_date(F.col("visitStartDateTime"))},
        [
            Facet(
                F.col("sessionId"),
                {"sessions": None}
                | {f"{n}_sessions": channel == v for n, v in JOURNEY_CHANNELS.items()}
                | journey.event_predicates(),
            ),
            Facet(
                channel,
                {"channels": None},
                {f"{n}_browsing_time": Total("time", v) for n, v in JOURNEY_CHANNELS.items()},
            ),
        ],
        {"time": F.col("totals.timeOnSite")},
        divisor=F.col(site.HITS),
    )
    return rounded(report, [f"{n}_browsing_time" for n in JOURNEY_CHANNELS], 0)


@query
def customer_journey(spark, sf_dir):
    hits = flat(spark, sf_dir, journey.JOURNEY_HIT_FIELDS)
    return journey.customer_journey(hits, inputs.mediums(spark), visits(spark, sf_dir))


# ---- ads -------------------------------------------------------------------------


@query
def prefix_classifier(spark, sf_dir):
    names = reduce(DataFrame.union, inputs.customers(spark, sf_dir)).groupBy("AccountDescriptiveName").count()
    return names.select(
        "AccountDescriptiveName",
        classify_prefix(F.col("AccountDescriptiveName"), ACCOUNT_PREFIXES).alias("brand"),
        "count",
    )


@query
def account_click_join(spark, sf_dir):
    return site.ad_clicks(inputs.basic_stats(spark, sf_dir), inputs.customers(spark, sf_dir))


@query
def full_outer_daily(spark, sf_dir):
    hits = anonymous(spark, sf_dir).groupBy("brand", _local_day()).agg(F.count("*").alias("hits"))
    clicks = site.ad_clicks(inputs.basic_stats(spark, sf_dir), inputs.customers(spark, sf_dir))
    return full_outer_report(clicks, hits, ["brand", "date"])


@query
def daily_report(spark, sf_dir):
    return site.daily_report(
        anonymous(spark, sf_dir, site.SITE_HIT_FIELDS), inputs.basic_stats(spark, sf_dir), inputs.customers(spark, sf_dir)
    )


@query
def latest_snapshot_query(spark, sf_dir):
    """The latest row of each account in each of the two tables."""
    tables = [rows.withColumn("held_by", F.lit(no)) for no, rows in enumerate(inputs.customers(spark, sf_dir))]
    return latest_snapshot(union_all(tables), ["held_by", "ExternalCustomerId"])


@query
def union_distinct_query(spark, sf_dir):
    return union_distinct(inputs.basic_stats(spark, sf_dir))


@query
def micros_to_units(spark, sf_dir):
    return union_distinct(inputs.basic_stats(spark, sf_dir)).select(
        "Date", "ExternalCustomerId", "CampaignId", micros(F.col("Cost")).alias("cost")
    )


@query
def rounding_cast(spark, sf_dir):
    stats = union_distinct(inputs.campaign_stats(spark, sf_dir))
    total = F.sum("CurrentModelAttributedConversions")
    return stats.groupBy("Date", "CampaignId").agg(
        round_to_long(total).alias("conversions"), total.alias("exact")
    )


@query
def in_list_ratio(spark, sf_dir):
    stats = union_distinct(inputs.basic_stats(spark, sf_dir))
    searched = F.sum(F.when(F.col("Slot").isin(*SEARCH_SLOTS), F.col("Impressions")))
    return stats.groupBy("CampaignId", "Date").agg(
        searched.alias("searched"), ads.top_impression_ratio().alias("top_ratio")
    )


def _ongoing(spark: SparkSession, sf_dir: str, ordered: bool) -> DataFrame:
    return ads.ads_ongoing(
        inputs.campaigns(spark, sf_dir),
        inputs.customers(spark, sf_dir),
        inputs.campaign_stats(spark, sf_dir),
        inputs.basic_stats(spark, sf_dir),
        inputs.cookie_stats(spark, sf_dir),
        ordered,
    )


@query
def star_join(spark, sf_dir):
    rows = _ongoing(spark, sf_dir, ordered=False)
    return rows.groupBy("Account", "Campaign_name").agg(
        F.count("*").alias("rows"), F.sum("Clicks").alias("clicks"), F.sum("Conversions").alias("conversions")
    )


@query
def ads_ongoing(spark, sf_dir):
    return _ongoing(spark, sf_dir, ordered=True)


@query
def ads_combined(spark, sf_dir):
    return ads.ads_combined(_ongoing(spark, sf_dir, ordered=False), inputs.ads_history(spark, sf_dir))


# ---- search interest -------------------------------------------------------------


@query
def keyword_tagging(spark, sf_dir):
    stamp = civil_utc(F.col("updated_datetime"))
    return inputs.interest(spark, sf_dir).withColumn("updated_datetime", stamp)


@query
def date_window_filter(spark, sf_dir):
    recent = slopes.within_days(F.col("date"), utc_date(F.col("updated_datetime")), HORIZON_DAYS["slope_6m"])
    return inputs.interest(spark, sf_dir).where(recent).select("keyword", "date", "hits")


def _points(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = inputs.interest(spark, sf_dir).select(
        F.col("keyword").alias("key"),
        F.col("date").alias("day"),
        utc_date(F.col("updated_datetime")).alias("as_of"),
        F.col("hits").alias("y"),
    )
    return slopes.recent_points(points, HORIZON_DAYS)


@query
def sequence_number(spark, sf_dir):
    return slopes.numbered(_points(spark, sf_dir)).select(
        "horizon", F.col("key").alias("keyword"), F.col("day").alias("date"), (F.col("before") + 1).alias("x")
    )


@query
def global_mean(spark, sf_dir):
    each = slopes.series_sums(_points(spark, sf_dir))
    sums = slopes.with_means(each, slopes.pooled_means(each))
    means = sums.select("horizon", F.col("key").alias("keyword"), "x_bar", "y_bar")
    return rounded(means, ["x_bar", "y_bar"], 6)


@query
def pooled_slope(spark, sf_dir):
    return rounded(trends.trend_slopes(inputs.interest(spark, sf_dir)), list(HORIZON_DAYS), 6)


@query
def slope_score(spark, sf_dir):
    scored = trends.trend_slopes(inputs.interest(spark, sf_dir)).select(
        "keyword", slopes.weighted_score(HORIZON_WEIGHTS).alias("score")
    )
    return rounded(scored, ["score"], 6)


@query
def trend_report(spark, sf_dir):
    report = trends.trend_report(inputs.interest(spark, sf_dir))
    report = report.withColumn("updated_datetime", civil_utc(F.col("updated_datetime")))
    return rounded(report, [*HORIZON_DAYS, "score"], 6)


# ---- beacon and sales ------------------------------------------------------------


@query
def split_fields(spark, sf_dir):
    name = F.col("event_name")
    return inputs.beacon(spark, sf_dir).select(
        "event_name",
        split_field(name, "_", 0).alias("event"),
        split_field(name, "_", 1).alias("store"),
        split_field(name, "_", 2, strict=False).alias("rest"),
    )


@query
def beacon_stage_query(spark, sf_dir):
    return beacon_stage(inputs.beacon(spark, sf_dir))


@query
def brand_sales_query(spark, sf_dir):
    return brand_sales(inputs.sales(spark, sf_dir))


def _beacon_values(frame: DataFrame) -> DataFrame:
    """Beacon rows with instants as civil UTC time."""
    instants = {n: civil_utc(F.col(n)) for n in ("event_time", "first_follow")}
    return frame.select(*schemas.BEACON.names).withColumns(instants)


def _write_csv(rows: DataFrame, path: str) -> str:
    # Quotes are doubled, as the reader takes them.
    writer = rows.write.option("escape", '"')
    writer = writer.option("header", True).option("timestampFormat", "yyyy-MM-dd HH:mm:ss.SSSSSSXXX")
    writer.csv(path)
    return path


@query
def csv_load(spark, sf_dir):
    path = _write_csv(inputs.beacon(spark, sf_dir), scratch_folder(spark, "beacon-csv"))
    return _beacon_values(read_csv_positional(spark, path, schemas.BEACON, quoted_newlines=False))


@query
def csv_bom_load(spark, sf_dir):
    """Files that start with a byte order mark and have newlines and quotes in quoted fields."""
    name = F.concat(F.lit('"'), "event_type", F.lit('"\n'), "event_name")
    rows = inputs.beacon(spark, sf_dir).withColumn("event_name", name)
    path = _write_csv(rows.withColumnRenamed("event_name", "\ufeffevent_name"), scratch_folder(spark, "bom-csv"))
    return _beacon_values(read_csv_positional(spark, path, schemas.BEACON))


@query
def seed_load(spark, sf_dir):
    """A lookup kept as CSV, every column read as text, whatever it looks like."""
    parts = inputs.table(spark, sf_dir, "part")
    rows = parts.select(F.lpad(F.col("p_partkey").cast("string"), 12, "0").alias("code"), "p_brand", "p_size")
    path = _write_csv(rows, scratch_folder(spark, "seed"))
    return read_csv_positional(spark, path, schemas.texts("code brand size"), quoted_newlines=False)


@query
def catalog_table(spark, sf_dir):
    """A table in a named schema, replaced once, and a view over it."""
    spark.sql("CREATE SCHEMA IF NOT EXISTS marts")
    # One table for each input, so that calls leave no others behind.
    name = f"interest_{crc32(sf_dir.encode()):08x}"
    for _ in range(2):
        write_table(inputs.interest(spark, sf_dir), name, schema=" marts ", default_schema="default")
    publish_view(spark.table(table_name(name, "marts")).where(F.col("is_luxe")), f"luxe_{name}")
    return spark.table(f"luxe_{name}").select("keyword", "date", "hits")


@query
def json_pages_flatten(spark, sf_dir):
    """Pages of 1,000 events, each a nested record, landed as one document per line."""
    record = F.struct("event_id", F.struct("user_id", "k").alias("who"), "event_type")
    pages = (
        inputs.events(spark, sf_dir)
        .groupBy(F.floor(F.col("event_id") / 1000).alias("page"))
        .agg(F.collect_list(record).alias("records"))
        .select(F.struct(F.array(F.struct("records")).alias("data")).alias("response"))
    )
    path = scratch_folder(spark, "pages")
    pages.select(F.to_json("response").alias("value")).write.text(path)
    schema = schemas.record(
        event_id=schemas.BIGINT,
        who=schemas.record(user_id=schemas.BIGINT, k=schemas.BIGINT),
        event_type=schemas.STRING,
    )
    records = read_json_pages(spark, path, schema, document_per_file=False)
    return records.withColumnsRenamed({"who.user_id": "who_user_id", "who.k": "who_k"})


@query
def append_by_day(spark, sf_dir):
    """Loads of three sources on two days into one table, one of them repeated.

    A load's local day at +8 spans two UTC dates of events, of which the next load holds the
    rest, and all sources load the same days.
    """
    rows = inputs.beacon(spark, sf_dir)
    path = scratch_folder(spark, "beacon-loads")
    source = F.when(F.col("brand_id") == "01", "lan").when(F.col("brand_id") == "16", "gab").otherwise("shu")
    later = civil_date(epoch_to_civil(F.unix_micros("event_time"), "us", 8)) >= F.lit("2024-01-15").cast("date")
    loads = [(code, day) for day in ("2024-01-14", "2024-01-15") for code in ("lan", "gab", "shu")]
    for code, day in [*loads, loads[-1]]:
        load_run(rows.where((source == code) & (later if day == "2024-01-15" else ~later)), path, code, day)
    loaded = spark.read.parquet(path)
    instants = {n: civil_utc(F.col(n)) for n in ("event_time", "first_follow")}
    return loaded.withColumns(instants | {n: F.col(n).cast("string") for n in LOAD_KEYS})


@query
def publish_loads(spark, sf_dir):
    """Loads of each brand on two days through a ledger. Of the second day's, one is repeated, one is
    repeated without rows, and one fails halfway.
    """
    rows = inputs.beacon(spark, sf_dir)
    path = scratch_folder(spark, "published-loads")
    later = civil_date(epoch_to_civil(F.unix_micros("event_time"), "us", 8)) >= F.lit("2024-01-15").cast("date")

    def load(code: str, day: str, check: Column | None = None) -> None:
        wanted = (F.col("brand_id") == code) & (later if day == "2024-01-15" else ~later)
        publish_load(rows.where(wanted if check is None else wanted & check), path, code, day)

    for day in ("2024-01-14", "2024-01-15"):
        for code in BEACON_BRANDS:
            load(code, day)
    load("07", "2024-01-15")
    load("15", "2024-01-15", F.lit(False))
    try:
        load("16", "2024-01-15", F.raise_error(F.lit("half a load")).cast("boolean"))
    except Exception as error:
        if "half a load" not in str(error):
            raise
    return published_loads(spark, path).withColumns({n: civil_utc(F.col(n)) for n in ("event_time", "first_follow")})


@query
def replace_aside(spark, sf_dir):
    """A set of files replaced by rows made from it, then by a write that fails."""
    path = scratch_folder(spark, "interest-files")
    replace_files(inputs.interest(spark, sf_dir), path)
    replace_files(current_files(spark, path).where(F.col("is_luxe")), path)
    try:
        replace_files(current_files(spark, path).withColumn("hits", F.raise_error(F.lit("half a write")).cast("int")), path)
    except Exception as error:
        if "half a write" not in str(error):
            raise
    stamp = civil_utc(F.col("updated_datetime"))
    return current_files(spark, path).withColumn("updated_datetime", stamp)


@query
def landed_append(spark, sf_dir):
    """Exactly-once append of landed CSV files; the second run finds nothing new."""
    landing = _write_csv(inputs.beacon(spark, sf_dir), scratch_folder(spark, "landing"))
    target, progress = scratch_folder(spark, "appended"), scratch_folder(spark, "progress")
    for _ in range(2):
        append_new(landed_csv(spark, landing, schemas.BEACON), target, progress).awaitTermination()
    return _beacon_values(spark.read.parquet(target))


@query
def replace_table(spark, sf_dir):
    rows = inputs.interest(spark, sf_dir)
    path = scratch_folder(spark, "interest")
    for _ in range(2):
        write_files(rows, path)
    stamp = civil_utc(F.col("updated_datetime"))
    return spark.read.parquet(path).withColumn("updated_datetime", stamp)


@query
def clustered_write(spark, sf_dir):
    path = scratch_folder(spark, "hits")
    write_files(flat(spark, sf_dir), path, cluster_by=tracking.HIT_LAYOUT)
    return scalars(spark.read.parquet(path))


# ---- checks ----------------------------------------------------------------------


@query
def check_unique(spark, sf_dir):
    key = joined_key(*[F.col(c) for c in ("event_name", "receiver_uid", "event_type", "event_time")])
    return checks.run_checks(inputs.faulty_beacon(spark, sf_dir), [checks.unique(key, "key", by_hash=True)])


@query
def beacon_check_list(spark, sf_dir):
    """All checks of the beacon table in one pass."""
    return checks.run_checks(inputs.faulty_beacon(spark, sf_dir), beacon_checks())


@query
def check_not_null(spark, sf_dir):
    columns = ("event_name", "receiver_uid", "brand_id")
    return checks.run_checks(inputs.faulty_beacon(spark, sf_dir), [checks.not_null(c) for c in columns])


@query
def check_accepted_values(spark, sf_dir):
    return checks.run_checks(
        inputs.faulty_beacon(spark, sf_dir),
        [
            checks.accepted_values("event_type", BEACON_EVENT_TYPES),
            checks.accepted_values("brand_id", BEACON_BRANDS),
        ],
    )


@query
def check_length(spark, sf_dir):
    return checks.run_checks(
        inputs.faulty_beacon(spark, sf_dir),
        [
            checks.value_lengths_to_equal("receiver_uid", BEACON_UID_LENGTH),
            checks.value_lengths_to_equal("receiver_uid", BEACON_UID_LENGTH, F.col("brand_id") == "07"),
        ],
    )


@query
def check_expression(spark, sf_dir):
    return checks.run_checks(
        inputs.faulty_beacon(spark, sf_dir),
        [
            checks.expression_is_true(F.col("event_start_at") < F.col("bind_date").cast("date"), "dates"),
            checks.expression_is_true(F.count("receiver_uid") == F.count("*"), "uids", group_by=["brand_id"]),
        ],
    )
