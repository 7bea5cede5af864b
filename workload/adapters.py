"""Inputs of the reports, derived from the test tables by Spark.

Each frame has the schema of ``trailmark.schemas``; ``workload.oracles`` states the same
derivations in SQL.
"""

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trailmark import schemas
from trailmark.fixed_values import BRAND_ID_KEYS, MEDIUM_GROUPS
from trailmark.operators.tagging import tag_series
from trailmark.sources import small_table

BRANDS = tuple(BRAND_ID_KEYS)
BRANDED_SESSIONS = schemas.record(brand=schemas.STRING, **{f.name: f.dataType for f in schemas.SESSIONS})

# A session is one visitor's events of a day within a block of consecutive event ids, so
# no hits array is longer than a block however active a visitor is.
BLOCK = 5000

CHANNELS = (
    "Affiliation", "Direct", "Display", "Email", "Organic Search", "Paid Search",
    "Referral", "Social & Influencer", "(Other)", None,
)
MEDIUMS = ("cpc", "ORGANIC", "referral", "influencer_orga", "Email_Brand", None, "zzz", "qrcode")
EVENTS = (
    ("Ecommerce", "Product Detail"),
    ("Ecommerce", "Product Impressions"),
    ("Ecommerce", "Promotion Impressions"),
    ("Ecommerce", "Product Click"),
    ("Ecommerce", "Promotion Click"),
    ("Ecommerce", "Add to Cart"),
    ("ecommerce", "add to favorites"),
    ("Ecommerce", "Checkout"),
    ("Ecommerce", "Purchase"),
    ("Video", "Play"),
    ("store locator", "find a store"),
    ("internal search", "display"),
    ("x virtual try on y", "start"),
    ("skin analysis::skindr", None),
    ("SHADE-Finder", "open"),
    ("ecommerce", "Add to Cart"),
    (None, "view"),
    ("Navigation", "click"),
)
ACCOUNT_NAMES = (
    "lpd_tw_lan_search", "lpd_tw_bio", "lpd_tw_hr_display", "lpd_tw_gio", "lpd_tw_shu",
    "lpd_tw_kls", "lpd_tw_ysl", "lpdXtw_lan", "agency",
)
SLOTS = {"A": "SearchTop", "N": "SearchOther", "R": "Content"}
# 24 years: ship dates of 1995-2001 become 2019-2025.
SHIFT_DAYS = 8766
INTEREST_RUN = datetime(2001, 8, 2, 4, 0, tzinfo=timezone(timedelta(hours=8)))
KEYWORDS = 31
# Every so many accounts and campaigns is not in the master tables.
UNKNOWN_ACCOUNTS, UNKNOWN_CAMPAIGNS, HOT_ACCOUNT = 11, 13, 1


NTZ, INT = schemas.T.TimestampNTZType(), schemas.T.IntegerType()
BIGINT, DOUBLE, STRING = schemas.BIGINT, schemas.DOUBLE, schemas.STRING
TABLES = {
    "events": schemas.record(
        event_id=BIGINT, ts=NTZ, user_id=BIGINT, event_type=STRING, value=DOUBLE, props=STRING
    ),
    "orders": schemas.record(
        o_orderkey=BIGINT,
        o_custkey=BIGINT,
        o_orderstatus=STRING,
        o_totalprice=DOUBLE,
        o_orderdate=NTZ,
        o_orderpriority=STRING,
    ),
    "lineitem": schemas.record(
        l_orderkey=BIGINT,
        l_partkey=BIGINT,
        l_suppkey=BIGINT,
        l_linenumber=INT,
        l_quantity=DOUBLE,
        l_extendedprice=DOUBLE,
        l_discount=DOUBLE,
        l_tax=DOUBLE,
        l_returnflag=STRING,
        l_linestatus=STRING,
        l_shipdate=NTZ,
    ),
    "supplier": schemas.record(s_suppkey=BIGINT, s_name=STRING, s_nationkey=INT, s_acctbal=DOUBLE),
    "part": schemas.record(
        p_partkey=BIGINT, p_name=STRING, p_brand=STRING, p_type=STRING, p_size=INT, p_retailprice=DOUBLE
    ),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table, with its schema stated so that Spark need not read it from the files."""
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def _text(value: str | None) -> str:
    return "CAST(NULL AS STRING)" if value is None else f"'{value}'"


def _pick(values: tuple, position: str) -> str:
    """The value at a position (from 0) of a fixed list, as SQL text."""
    return f"element_at(array({', '.join(map(_text, values))}), CAST({position} AS INT) + 1)"


def pick(values: tuple, position: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v).cast("string") for v in values]), position.cast("int") + 1)


def epoch_micros(civil: Column) -> Column:
    """Microseconds since 1970 of a civil time taken as UTC, in any session zone."""
    since = civil - F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'")
    return (since.cast("interval second").cast("decimal(18,6)") * 1000000).cast("bigint")


def brand_of(user: Column) -> Column:
    return pick(BRANDS, user % len(BRANDS))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(
        "event_id",
        "ts",
        "user_id",
        "event_type",
        "value",
        "CAST(get_json_object(props, '$.k') AS BIGINT) AS k",
        "to_date(ts) AS day",
        f"event_id DIV {BLOCK} AS block",
    )


def _micros(civil: str) -> str:
    """``epoch_micros`` as SQL text."""
    since = f"CAST({civil} - TIMESTAMP_NTZ '1970-01-01 00:00:00' AS INTERVAL SECOND)"
    return f"CAST(CAST({since} AS DECIMAL(18,6)) * 1000000 AS BIGINT)"


# A hit, its fields in the order of the schema; sorting puts hits in order of number.
_HIT = f"""named_struct(
  'type', 'EVENT',
  'hitNumber', CAST(number AS BIGINT),
  'time', {_micros("ts")} DIV 1000 - visitStartTime * 1000,
  'isInteraction', k % 4 <> 0,
  'isEntrance', number = 1,
  'isExit', number = n,
  'referer', CAST(NULL AS STRING),
  'page', named_struct('pagePath', '/' || event_type, 'pageTitle', CAST(NULL AS STRING)),
  'product', array(named_struct('productSKU', 'p' || k, 'v2ProductName', CAST(NULL AS STRING))),
  'contentGroup', named_struct('contentGroup1', event_type),
  'eventInfo', named_struct(
    'eventCategory', {_pick(tuple(c for c, _ in EVENTS), f"(k % {len(EVENTS)})")},
    'eventAction', {_pick(tuple(a for _, a in EVENTS), f"(k % {len(EVENTS)})")},
    'eventLabel', CASE WHEN k % 3 <> 1 THEN 'label ' || (k % 5) END),
  'experiment', CAST(array() AS ARRAY<STRUCT<experimentId: STRING, experimentVariant: STRING>>),
  'customDimensions', CASE
    WHEN NOT known THEN array(named_struct('index', 1L, 'value', 'x' || (k % 3)))
    WHEN brand = '16' AND k % 6 = 0 THEN array(
      named_struct('index', 1L, 'value', 'x' || (k % 3)),
      named_struct('index', 178L, 'value', member),
      named_struct('index', 182L, 'value', member || 'b'))
    ELSE array(
      named_struct('index', 1L, 'value', 'x' || (k % 3)),
      named_struct('index', CASE WHEN brand IN ('15', '40') THEN 10L ELSE 178L END, 'value', member))
    END) AS hit"""

_SESSION = ("user_id", "day", "block")


def sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions of all brands, with a ``brand`` column."""
    # Collecting lists gains nothing from combining on the map side, so the few raw columns
    # are shuffled first and everything else is built behind the shuffle.
    raw = events(spark, sf_dir).repartition(*_SESSION)
    of_session = f"OVER (PARTITION BY {', '.join(_SESSION)}"
    numbered = raw.selectExpr(
        "*",
        f"row_number() {of_session} ORDER BY ts, event_id) AS number",
        f"count(*) {of_session}) AS n",
        f"min(ts) {of_session}) AS start",
    )
    tagged = numbered.selectExpr(
        "*",
        f"{_pick(BRANDS, f'(user_id % {len(BRANDS)})')} AS brand",
        "'u' || ((user_id + k % 2) % 40) AS member",
        "k % 3 = 0 AND user_id % 3 > 0 AS known",
        f"{_micros('start')} DIV 1000000 AS visitStartTime",
    )
    collected = (
        tagged.selectExpr(*_SESSION, "brand", "n", "visitStartTime", "ts", "event_id", "event_type", "value", _HIT)
        .groupBy(*_SESSION, "brand", "n", "visitStartTime")
        .agg(
            F.expr("sort_array(collect_list(hit)) AS hits"),
            F.expr("max(ts) AS end"),
            F.expr("min(event_id) AS visitId"),
            F.expr("count_if(event_type = 'view') AS pageviews"),
            F.expr("sum(CASE WHEN event_type = 'purchase' THEN 1 END) AS transactions"),
            F.expr(
                "sum(CASE WHEN event_type = 'purchase' THEN CAST(round(value * 100) AS BIGINT) * 10000 END)"
                " AS revenue"
            ),
        )
    )
    timed = collected.selectExpr("*", f"{_micros('end')} DIV 1000000 AS lastTime")
    null = "CAST(NULL AS STRING)"
    return timed.selectExpr(
        "brand",
        "date_format(day, 'yyyyMMdd') AS date",
        "CAST(user_id AS STRING) AS fullVisitorId",
        "visitId",
        "CAST(greatest(1, datediff(day, DATE '2023-12-31') - user_id % 5) AS BIGINT) AS visitNumber",
        f"{_pick(CHANNELS, f'(visitId % {len(CHANNELS)})')} AS channelGrouping",
        "visitStartTime",
        """named_struct(
          'visits', CASE WHEN visitId % 20 <> 0 THEN 1L END, 'hits', n, 'pageviews', pageviews,
          'timeOnSite', CASE WHEN n > 1 THEN lastTime - visitStartTime END,
          'transactions', transactions, 'totalTransactionRevenue', revenue,
          'bounces', CASE WHEN n = 1 THEN 1L END) AS totals""",
        f"""named_struct(
          'referralPath', {null}, 'campaign', 'c' || (user_id % 5), 'source', 's' || (user_id % 4),
          'medium', {_pick(MEDIUMS, f"(user_id % {len(MEDIUMS)})")},
          'keyword', {null}, 'adContent', {null}) AS trafficSource""",
        f"""named_struct(
          'browser', {_pick(("Chrome", "Safari"), "(user_id % 2)")},
          'operatingSystem', {_pick(("Android", "iOS", "Windows"), "(user_id % 3)")},
          'isMobile', user_id % 3 <> 2, 'mobileDeviceBranding', {null}, 'mobileDeviceModel', {null},
          'mobileDeviceInfo', {null},
          'deviceCategory', {_pick(("mobile", "mobile", "desktop"), "(user_id % 3)")}) AS device""",
        f"""named_struct(
          'continent', 'Asia', 'subContinent', 'Eastern Asia', 'country', 'Taiwan', 'region', {null},
          'metro', {null}, 'city', 'city' || (user_id % 6)) AS geoNetwork""",
        "hits",
    )


def mediums(spark: SparkSession) -> DataFrame:
    return small_table(spark, MEDIUM_GROUPS, schemas.MEDIUM_LOOKUP)


# ---- ads -------------------------------------------------------------------------


def _ad_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    shifted = F.date_add(F.trunc(F.to_date("l_shipdate"), "week"), SHIFT_DAYS)
    return table(spark, sf_dir, "lineitem").select(
        "*",
        shifted.alias("Date"),
        # One account holds a third of the lines.
        F.when(F.col("l_orderkey") % 3 == 0, HOT_ACCOUNT).otherwise(F.col("l_suppkey")).alias("ExternalCustomerId"),
        F.col("l_partkey").alias("CampaignId"),
        F.col("l_quantity").cast("bigint").alias("Clicks"),
    )


def _two_accounts(lines: DataFrame, *columns: Column | str) -> list[DataFrame]:
    """One account's rows by line status; lines numbered 1 are held by both."""
    shared = F.col("l_linenumber") == 1
    return [lines.where((F.col("l_linestatus") == s) | shared).select(*columns) for s in ("F", "O")]


def basic_stats(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Lines numbered 2 come twice, alike in all but the device."""
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    flag = F.col("l_returnflag")
    slot = F.when(flag == "A", SLOTS["A"]).when(flag == "N", SLOTS["N"]).otherwise(SLOTS["R"])
    devices = F.when(F.col("l_linenumber") == 2, F.array(F.lit("HIGH_END_MOBILE"), F.lit("DESKTOP")))
    return _two_accounts(
        _ad_lines(spark, sf_dir).withColumn("Device", F.explode(F.coalesce(devices, F.array(F.lit("DESKTOP"))))),
        "Date",
        "ExternalCustomerId",
        "CampaignId",
        "Clicks",
        (F.col("Clicks") * (10 + F.col("l_linenumber"))).alias("Impressions"),
        (cents * 10000).alias("Cost"),
        slot.alias("Slot"),
        F.col("l_linenumber").cast("bigint").alias("ViewThroughConversions"),
        (F.col("l_quantity") / 2).alias("Conversions"),
        "Device",
    )


def campaign_stats(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Many rows of a campaign's day are alike in all but the ad group."""
    conversions = (F.col("l_quantity") / 2).alias("CurrentModelAttributedConversions")
    group = (F.col("l_orderkey") % 1000).alias("AdGroupId")
    return _two_accounts(_ad_lines(spark, sf_dir), "Date", "CampaignId", conversions, group)


def cookie_stats(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """One row per date and campaign, two where the campaign is a multiple of ten."""
    per_day = (
        _ad_lines(spark, sf_dir)
        .groupBy("Date", "CampaignId")
        .agg(F.max(F.round(F.col("l_discount") * 100).cast("bigint")).alias("share"))
    )
    copies = F.when(F.col("CampaignId") % 10 == 0, F.array(F.lit(0), F.lit(100)))
    rows = per_day.select(
        "Date", "CampaignId", "share", F.explode(F.coalesce(copies, F.array(F.lit(0)))).alias("more")
    )
    text = (F.col("share") + F.col("more")).cast("string").alias("AbsoluteTopImpressionPercentage")
    return [
        rows.where(half).select("Date", "CampaignId", text)
        for half in (F.col("CampaignId") % 20 < 12, F.col("CampaignId") % 20 >= 8)
    ]


def _snapshot_days() -> Column:
    """Three load days, as instants and numbers 0-2."""
    return F.explode(
        F.array(
            *[
                F.struct(
                    F.timestamp_seconds(F.lit(1640995200 + 86400 * n)).alias("_PARTITIONTIME"),
                    F.lit(n).alias("n"),
                )
                for n in range(3)
            ]
        )
    )


def customers(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Account names; some change on the last day, accounts of nations 10-12 are in both.

    Some accounts with stats are in neither. One of the two names a time zone of its own.
    """
    suppliers = table(spark, sf_dir, "supplier").where(F.col("s_suppkey") % UNKNOWN_ACCOUNTS != 0)
    snapshots = suppliers.withColumn("day", _snapshot_days())
    key, nation = F.col("s_suppkey"), F.col("s_nationkey")
    moved = F.when((F.col("day.n") == 2) & (key % 4 == 0), 1).otherwise(0)
    return [
        snapshots.where(held).select(
            key.alias("ExternalCustomerId"),
            pick(ACCOUNT_NAMES, (key + moved + extra) % len(ACCOUNT_NAMES)).alias("AccountDescriptiveName"),
            F.lit("TWD").alias("AccountCurrencyCode"),
            F.when(key % 3 == extra, "Asia/Taipei").alias("CustomerTimeZone"),
            F.col("day._PARTITIONTIME").alias("_PARTITIONTIME"),
        )
        for held, extra in ((nation <= 12, 0), (nation >= 10, 2))
    ]


def campaigns(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Some campaigns with stats are in neither account, some in both under two names."""
    parts = table(spark, sf_dir, "part").where(F.col("p_partkey") % UNKNOWN_CAMPAIGNS != 0)
    snapshots = parts.withColumn("day", _snapshot_days())
    name = F.concat("p_name", F.lit(" v"), F.col("day.n").cast("string"))
    size = F.col("p_size")
    return [
        snapshots.where(held).select(
            F.col("p_partkey").alias("CampaignId"),
            F.concat(name, F.lit(suffix)).alias("CampaignName"),
            F.col("p_type").alias("AdvertisingChannelType"),
            F.col("day._PARTITIONTIME").alias("_PARTITIONTIME"),
        )
        for held, suffix in ((size <= 30, ""), (size >= 25, " coop"))
    ]


def ads_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A static report of earlier days, with repeated rows."""
    order, cust = F.col("o_orderkey"), F.col("o_custkey")
    clicks = (F.col("o_orderkey") % 50).cast("bigint")
    return table(spark, sf_dir, "orders").select(
        pick(ACCOUNT_NAMES, cust % len(ACCOUNT_NAMES)).alias("Account"),
        F.date_add(F.trunc(F.to_date("o_orderdate"), "month"), SHIFT_DAYS).alias("Date"),
        F.concat(F.lit("old "), (order % 3).cast("string")).alias("Campaign_name"),
        F.lit("SEARCH").alias("Advertising_channel_type"),
        F.lit("TWD").alias("Currency_code"),
        clicks.alias("Clicks"),
        (clicks * 10).alias("impressions"),
        F.lit(0.1).alias("CTR"),
        F.lit(2.5).alias("CPC"),
        (clicks * 2.5).cast("double").alias("Cost"),
        F.lit(0.5).alias("Absolute_top_impression_percentage"),
        F.lit(None).cast("double").alias("Top_impression_percentage"),
        (clicks % 7).alias("Conversions"),
        (clicks % 3).alias("View_through_conversions"),
        F.lit(7.25).alias("Cost_per_conversion"),
        F.lit(0.125).alias("Conversion_rate"),
    )


# ---- search interest -------------------------------------------------------------


def interest_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekly orders of 31 groups of customers, as fetched: keyword, date, value, isPartial."""
    return (
        table(spark, sf_dir, "orders")
        .groupBy(
            F.concat(F.lit("kw"), (F.col("o_custkey") % KEYWORDS).cast("string")).alias("keyword"),
            F.trunc(F.to_date("o_orderdate"), "week").alias("date"),
        )
        .agg(F.count("*").alias("value"))
        .select("*", F.lit(False).alias("isPartial"))
    )


def keywords(spark: SparkSession) -> DataFrame:
    """Wanted keywords; kw30 is not."""
    rows = [(f"kw{n}", n < 15) for n in range(KEYWORDS - 1)]
    return small_table(spark, rows, schemas.KEYWORDS)


def interest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tag_series(interest_series(spark, sf_dir), keywords(spark), INTEREST_RUN)


# ---- beacon and sales ------------------------------------------------------------


def _beacon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Beacon events, with the event's own type and number as ``kind`` and ``k``."""
    k, user = F.col("k"), F.col("user_id")
    kind = F.col("event_type")
    micros = F.col("micros")
    return events(spark, sf_dir).withColumn("micros", epoch_micros(F.col("ts"))).select(
        F.concat("event_type", F.lit("_store"), k.cast("string")).alias("event_name"),
        F.date_sub("day", 3).alias("event_start_at"),
        F.date_add("day", 3).alias("event_end_at"),
        F.concat(F.lit("U"), F.lpad(user.cast("string"), 32, "0")).alias("receiver_uid"),
        F.when(kind == "click", "enter").when(kind == "view", "push").otherwise("banner").alias("event_type"),
        F.timestamp_micros(micros).alias("event_time"),
        F.timestamp_micros(micros - 86400000000).alias("first_follow"),
        F.when(k % 5 != 0, F.date_format("day", "yyyy-MM-dd")).alias("bind_date"),
        brand_of(user).alias("brand_id"),
        kind.alias("kind"),
        "k",
    )


def beacon(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _beacon(spark, sf_dir).drop("kind", "k")


def faulty_beacon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Beacon events with faults for every check to find."""
    uid, k = F.col("receiver_uid"), F.col("k")
    second = F.unix_seconds("event_time")
    return _beacon(spark, sf_dir).select(
        F.when(k != 11, F.col("event_name")).alias("event_name"),
        "event_start_at",
        "event_end_at",
        F.when(k == 7, F.substring(uid, 1, 32)).when(k != 13, uid).alias("receiver_uid"),
        F.when(F.col("kind") == "error", "error").otherwise(F.col("event_type")).alias("event_type"),
        # Only the day is left of the time, so that keys repeat.
        F.timestamp_seconds(second - second % 86400).alias("event_time"),
        "first_follow",
        "bind_date",
        F.when(k == 9, None).when(k == 10, "99").otherwise(F.col("brand_id")).alias("brand_id"),
    )


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales by part with the part's brand, in whole units so that their sum is exact.

    Summed by part ahead of the join, as one part may be on very many lines.
    """
    by_part = table(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(F.sum("l_quantity").alias("sales"))
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    joined = by_part.join(parts, by_part["l_partkey"] == parts["p_partkey"], "left")
    return joined.select(F.col("p_brand").alias("brand"), "sales")
