"""DuckDB SQL with the meaning of each registered query, written the plain way.

The inputs are derived from the test tables in shared CTEs; the queries use windows,
plain distinct aggregates and joins where the library has its own formulations.
"""

from trailmark.fixed_values import (
    ACCOUNT_PREFIXES,
    BEACON_BRANDS,
    JOURNEY_CATEGORY_TEXTS,
    JOURNEY_CHANNELS,
    JOURNEY_EVENTS,
    JOURNEY_MEDIUMS,
    MEDIUM_GROUPS,
    TREND_HORIZONS,
)
from workload.adapters import (
    ACCOUNT_NAMES,
    BLOCK,
    BRANDS,
    CHANNELS,
    EVENTS,
    HOT_ACCOUNT,
    KEYWORDS,
    MEDIUMS,
    SHIFT_DAYS,
    UNKNOWN_ACCOUNTS,
    UNKNOWN_CAMPAIGNS,
)


def literal(value) -> str:
    if value is None:
        return "NULL"
    return "'" + str(value).replace("'", "''") + "'"


def pick(values, position: str) -> str:
    return f"(CAST([{', '.join(literal(v) for v in values)}] AS VARCHAR[]))[CAST(({position}) + 1 AS BIGINT)]"


def rounded(value: str, digits: int) -> str:
    """Round half away from zero, of the number as it is written."""
    return f"CAST(round(CAST(CAST({value} AS VARCHAR) AS DECIMAL(38,20)), {digits}) AS DOUBLE)"


def ratio(numerator: str, denominator: str, digits: int) -> str:
    return rounded(f"({numerator}) / nullif(CAST({denominator} AS DOUBLE), 0)", digits)


def whole(total: str) -> str:
    """A session total summed over all sessions: every hit of a session is there, and its first counts."""
    return f"CAST(sum(CASE WHEN hitNumber = 1 THEN {total} END) AS DOUBLE)"


def brand_case(name: str) -> str:
    cases = " ".join(f"WHEN {name} LIKE {literal(p + '%')} THEN {literal(c)}" for p, c in ACCOUNT_PREFIXES)
    return f"CASE {cases} END"


CTES: dict[str, str] = {}

CTES["ev"] = f"""
SELECT event_id, ts, user_id, event_type, value,
       CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
       CAST(ts AS DATE) AS day, event_id // {BLOCK} AS block
FROM events"""

CTES["grouped"] = """
SELECT *,
       row_number() OVER (s ORDER BY ts, event_id) AS hitNumber,
       count(*) OVER s AS n, min(ts) OVER s AS s_start, max(ts) OVER s AS s_end,
       min(event_id) OVER s AS visitId,
       sum(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END) OVER s AS pageviews,
       sum(CASE WHEN event_type = 'purchase' THEN 1 END) OVER s AS transactions,
       sum(CASE WHEN event_type = 'purchase' THEN CAST(round(value * 100) AS BIGINT) * 10000 END)
           OVER s AS revenue
FROM ev WINDOW s AS (PARTITION BY user_id, day, block)"""

CTES["own"] = f"""
SELECT *, {pick(BRANDS, f"user_id % {len(BRANDS)}")} AS brand,
       CASE WHEN k % 3 = 0 AND user_id % 3 > 0 THEN 'u' || CAST((user_id + k % 2) % 40 AS VARCHAR) END AS member,
       CAST(user_id AS VARCHAR) AS fullVisitorId,
       CAST(greatest(1, day - DATE '2023-12-31' - user_id % 5) AS BIGINT) AS visitNumber,
       date_diff('second', TIMESTAMP '1970-01-01', s_start) AS visitStartTime
FROM grouped"""

CTES["flat0"] = f"""
SELECT brand,
       CASE WHEN brand = '16' AND k % 6 = 0 THEN member || 'b' ELSE member END AS ownId, member, k,
       strftime(day, '%Y%m%d') || '-' || fullVisitorId || '-' || CAST(visitId AS VARCHAR) AS sessionId,
       fullVisitorId, visitId, visitNumber,
       {pick(CHANNELS, f"visitId % {len(CHANNELS)}")} AS channelGrouping,
       visitNumber = 1 AS isNewVisit, visitStartTime,
       TIMESTAMP '1970-01-01 08:00:00' + to_seconds(visitStartTime) AS visitStartDateTime,
       CAST(CASE WHEN visitId % 20 <> 0 THEN 1 END AS BIGINT) AS visits, n AS totals_hits,
       CAST(pageviews AS BIGINT) AS pageviews,
       CASE WHEN n > 1 THEN date_diff('second', TIMESTAMP '1970-01-01', s_end) - visitStartTime END AS timeOnSite,
       CAST(transactions AS BIGINT) AS transactions, CAST(revenue AS BIGINT) AS totalTransactionRevenue,
       CAST(CASE WHEN n = 1 THEN 1 END AS BIGINT) AS bounces,
       'c' || CAST(user_id % 5 AS VARCHAR) AS campaign, 's' || CAST(user_id % 4 AS VARCHAR) AS source,
       {pick(MEDIUMS, f"user_id % {len(MEDIUMS)}")} AS medium,
       {pick(("Chrome", "Safari"), "user_id % 2")} AS browser,
       {pick(("Android", "iOS", "Windows"), "user_id % 3")} AS operatingSystem,
       user_id % 3 <> 2 AS isMobile, {pick(("mobile", "mobile", "desktop"), "user_id % 3")} AS deviceCategory,
       'Taiwan' AS country, 'city' || CAST(user_id % 6 AS VARCHAR) AS city,
       'EVENT' AS type, hitNumber, date_trunc('millisecond', ts) + INTERVAL 8 HOUR AS hitDateTime,
       k % 4 <> 0 AS isInteraction, hitNumber = 1 AS isEntrance, hitNumber = n AS isExit,
       '/' || event_type AS pagePath, 'p' || CAST(k AS VARCHAR) AS productSKU, event_type AS contentGroup1,
       {pick(tuple(c for c, _ in EVENTS), f"k % {len(EVENTS)}")} AS eventCategory,
       {pick(tuple(a for _, a in EVENTS), f"k % {len(EVENTS)}")} AS eventAction,
       CASE WHEN k % 3 <> 1 THEN 'label ' || CAST(k % 5 AS VARCHAR) END AS eventLabel
FROM own"""

CTES["flat"] = """
SELECT *, last_value(ownId IGNORE NULLS) OVER (
           PARTITION BY brand, fullVisitorId ORDER BY visitNumber, hitNumber, ownId NULLS FIRST
           ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS marsId,
       CAST(visitStartDateTime AS DATE) AS date
FROM flat0"""

CTES["mediums"] = "SELECT * FROM (VALUES " + ", ".join(
    f"({literal(m)}, {literal(g)})" for m, g in MEDIUM_GROUPS
) + ") AS v(utm_medium, mapping_type)"

CTES["lines"] = f"""
SELECT *, CAST(date_trunc('week', l_shipdate) AS DATE) + {SHIFT_DAYS} AS Date,
       CASE WHEN l_orderkey % 3 = 0 THEN {HOT_ACCOUNT} ELSE l_suppkey END AS ExternalCustomerId,
       l_partkey AS CampaignId,
       CAST(l_quantity AS BIGINT) AS Clicks
FROM lineitem"""

_STATS = """
SELECT Date, ExternalCustomerId, CampaignId, Clicks, Clicks * (10 + l_linenumber) AS Impressions,
       CAST(round(l_extendedprice * 100) AS BIGINT) * 10000 AS Cost,
       CASE l_returnflag WHEN 'A' THEN 'SearchTop' WHEN 'N' THEN 'SearchOther' ELSE 'Content' END AS Slot,
       CAST(l_linenumber AS BIGINT) AS ViewThroughConversions, l_quantity / 2 AS Conversions, Device
FROM lines JOIN (VALUES ('DESKTOP'), ('HIGH_END_MOBILE')) AS v(Device) ON Device = 'DESKTOP' OR l_linenumber = 2
WHERE l_linestatus = '{}' OR l_linenumber = 1"""
CTES["stats"] = _STATS.format("F") + "\nUNION" + _STATS.format("O")

_CONVERSIONS = """
SELECT Date, CampaignId, l_quantity / 2 AS CurrentModelAttributedConversions, l_orderkey % 1000 AS AdGroupId
FROM lines WHERE l_linestatus = '{}' OR l_linenumber = 1"""
CTES["conversions"] = _CONVERSIONS.format("F") + "\nUNION" + _CONVERSIONS.format("O")

CTES["cookies"] = """
SELECT DISTINCT Date, CampaignId, CAST(share + more AS VARCHAR) AS AbsoluteTopImpressionPercentage
FROM (SELECT Date, CampaignId, max(CAST(round(l_discount * 100) AS BIGINT)) AS share FROM lines GROUP BY ALL)
JOIN (VALUES (0), (100)) AS v(more) ON more = 0 OR CampaignId % 10 = 0"""

_CUSTOMER = """
SELECT s_suppkey AS ExternalCustomerId, {name} AS AccountDescriptiveName,
       'TWD' AS AccountCurrencyCode, CASE WHEN s_suppkey % 3 = {extra} THEN 'Asia/Taipei' END AS CustomerTimeZone,
       n AS load
FROM supplier, (VALUES (0), (1), (2)) AS v(n) WHERE s_nationkey {held} AND s_suppkey % {unknown} <> 0"""


def _customer(extra: int, held: str) -> str:
    moved = "CASE WHEN n = 2 AND s_suppkey % 4 = 0 THEN 1 ELSE 0 END"
    return _CUSTOMER.format(
        name=pick(ACCOUNT_NAMES, f"(s_suppkey + {moved} + {extra}) % {len(ACCOUNT_NAMES)}"),
        held=held, extra=extra, unknown=UNKNOWN_ACCOUNTS,
    )


CTES["customers_a"] = _customer(0, "<= 12")
CTES["customers_b"] = _customer(2, ">= 10")
CTES["customer_map"] = f"""
SELECT ExternalCustomerId, {brand_case("AccountDescriptiveName")} AS brand FROM customers_a
UNION SELECT ExternalCustomerId, {brand_case("AccountDescriptiveName")} FROM customers_b"""

_LATEST = "(SELECT * EXCLUDE (load) FROM {0} QUALIFY row_number() OVER (PARTITION BY {1} ORDER BY load DESC) = 1)"


def _latest(name: str, key: str) -> str:
    return "SELECT * FROM " + _LATEST.format(f"{name}_a", key) + " UNION SELECT * FROM " + _LATEST.format(f"{name}_b", key)


CTES["customer_now"] = _latest("customers", "ExternalCustomerId")

_CAMPAIGN = """
SELECT p_partkey AS CampaignId, p_name || ' v' || CAST(n AS VARCHAR) || '{}' AS CampaignName,
       p_type AS AdvertisingChannelType, n AS load
FROM part, (VALUES (0), (1), (2)) AS v(n) WHERE p_size {} AND p_partkey % {} <> 0"""
CTES["campaigns_a"] = _CAMPAIGN.format("", "<= 30", UNKNOWN_CAMPAIGNS)
CTES["campaigns_b"] = _CAMPAIGN.format(" coop", ">= 25", UNKNOWN_CAMPAIGNS)
CTES["campaign_now"] = _latest("campaigns", "CampaignId")

CTES["clicks"] = """
SELECT brand, Date AS date, CAST(sum(Clicks) AS BIGINT) AS clicks
FROM stats JOIN customer_map USING (ExternalCustomerId) GROUP BY brand, Date"""

TOP_RATIO = ratio(
    "sum(CASE WHEN Slot = 'SearchTop' THEN Impressions END)",
    "sum(CASE WHEN Slot IN ('SearchOther', 'SearchTop') THEN Impressions END)",
    4,
)
_MONEY = "(CAST(sum(Cost) AS BIGINT) / 1000000)"
CTES["campaign_days"] = f"""
SELECT Date, ExternalCustomerId, CampaignId, CAST(sum(Clicks) AS BIGINT) AS Clicks,
       CAST(sum(Impressions) AS BIGINT) AS impressions,
       {ratio("sum(Clicks)", "sum(Impressions)", 4)} AS CTR,
       {ratio(_MONEY, "sum(Clicks)", 2)} AS CPC, {_MONEY} AS Cost,
       {TOP_RATIO} AS Top_impression_percentage,
       CAST(sum(ViewThroughConversions) AS BIGINT) AS View_through_conversions,
       {ratio(_MONEY, "sum(Conversions)", 2)} AS Cost_per_conversion,
       {ratio("sum(Conversions)", "sum(Clicks)", 4)} AS Conversion_rate
FROM stats GROUP BY Date, ExternalCustomerId, CampaignId"""
CTES["conversion_days"] = """
SELECT Date, CampaignId, CAST(round(sum(CurrentModelAttributedConversions)) AS BIGINT) AS Conversions
FROM conversions GROUP BY Date, CampaignId"""
CTES["ongoing"] = """
SELECT AccountDescriptiveName AS Account, s.Date, CampaignName AS Campaign_name,
       AdvertisingChannelType AS Advertising_channel_type, AccountCurrencyCode AS Currency_code,
       Clicks, impressions, CTR, CPC, Cost,
       CAST(AbsoluteTopImpressionPercentage AS DOUBLE) AS Absolute_top_impression_percentage,
       Top_impression_percentage, Conversions, View_through_conversions, Cost_per_conversion, Conversion_rate
FROM campaign_days s
JOIN campaign_now c ON s.CampaignId = c.CampaignId
JOIN customer_now a ON s.ExternalCustomerId = a.ExternalCustomerId
JOIN conversion_days v ON s.Date = v.Date AND s.CampaignId = v.CampaignId
JOIN cookies k ON s.Date = k.Date AND s.CampaignId = k.CampaignId"""
CTES["history"] = f"""
SELECT {pick(ACCOUNT_NAMES, f"o_custkey % {len(ACCOUNT_NAMES)}")} AS Account,
       CAST(date_trunc('month', o_orderdate) AS DATE) + {SHIFT_DAYS} AS Date,
       'old ' || CAST(o_orderkey % 3 AS VARCHAR) AS Campaign_name, 'SEARCH' AS Advertising_channel_type,
       'TWD' AS Currency_code, o_orderkey % 50 AS Clicks, o_orderkey % 50 * 10 AS impressions,
       CAST(0.1 AS DOUBLE) AS CTR, CAST(2.5 AS DOUBLE) AS CPC, CAST(o_orderkey % 50 * 2.5 AS DOUBLE) AS Cost,
       CAST(0.5 AS DOUBLE) AS Absolute_top_impression_percentage,
       CAST(NULL AS DOUBLE) AS Top_impression_percentage,
       o_orderkey % 50 % 7 AS Conversions, o_orderkey % 50 % 3 AS View_through_conversions,
       CAST(7.25 AS DOUBLE) AS Cost_per_conversion, CAST(0.125 AS DOUBLE) AS Conversion_rate
FROM orders"""

CTES["interest"] = f"""
SELECT 'kw' || CAST(o_custkey % {KEYWORDS} AS VARCHAR) AS keyword,
       CAST(date_trunc('week', o_orderdate) AS DATE) AS date, count(*) AS hits,
       o_custkey % {KEYWORDS} < 15 AS is_luxe,
       TIMESTAMP '2001-08-01 20:00:00' AS updated_datetime
FROM orders WHERE o_custkey % {KEYWORDS} < {KEYWORDS - 1}
GROUP BY ALL"""
CTES["numbered"] = "\nUNION ALL".join(
    f"""
SELECT '{name}' AS horizon, keyword, date, hits AS y,
       row_number() OVER (PARTITION BY keyword ORDER BY date) AS x
FROM interest WHERE date >= CAST(updated_datetime AS DATE) - {days}"""
    for name, (days, _) in TREND_HORIZONS.items()
)
CTES["centred"] = """
SELECT *, avg(x) OVER (PARTITION BY horizon) AS x_bar, avg(y) OVER (PARTITION BY horizon) AS y_bar
FROM numbered"""
CTES["slopes"] = (
    "SELECT keyword, "
    + ", ".join(f"max(CASE WHEN horizon = '{name}' THEN slope END) AS {name}" for name in TREND_HORIZONS)
    + """
FROM (SELECT horizon, keyword, sum((x - x_bar) * (y - y_bar)) / sum((x - x_bar) * (x - x_bar)) AS slope
      FROM centred GROUP BY horizon, keyword)
GROUP BY keyword"""
)
SCORE = "({}) / {}".format(
    " + ".join(f"{name} * {weight}" for name, (_, weight) in TREND_HORIZONS.items()),
    sum(weight for _, weight in TREND_HORIZONS.values()),
)

CTES["beacon"] = f"""
SELECT event_type || '_store' || CAST(k AS VARCHAR) AS event_name,
       day - 3 AS event_start_at, day + 3 AS event_end_at,
       'U' || lpad(CAST(user_id AS VARCHAR), 32, '0') AS receiver_uid,
       CASE event_type WHEN 'click' THEN 'enter' WHEN 'view' THEN 'push' ELSE 'banner' END AS event_type,
       ts AS event_time, ts - INTERVAL 1 DAY AS first_follow,
       CASE WHEN k % 5 <> 0 THEN strftime(day, '%Y-%m-%d') END AS bind_date,
       {pick(BRANDS, f"user_id % {len(BRANDS)}")} AS brand_id
FROM ev"""
CTES["faulty"] = f"""
SELECT CASE WHEN k <> 11 THEN event_type || '_store' || CAST(k AS VARCHAR) END AS event_name,
       day - 3 AS event_start_at,
       CASE WHEN k = 7 THEN 'U' || lpad(CAST(user_id AS VARCHAR), 32, '0')[1:31]
            WHEN k <> 13 THEN 'U' || lpad(CAST(user_id AS VARCHAR), 32, '0') END AS receiver_uid,
       CASE event_type WHEN 'click' THEN 'enter' WHEN 'view' THEN 'push'
            WHEN 'error' THEN 'error' ELSE 'banner' END AS event_type,
       day, CASE WHEN k % 5 <> 0 THEN day END AS bind_date,
       CASE WHEN k = 9 THEN NULL WHEN k = 10 THEN '99'
            ELSE {pick(BRANDS, f"user_id % {len(BRANDS)}")} END AS brand_id
FROM ev"""

# CTEs each one reads.
NEEDS = {
    "ev": [], "grouped": ["ev"], "own": ["grouped"], "flat0": ["own"], "flat": ["flat0"], "mediums": [],
    "lines": [], "stats": ["lines"], "conversions": ["lines"], "cookies": ["lines"],
    "customers_a": [], "customers_b": [], "customer_map": ["customers_a", "customers_b"],
    "customer_now": ["customers_a", "customers_b"], "campaigns_a": [], "campaigns_b": [],
    "campaign_now": ["campaigns_a", "campaigns_b"], "clicks": ["stats", "customer_map"],
    "campaign_days": ["stats"], "conversion_days": ["conversions"],
    "ongoing": ["campaign_days", "campaign_now", "customer_now", "conversion_days", "cookies"],
    "history": [], "interest": [], "numbered": ["interest"], "centred": ["numbered"], "slopes": ["centred"],
    "beacon": ["ev"], "faulty": ["ev"],
}


def with_ctes(select: str, *names: str) -> str:
    ordered: list[str] = []

    def add(name: str) -> None:
        for needed in NEEDS[name]:
            add(needed)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        add(name)
    return "WITH " + ",\n".join(f"{name} AS ({CTES[name]})" for name in ordered) + "\n" + select.strip()


FLAT_COLUMNS = """brand, marsId, sessionId, fullVisitorId, visitId, visitNumber, channelGrouping, isNewVisit,
visitStartDateTime, visits, totals_hits, pageviews, timeOnSite, transactions, totalTransactionRevenue, bounces,
campaign, source, medium, browser, operatingSystem, isMobile, deviceCategory, country, city, type, hitNumber,
hitDateTime, isInteraction, isEntrance, isExit, pagePath, productSKU, contentGroup1,
eventCategory, eventAction, eventLabel"""

SESSION_COUNT = "count(DISTINCT CASE WHEN visits = 1 THEN sessionId END)"
EVENT_KEY = "sessionId || '-' || eventCategory || '-' || eventAction || '-' || eventLabel"
SITE_METRICS = f"""
SELECT brand, date, count(DISTINCT fullVisitorId) AS users,
       count(DISTINCT CASE WHEN visitNumber = 1 THEN fullVisitorId END) AS new_users,
       {SESSION_COUNT} AS sessions,
       {ratio(whole("CASE WHEN visits = 1 THEN pageviews END"), SESSION_COUNT, 2)} AS pages_per_session,
       {ratio(whole("timeOnSite"), SESSION_COUNT, 2)} AS avg_session_duration,
       {ratio("count(DISTINCT CASE WHEN visitNumber = 1 AND visits = 1 THEN sessionId END)", SESSION_COUNT, 4)}
           AS new_sessions_ratio,
       {ratio("count(DISTINCT CASE WHEN bounces = 1 AND visits = 1 THEN sessionId END)", SESSION_COUNT, 4)}
           AS bounce_rate,
       CAST({rounded(whole("totalTransactionRevenue") + " / 1000000", 0)} AS BIGINT) AS revenue,
       count(DISTINCT {EVENT_KEY}) AS unique_events,
       {ratio(whole("transactions"), SESSION_COUNT, 4)} AS ecommerce_conversion_rate
FROM flat GROUP BY brand, date"""


def event_conditions() -> dict[str, str]:
    conditions = {
        f"{name}_sessions": f"eventCategory = {literal(c)} AND eventAction = {literal(a)}"
        for name, (c, a) in JOURNEY_EVENTS.items()
    }
    for name, (text, ignore_case) in JOURNEY_CATEGORY_TEXTS.items():
        column = "lower(eventCategory)" if ignore_case else "eventCategory"
        conditions[f"{name}_sessions"] = f"{column} LIKE {literal('%' + text + '%')}"
    return conditions


def distinct_sessions(conditions: dict[str, str]) -> list[str]:
    return [f"count(DISTINCT CASE WHEN {c} THEN sessionId END) AS {name}" for name, c in conditions.items()]


def browsing_times(conditions: dict[str, str]) -> list[str]:
    return [
        rounded(f"sum(CASE WHEN {c} THEN timeOnSite / totals_hits ELSE 0 END)", 0) + f" AS {name}_browsing_time"
        for name, c in conditions.items()
    ]


CHANNEL_IS = {name: f"channelGrouping = {literal(v)}" for name, v in JOURNEY_CHANNELS.items()}
MEDIUM_IS = {name: f"mediumGrouping = {literal(v)}" for name, v in JOURNEY_MEDIUMS.items()}


def _sessions_of(conditions: dict[str, str]) -> dict[str, str]:
    return {f"{name}_sessions": c for name, c in conditions.items()}


_JOURNEY_PARTS = ",\n       ".join(
    distinct_sessions(_sessions_of(CHANNEL_IS))
    + browsing_times(CHANNEL_IS)
    + distinct_sessions(_sessions_of(MEDIUM_IS))
    + browsing_times(MEDIUM_IS)
    + distinct_sessions(event_conditions())
)
STITCHED = """CASE WHEN marsId IS NOT NULL THEN last_value(fullVisitorId) OVER (
           PARTITION BY marsId ORDER BY visitStartDateTime, fullVisitorId
           ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) ELSE fullVisitorId END"""
FIRST_DAY = "dense_rank() OVER (PARTITION BY marsId ORDER BY date) = 1"
JOURNEY = f"""
SELECT brand, marsId, fullVisitorId, date, bool_or(firstDay) AS isNewVisit,
       count(DISTINCT sessionId) AS sessions, count(DISTINCT channelGrouping) AS channels,
       count(DISTINCT mediumGrouping) AS mediums,
       count(DISTINCT CASE WHEN isInteraction THEN eventCategory END) AS events,
       {rounded("sum(timeOnSite / totals_hits)", 0)} AS browsing_time,
       {rounded("sum(pageviews / totals_hits)", 0)} AS pageviews,
       {rounded("sum(totals_hits / totals_hits)", 0)} AS hits,
       {_JOURNEY_PARTS}
FROM (SELECT * REPLACE ({STITCHED} AS fullVisitorId), {FIRST_DAY} AS firstDay,
             coalesce(mapping_type, 'others') AS mediumGrouping
      FROM flat LEFT JOIN mediums ON lower(medium) = utm_medium WHERE visits = 1)
GROUP BY brand, marsId, fullVisitorId, date"""

_PIVOT_PARTS = ",\n       ".join(
    distinct_sessions(_sessions_of(CHANNEL_IS)) + distinct_sessions(event_conditions()) + browsing_times(CHANNEL_IS)
)
_ROUNDED_SLOPES = ", ".join(f"{rounded(name, 6)} AS {name}" for name in TREND_HORIZONS)
_BEACON = "SELECT * FROM beacon"
_BRAND_LIST = ", ".join(literal(b) for b in BEACON_BRANDS)


def _check(check: str, column: str, failures: str) -> str:
    return f"SELECT '{check}' AS \"check\", '{column}' AS \"column\", count(*) AS failures FROM {failures}"


def _rows_failing(check: str, column: str, condition: str) -> str:
    return _check(check, column, f"faulty WHERE {condition}")


ORACLES: dict[str, str] = {
    "flat_hits": with_ctes(f"SELECT {FLAT_COLUMNS} FROM flat", "flat"),
    "clustered_write": with_ctes(f"SELECT {FLAT_COLUMNS} FROM flat", "flat"),
    "union_all_brands": with_ctes(
        "SELECT brand, marsId, sessionId, hitNumber, visitStartDateTime FROM flat", "flat"
    ),
    "shard_scan": with_ctes(
        """SELECT brand, sessionId[1:8] AS date, visitId, visitNumber, CAST(count(*) AS INTEGER) AS hits
           FROM flat0 GROUP BY ALL""",
        "flat0",
    ),
    "shard_scan_bounded": with_ctes(
        """SELECT brand, sessionId[1:8] AS date, visitId, CAST(count(*) AS INTEGER) AS hits
           FROM flat0 WHERE sessionId[1:8] BETWEEN '20240105' AND '20240114' GROUP BY ALL""",
        "flat0",
    ),
    "shard_scan_from": with_ctes(
        """SELECT brand, sessionId[1:8] AS date, visitId, CAST(count(*) AS INTEGER) AS hits, sessionId[1:8] AS shard
           FROM flat0 WHERE sessionId[1:8] >= '20240105' AND sessionId[1:8] <> '20240110' GROUP BY ALL""",
        "flat0",
    ),
    "unnest_hits": with_ctes("SELECT visitId, hitNumber, eventCategory, eventAction FROM flat0", "flat0"),
    "kv_lookup": with_ctes(
        """SELECT visitId, hitNumber, CASE WHEN brand NOT IN ('15', '40') THEN member END AS key_178,
                  CASE WHEN brand IN ('15', '40') THEN member END AS key_10 FROM flat0""",
        "flat0",
    ),
    "kv_lookup_fallback": with_ctes(
        """SELECT visitId, hitNumber, CASE WHEN brand NOT IN ('15', '40') THEN ownId END AS key FROM flat0""",
        "flat0",
    ),
    "struct_repack": with_ctes(
        """SELECT visitId, visits, totals_hits AS hits, pageviews, timeOnSite, transactions,
                  totalTransactionRevenue, bounces, medium, browser, city FROM flat0 WHERE hitNumber = 1""",
        "flat0",
    ),
    "epoch_to_local": with_ctes(
        """SELECT visitId, visitStartDateTime, CAST(visitStartDateTime AS DATE) AS local_date
           FROM flat0 WHERE hitNumber = 1""",
        "flat0",
    ),
    "epoch_ms_to_local": with_ctes("SELECT visitId, hitNumber, hitDateTime FROM flat0", "flat0"),
    "identity_fill": with_ctes(
        "SELECT brand, fullVisitorId, visitNumber, hitNumber, marsId FROM flat", "flat"
    ),
    "identity_stitch": with_ctes(
        f"""SELECT brand, marsId, sessionId, {STITCHED} AS fullVisitorId, visitStartDateTime, hitNumber
            FROM flat""",
        "flat",
    ),
    "first_day_flag": with_ctes(
        f"SELECT marsId, sessionId, visitStartDateTime, hitNumber, {FIRST_DAY} AS isNewVisit FROM flat", "flat"
    ),
    "lookup_left_join": with_ctes(
        """SELECT sessionId, hitNumber, medium, coalesce(mapping_type, 'others') AS mediumGrouping
           FROM flat LEFT JOIN mediums ON lower(medium) = utm_medium""",
        "flat",
        "mediums",
    ),
    "visit_filter": with_ctes(
        "SELECT brand, count(*) AS hits, max(visitNumber) AS last_visit FROM flat WHERE visits = 1 GROUP BY brand",
        "flat",
    ),
    "bool_or_flag": with_ctes(
        "SELECT brand, date, bool_or(isNewVisit) AS isNewVisit FROM flat GROUP BY brand, date", "flat"
    ),
    "cond_distinct": with_ctes(
        f"""SELECT brand, date, count(DISTINCT sessionId) AS sessions, {SESSION_COUNT} AS visit_sessions,
            count(DISTINCT CASE WHEN lower(eventCategory) LIKE '%shade-finder%' THEN sessionId END) AS shade_sessions,
            count(DISTINCT CASE WHEN eventCategory LIKE '%virtual try on%' THEN sessionId END) AS try_on_sessions,
            count(DISTINCT fullVisitorId) AS users,
            count(DISTINCT CASE WHEN visitNumber = 1 THEN fullVisitorId END) AS new_users
            FROM flat GROUP BY brand, date""",
        "flat",
    ),
    "cond_sum": with_ctes(
        """SELECT brand, sessionId,
                  CAST(sum(CASE WHEN channelGrouping = 'Direct' THEN timeOnSite END) AS BIGINT) AS or_null,
                  CAST(sum(CASE WHEN channelGrouping = 'Direct' THEN timeOnSite ELSE 0 END) AS BIGINT) AS or_zero
           FROM flat GROUP BY brand, sessionId""",
        "flat",
    ),
    "composite_distinct": with_ctes(
        f"SELECT brand, date, count(DISTINCT {EVENT_KEY}) AS unique_events FROM flat GROUP BY brand, date", "flat"
    ),
    "apportioned_totals": with_ctes(
        f"""SELECT sessionId, {rounded("sum(timeOnSite / totals_hits)", 0)} AS timeOnSite,
                   {rounded("sum(pageviews / totals_hits)", 0)} AS pageviews,
                   {rounded("sum(totals_hits / totals_hits)", 0)} AS hits
            FROM flat GROUP BY sessionId""",
        "flat",
    ),
    "ratio_metrics": with_ctes(SITE_METRICS, "flat"),
    "pivot_sessions": with_ctes(
        f"""SELECT brand, marsId, date, count(DISTINCT sessionId) AS sessions,
                   count(DISTINCT channelGrouping) AS channels, {_PIVOT_PARTS}
            FROM flat GROUP BY brand, marsId, date""",
        "flat",
    ),
    "customer_journey": with_ctes(JOURNEY, "flat", "mediums"),
    "prefix_classifier": with_ctes(
        f"""SELECT AccountDescriptiveName, {brand_case("AccountDescriptiveName")} AS brand, count(*) AS count
            FROM (SELECT * FROM customers_a UNION ALL SELECT * FROM customers_b)
            GROUP BY AccountDescriptiveName""",
        "customers_a",
        "customers_b",
    ),
    "account_click_join": with_ctes("SELECT * FROM clicks", "clicks"),
    "full_outer_daily": with_ctes(
        """SELECT brand, date, clicks, hits FROM clicks
           FULL JOIN (SELECT brand, date, count(*) AS hits FROM flat GROUP BY brand, date) USING (brand, date)""",
        "clicks",
        "flat",
    ),
    "daily_report": with_ctes(
        f"""SELECT brand, date, users, new_users, sessions, pages_per_session, avg_session_duration,
                   new_sessions_ratio, bounce_rate, clicks, revenue, unique_events, ecommerce_conversion_rate
            FROM clicks FULL JOIN ({SITE_METRICS}) USING (brand, date)
            ORDER BY brand NULLS FIRST, date""",
        "clicks",
        "flat",
    ),
    "latest_snapshot": with_ctes(
        "SELECT *, 0 AS held_by FROM " + _LATEST.format("customers_a", "ExternalCustomerId")
        + " UNION ALL SELECT *, 1 AS held_by FROM " + _LATEST.format("customers_b", "ExternalCustomerId"),
        "customers_a", "customers_b",
    ),
    "union_distinct": with_ctes("SELECT * FROM stats", "stats"),
    "micros_to_units": with_ctes(
        "SELECT Date, ExternalCustomerId, CampaignId, Cost / 1000000 AS cost FROM stats", "stats"
    ),
    "rounding_cast": with_ctes(
        """SELECT Date, CampaignId, CAST(round(sum(CurrentModelAttributedConversions)) AS BIGINT) AS conversions,
                  sum(CurrentModelAttributedConversions) AS exact
           FROM conversions GROUP BY Date, CampaignId""",
        "conversions",
    ),
    "in_list_ratio": with_ctes(
        f"""SELECT CampaignId, Date,
                   CAST(sum(CASE WHEN Slot IN ('SearchOther', 'SearchTop') THEN Impressions END) AS BIGINT)
                       AS searched,
                   {TOP_RATIO} AS top_ratio
            FROM stats GROUP BY CampaignId, Date""",
        "stats",
    ),
    "star_join": with_ctes(
        """SELECT Account, Campaign_name, count(*) AS rows, CAST(sum(Clicks) AS BIGINT) AS clicks,
                  CAST(sum(Conversions) AS BIGINT) AS conversions
           FROM ongoing GROUP BY Account, Campaign_name""",
        "ongoing",
    ),
    "ads_ongoing": with_ctes("SELECT * FROM ongoing ORDER BY Campaign_name, Date", "ongoing"),
    "ads_combined": with_ctes(
        f"""SELECT {brand_case("Account")} AS Brand, * EXCLUDE (Account) FROM ongoing WHERE Date >= '2022-01-01'
            UNION
            SELECT {brand_case("Account")} AS Brand, * EXCLUDE (Account) FROM history""",
        "ongoing",
        "history",
    ),
    "keyword_tagging": with_ctes("SELECT * FROM interest", "interest"),
    "replace_table": with_ctes("SELECT * FROM interest", "interest"),
    "date_window_filter": with_ctes(
        """SELECT keyword, date, hits FROM interest
           WHERE date >= CAST(updated_datetime AS DATE) - INTERVAL 180 DAY""",
        "interest",
    ),
    "sequence_number": with_ctes("SELECT horizon, keyword, date, x FROM numbered", "numbered"),
    "global_mean": with_ctes(
        f"""SELECT DISTINCT horizon, keyword, {rounded("x_bar", 6)} AS x_bar, {rounded("y_bar", 6)} AS y_bar
            FROM centred""",
        "centred",
    ),
    "pooled_slope": with_ctes(f"SELECT keyword, {_ROUNDED_SLOPES} FROM slopes", "slopes"),
    "slope_score": with_ctes(f"SELECT keyword, {rounded(SCORE, 6)} AS score FROM slopes", "slopes"),
    "trend_report": with_ctes(
        f"""SELECT keyword, {_ROUNDED_SLOPES}, {rounded(SCORE, 6)} AS score, updated_datetime
            FROM (SELECT DISTINCT keyword, updated_datetime FROM interest) LEFT JOIN slopes USING (keyword)""",
        "interest",
        "slopes",
    ),
    "split_fields": with_ctes(
        """SELECT event_name, split_part(event_name, '_', 1) AS event, split_part(event_name, '_', 2) AS store,
                  CAST(NULL AS VARCHAR) AS rest FROM beacon""",
        "beacon",
    ),
    "beacon_stage": with_ctes(
        """SELECT split_part(event_name, '_', 1) AS event_name, split_part(event_name, '_', 2) AS store_name,
                  event_start_at, event_end_at, receiver_uid, event_type, CAST(event_time AS DATE) AS event_date,
                  CAST(first_follow AS DATE) AS first_follow_date, CAST(bind_date AS DATE) AS bind_date, brand_id
           FROM beacon""",
        "beacon",
    ),
    "brand_sales": """SELECT p_brand AS brand, sum(l_quantity) AS sales
FROM lineitem LEFT JOIN part ON l_partkey = p_partkey GROUP BY p_brand""",
    "csv_load": with_ctes(_BEACON, "beacon"),
    "append_by_day": with_ctes(
        """SELECT *, CASE brand_id WHEN '01' THEN 'lan' WHEN '16' THEN 'gab' ELSE 'shu' END AS load_source,
                  CASE WHEN event_time + INTERVAL 8 HOUR < '2024-01-15' THEN '2024-01-14' ELSE '2024-01-15' END AS load_day
           FROM beacon""",
        "beacon",
    ),
    "publish_loads": with_ctes(
        f"""SELECT * EXCLUDE (day), brand_id AS load_source, day AS load_day FROM (
                SELECT *, CASE WHEN event_time + INTERVAL 8 HOUR < '2024-01-15' THEN '2024-01-14' ELSE '2024-01-15' END AS day
                FROM beacon) AS dated
            WHERE brand_id IN ({_BRAND_LIST}) AND NOT (brand_id = '15' AND day = '2024-01-15')""",
        "beacon",
    ),
    "replace_aside": with_ctes("SELECT * FROM interest WHERE is_luxe", "interest"),
    "csv_bom_load": with_ctes(
        """SELECT * REPLACE ('"' || event_type || '"' || chr(10) || event_name AS event_name) FROM beacon""", "beacon"
    ),
    "seed_load": """SELECT lpad(CAST(p_partkey AS VARCHAR), 12, '0') AS code, p_brand AS brand,
       CAST(p_size AS VARCHAR) AS size FROM part""",
    "catalog_table": with_ctes("SELECT keyword, date, hits FROM interest WHERE is_luxe", "interest"),
    "landed_append": with_ctes(_BEACON, "beacon"),
    "json_pages_flatten": with_ctes(
        "SELECT event_id, user_id AS who_user_id, k AS who_k, event_type FROM ev", "ev"
    ),
    "check_unique": with_ctes(
        _check(
            "unique",
            "key",
            """(SELECT event_name || receiver_uid || event_type || CAST(day AS VARCHAR) AS key FROM faulty
                GROUP BY 1 HAVING count(*) > 1 AND key IS NOT NULL)""",
        ),
        "faulty",
    ),
    "beacon_check_list": with_ctes(
        " UNION ALL ".join([
            _check(
                "unique",
                "event_name-receiver_uid-event_type-event_time",
                """(SELECT event_name, receiver_uid, event_type, day FROM faulty
                    WHERE event_name IS NOT NULL AND receiver_uid IS NOT NULL
                    GROUP BY ALL HAVING count(*) > 1)""",
            ),
            _rows_failing("not_null", "event_name", "event_name IS NULL"),
            _rows_failing("value_lengths_to_equal", "receiver_uid", "length(receiver_uid) <> 33"),
            _rows_failing("not_null", "receiver_uid", "receiver_uid IS NULL"),
            _rows_failing("accepted_values", "event_type", "event_type NOT IN ('enter', 'push', 'banner')"),
            _rows_failing("not_null", "brand_id", "brand_id IS NULL"),
            _rows_failing("accepted_values", "brand_id", f"brand_id NOT IN ({_BRAND_LIST})"),
        ]),
        "faulty",
    ),
    "check_not_null": with_ctes(
        " UNION ALL ".join(
            _rows_failing("not_null", c, f"{c} IS NULL") for c in ("event_name", "receiver_uid", "brand_id")
        ),
        "faulty",
    ),
    "check_accepted_values": with_ctes(
        _rows_failing("accepted_values", "event_type", "event_type NOT IN ('enter', 'push', 'banner')")
        + " UNION ALL "
        + _rows_failing("accepted_values", "brand_id", f"brand_id NOT IN ({_BRAND_LIST})"),
        "faulty",
    ),
    "check_length": with_ctes(
        _rows_failing("value_lengths_to_equal", "receiver_uid", "length(receiver_uid) <> 33")
        + " UNION ALL "
        + _rows_failing("value_lengths_to_equal", "receiver_uid", "length(receiver_uid) <> 33 AND brand_id = '07'"),
        "faulty",
    ),
    "check_expression": with_ctes(
        _rows_failing("expression_is_true", "dates", "NOT event_start_at < bind_date")
        + " UNION ALL "
        + _check(
            "expression_is_true",
            "uids",
            "(SELECT brand_id FROM faulty GROUP BY brand_id HAVING count(receiver_uid) <> count(*))",
        ),
        "faulty",
    ),
}
