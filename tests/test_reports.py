"""The reports on hand-made rows, one rule of theirs at a time."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tests.helpers import hit, plan, rows_of, session, session_frame
from trailmark import schemas
from trailmark.fixed_values import MEDIUM_GROUPS
from trailmark.operators.setops import union_all, union_distinct
from trailmark.operators.snapshots import latest_of_accounts, latest_snapshot
from trailmark.plans import ads, beacon, journey, sales, site, tracking
from trailmark.sources import small_table

DAY = date(2024, 1, 1)
DAYS = [datetime(2024, 1, n) for n in (1, 2, 3)]


def basic(spark, *rows):
    """Rows of (account, campaign, clicks, impressions, cost, slot, conversions[, date])."""
    full = [(r[7] if len(r) > 7 else DAY, *r[:5], r[5], 0, r[6]) for r in rows]
    return spark.createDataFrame(full, schemas.ADS_BASIC_STATS)


def customers(spark, *rows):
    return spark.createDataFrame([(i, n, "TWD", t) for i, n, t in rows], schemas.ADS_CUSTOMER)


def campaigns(spark, *rows):
    return spark.createDataFrame([(i, n, "SEARCH", t) for i, n, t in rows], schemas.ADS_CAMPAIGN)


def conversions(spark, *rows):
    return spark.createDataFrame([(DAY, c, v) for c, v in rows], schemas.ADS_CAMPAIGN_STATS)


def cookies(spark, *rows):
    return spark.createDataFrame([(DAY, c, v) for c, v in rows], schemas.ADS_COOKIE_STATS)


def daily(spark, sessions, stats=None, accounts=None):
    hits = tracking.branded_hits(session_frame(spark, sessions))
    none = basic(spark, (0, 0, 0, 0, 0, "x", 0.0)).where("false")
    stats = stats or [none, none]
    accounts = accounts or [customers(spark, (0, "x", DAYS[0]))] * 2
    return {(r.brand, str(r.date)): r for r in site.daily_report(hits, stats, accounts).collect()}


def test_daily_report_metrics(spark):
    events = [hit(1, category="c", action="a", label="l"), hit(2, category="c", action="a", label="l")]
    sessions = [
        session("v1", 1, 1, brand="01", hits=events, pageviews=3, timeOnSite=30, transactions=1,
                totalTransactionRevenue=2_600_000),
        session("v2", 2, 2, brand="01", bounces=1, pageviews=1),
        # Not a visit: counts for duration, revenue and users, but is no session.
        session("v3", 3, 1, brand="01", visits=None, timeOnSite=15, pageviews=50,
                totalTransactionRevenue=1_000_000),
    ]
    row = daily(spark, sessions)["01", "2024-01-01"]
    assert (row.users, row.new_users, row.sessions) == (3, 2, 2)
    assert row.pages_per_session == 2.0
    assert row.avg_session_duration == 22.5
    assert (row.new_sessions_ratio, row.bounce_rate) == (0.5, 0.5)
    assert (row.revenue, row.unique_events, row.ecommerce_conversion_rate) == (4, 1, 0.5)
    assert row.clicks is None


def test_events_with_a_missing_part_are_not_counted(spark):
    events = [hit(1, category="c", action="a", label=None), hit(2, category="c", action=None, label="l")]
    assert daily(spark, [session(brand="01", hits=events)])["01", "2024-01-01"].unique_events == 0


def test_days_without_sessions_have_no_ratios(spark):
    row = daily(spark, [session(brand="01", visits=None, pageviews=1)])["01", "2024-01-01"]
    assert row.sessions == 0 and row.pages_per_session is None and row.bounce_rate is None


def test_clicks_count_for_every_brand_an_account_was_seen_under(spark):
    stats = [basic(spark, (1, 1, 10, 0, 0, "x", 0.0), (2, 1, 5, 0, 0, "x", 0.0)), basic(spark, (1, 1, 10, 0, 0, "x", 0.0))]
    accounts = [
        customers(spark, (1, "lpd_tw_lan", DAYS[0]), (1, "lpd_tw_bio", DAYS[1]), (2, "lpd_tw_lan_x", DAYS[0])),
        customers(spark, (1, "agency", DAYS[0]), (1, "lpd_tw_lan", DAYS[0])),
    ]
    got = rows_of(site.ad_clicks(stats, accounts).select("brand", "clicks"))
    # The row held by both accounts counts once.
    assert sorted(got, key=str) == sorted([("01", 15), ("07", 10), (None, 10)], key=str)


def test_report_keeps_both_sides(spark):
    stats = [basic(spark, (1, 1, 10, 0, 0, "x", 0.0, date(2024, 1, 5)))] * 2
    rows = daily(spark, [session(brand="01")], stats, [customers(spark, (1, "lpd_tw_lan", DAYS[0]))] * 2)
    assert rows["01", "2024-01-05"].clicks == 10 and rows["01", "2024-01-05"].users is None
    assert rows["01", "2024-01-01"].users == 1 and rows["01", "2024-01-01"].clicks is None


def test_latest_snapshot(spark):
    rows = customers(spark, (1, "old", DAYS[0]), (1, "new", DAYS[2]), (2, "b", DAYS[1]), (2, "c", DAYS[1]), (None, "n", DAYS[0]))
    got = latest_snapshot(rows, ["ExternalCustomerId"])
    assert got.columns == ["ExternalCustomerId", "AccountDescriptiveName", "AccountCurrencyCode"]
    assert sorted(rows_of(got.select(got.columns[0], got.columns[1])), key=str) == [(1, "new"), (2, "c"), (None, "n")]
    assert "WindowGroupLimit" in plan(got) and "Partial" in plan(got)
    assert "_PARTITIONTIME" in latest_snapshot(rows, ["ExternalCustomerId"], drop_version=False).columns
    smallest = latest_snapshot(rows, ["ExternalCustomerId"], tiebreak=["AccountCurrencyCode", "AccountDescriptiveName"])
    assert ("c",) in rows_of(smallest.select("AccountDescriptiveName"))


def test_accounts_are_deduplicated_before_their_union(spark):
    accounts = [
        campaigns(spark, (1, "one", DAYS[0]), (2, "same", DAYS[0])),
        campaigns(spark, (1, "other", DAYS[1]), (2, "same", DAYS[2])),
    ]
    got = rows_of(latest_of_accounts(accounts, ["CampaignId"]).select("CampaignId", "CampaignName"))
    assert sorted(got) == [(1, "one"), (1, "other"), (2, "same")]


def ongoing(spark, stats=None, campaign=None, customer=None, converted=None, cookie=None):
    nothing = {}
    pairs = {
        "campaigns": campaign or [campaigns(spark, (1, "camp", DAYS[0]))] * 2,
        "customers": customer or [customers(spark, (7, "lpd_tw_lan", DAYS[0]))] * 2,
        "campaign_stats": converted or [conversions(spark, (1, 2.5))] * 2,
        "basic_stats": stats or [basic(spark, (7, 1, 4, 8, 3_000_000, "SearchTop", 2.0))] * 2,
        "cookie_stats": cookie or [cookies(spark, (1, "0.25"))] * 2,
    }
    return ads.ads_ongoing(**pairs, **nothing)


def test_ongoing_report_row(spark):
    stats = [
        basic(spark, (7, 1, 4, 8, 3_000_000, "SearchTop", 1.5), (7, 1, 2, 4, 1_500_000, "SearchOther", 0.5)),
        basic(spark, (7, 1, 4, 8, 3_000_000, "SearchTop", 1.5), (7, 1, 2, 100, 0, "Content", 0.0)),
    ]
    (row,) = ongoing(spark, stats).collect()
    assert row.asDict() == {
        "Account": "lpd_tw_lan", "Date": DAY, "Campaign_name": "camp", "Advertising_channel_type": "SEARCH",
        "Currency_code": "TWD", "Clicks": 8, "impressions": 112, "CTR": 0.0714, "CPC": 0.56, "Cost": 4.5,
        "Absolute_top_impression_percentage": 0.25, "Top_impression_percentage": 0.6667, "Conversions": 3,
        "View_through_conversions": 0, "Cost_per_conversion": 2.25, "Conversion_rate": 0.25,
    }


def test_ratios_without_denominator(spark):
    (row,) = ongoing(spark, [basic(spark, (7, 1, 0, 0, 5, "Content", 0.0))] * 2).collect()
    assert (row.CTR, row.CPC, row.Top_impression_percentage, row.Cost_per_conversion) == (None,) * 4


def test_conversions_sum_over_accounts_as_distinct_rows(spark):
    converted = [conversions(spark, (1, 2.0), (1, 2.0)), conversions(spark, (1, 2.0), (1, 0.5))]
    assert ongoing(spark, converted=converted).first().Conversions == 3


def test_fan_outs_are_kept(spark):
    two_names = [campaigns(spark, (1, "one", DAYS[0])), campaigns(spark, (1, "other", DAYS[0]))]
    assert ongoing(spark, campaign=two_names).count() == 2
    two_cookies = [cookies(spark, (1, "0.25"), (1, "0.5")), cookies(spark, (1, "0.25"))]
    assert ongoing(spark, cookie=two_cookies).count() == 2
    assert ongoing(spark, campaign=two_names, cookie=two_cookies).count() == 4


def test_unmatched_stats_are_left_out(spark):
    assert ongoing(spark, converted=[conversions(spark, (9, 1.0))] * 2).count() == 0


def history(spark, *rows):
    return spark.createDataFrame(
        [(a, d, "camp", "SEARCH", "TWD", 4, 8, 0.5, 0.75, cost, 0.25, 1.0, 3, 0, 1.5, 0.5) for a, d, cost in rows],
        schemas.ADS_HISTORY,
    )


def test_combined_report(spark):
    before, first = date(2021, 12, 31), date(2022, 1, 1)
    current = history(spark, ("lpd_tw_lan", before, 1.0), ("lpd_tw_lan", first, 2.0), ("lpd_tw_lan_2", first, 2.0))
    old = history(spark, ("lpd_tw_bio", before, 3.0), ("lpd_tw_lan_3", first, 2.0), ("agency", first, 4.0))
    old = old.toDF(*[f"column{n}" for n in range(16)])
    got = ads.ads_combined(current, old)
    assert got.columns[:3] == ["Brand", "Date", "Campaign_name"] and len(got.columns) == 16
    # Ongoing rows start in 2022; equal rows of two accounts of a brand are one; all history stays.
    assert sorted(rows_of(got.select("Brand", "Date", "Cost")), key=str) == sorted(
        [("01", first, 2.0), ("07", before, 3.0), (None, first, 4.0)], key=str
    )


def test_unions_check_schemas(spark):
    one, other = spark.range(2), spark.range(2).select(F.col("id").alias("other"))
    with pytest.raises(ValueError, match="schemas differ"):
        union_all([one, other])
    assert union_distinct([one, one.union(one), other], same_names=False).count() == 2
    with pytest.raises(ValueError, match="schemas differ"):
        union_all([one, one.select(F.col("id").cast("string"))], same_names=False)


def journeys(spark, sessions):
    hits = tracking.branded_hits(session_frame(spark, sessions))
    report = journey.customer_journey(hits, small_table(spark, MEDIUM_GROUPS, schemas.MEDIUM_LOOKUP))
    return {(r.brand, r.marsId, r.fullVisitorId, str(r.date)): r for r in report.collect()}


NEXT_DAY = 1704067200 + 86400


def test_journey_row(spark):
    shop = [
        hit(1, [(178, "m")], "Ecommerce", "Purchase"),
        hit(2, [], "ecommerce", "add to favorites"),
        hit(3, [], "the virtual try on", interaction=False),
        hit(4, [], "Shade-Finder Tool", "open"),
    ]
    row = journeys(spark, [session(brand="01", hits=shop, timeOnSite=50, pageviews=3, medium="CPC")])[
        "01", "m", "v1", "2024-01-01"
    ]
    assert (row.sessions, row.channels, row.mediums, row.events) == (1, 1, 1, 3)
    assert (row.browsing_time, row.pageviews, row.hits) == (50.0, 3.0, 4.0)
    assert (row.channel_direct_sessions, row.channel_direct_browsing_time) == (1, 50.0)
    assert (row.channel_email_sessions, row.channel_email_browsing_time) == (0, 0.0)
    assert (row.medium_paid_media_sessions, row.medium_others_sessions) == (1, 0)
    assert (row.event_purchase_sessions, row.event_add_to_favorite_sessions) == (1, 1)
    assert (row.event_checkout_sessions, row.event_virtual_try_on_sessions, row.event_shade_finder_sessions) == (0, 1, 1)
    assert row.isNewVisit


def test_a_medium_group_without_column_still_counts(spark):
    rows = [session(brand="01", visit=1, medium="peimpr"), session(brand="01", visit=2, medium="unheard of")]
    (row,) = journeys(spark, rows).values()
    assert row.mediums == 2 and row.medium_others_sessions == 1
    assert sum(row[f"medium_{m}_sessions"] for m in ("organic", "owned_media", "paid_media", "referral")) == 0


def test_member_is_stitched_across_visitors_and_brands(spark):
    rows = [
        session("phone", 1, brand="01", hits=[hit(1, [(178, "m")])]),
        session("laptop", 2, brand="45", start=NEXT_DAY, hits=[hit(1, [(178, "m")])]),
    ]
    found = journeys(spark, rows)
    assert {k[:3] for k in found} == {("01", "m", "laptop"), ("45", "m", "laptop")}
    assert found["01", "m", "laptop", "2024-01-01"].isNewVisit
    assert not found["45", "m", "laptop", "2024-01-02"].isNewVisit


def test_anonymous_visitors_share_their_first_day(spark):
    rows = [session("v1", 1, brand="01"), session("v2", 2, brand="07", start=NEXT_DAY)]
    found = journeys(spark, rows)
    assert found["01", None, "v1", "2024-01-01"].isNewVisit
    assert not found["07", None, "v2", "2024-01-02"].isNewVisit


def test_only_visits_count(spark):
    early = session("old", 1, brand="01", visits=None, hits=[hit(1, [(178, "m")])])
    late = session("new", 2, brand="01", start=NEXT_DAY, hits=[hit(1, [(178, "m")])])
    found = journeys(spark, [early, late])
    assert set(found) == {("01", "m", "new", "2024-01-02")} and found["01", "m", "new", "2024-01-02"].isNewVisit


def test_browsing_time_of_bounces_is_missing_not_zero(spark):
    (row,) = journeys(spark, [session(brand="01", bounces=1)]).values()
    assert row.browsing_time is None and row.channel_direct_browsing_time is None
    assert row.channel_email_browsing_time == 0.0


def test_totals_shrink_with_missing_hits(spark):
    (row,) = journeys(spark, [session(brand="01", hits=[hit(1), hit(2)]) | {
        "totals": {"visits": 1, "hits": 4, "timeOnSite": 40}}]).values()
    assert row.browsing_time == 20.0 and row.hits == 2.0


def beacons(spark, *rows):
    base = ("enter_shop", DAY, DAY, "U" * 33, "enter", datetime(2024, 1, 1, 23), datetime(2023, 1, 1), "2023-05-06", "01")
    names = schemas.BEACON.names
    return spark.createDataFrame([tuple({**dict(zip(names, base)), **r}.values()) for r in rows], schemas.BEACON)


def test_beacon_stage(spark):
    got = beacon.beacon_stage(beacons(spark, {}, {"event_name": "a_b_c", "bind_date": None}))
    assert got.columns == [
        "event_name", "store_name", "event_start_at", "event_end_at", "receiver_uid", "event_type",
        "event_date", "first_follow_date", "bind_date", "brand_id",
    ]
    first, second = got.collect()
    assert (first.event_name, first.store_name, first.bind_date) == ("enter", "shop", date(2023, 5, 6))
    assert (second.event_name, second.store_name, second.bind_date) == ("a", "b", None)
    assert first.event_date == date(2024, 1, 1)


def test_sales(spark):
    rows = spark.createDataFrame([("a", 1.5), ("a", 2.0), (None, 1.0)], schemas.BRAND_SALES)
    assert sorted(rows_of(sales.brand_sales(rows)), key=str) == [("a", 3.5), (None, 1.0)]


@pytest.mark.parametrize("seconds", [10, None])
def test_a_session_total_over_no_hits_is_an_error(spark, seconds):
    """As the plain division of the reports is; a session without the total is none."""
    sessions = [session("v1", 1, brand="01", timeOnSite=30), session("v2", 2, brand="01", timeOnSite=seconds)]
    sessions[1]["totals"]["hits"] = 0
    hits = tracking.branded_hits(session_frame(spark, sessions))
    if seconds is None:
        assert [r.time_on_site for r in site.site_counts(hits).collect()] == [30.0]
    else:
        with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
            daily(spark, sessions)
    # The journey counts hits as a share of themselves, so there no total is needed for the error.
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        journey.customer_journey(hits, small_table(spark, MEDIUM_GROUPS, schemas.MEDIUM_LOOKUP)).collect()
