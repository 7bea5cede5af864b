"""Daily site report: site metrics and ad clicks by brand and date."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailmark.fixed_values import ACCOUNT_PREFIXES
from trailmark.functions import (
    civil_date,
    classify_prefix,
    joined_key,
    micros,
    round_to_long,
    safe_ratio,
)
from trailmark.operators.attach import full_outer_report
from trailmark.operators.facets import Facet, Total, facet_report
from trailmark.operators.setops import union_distinct

REPORT_KEYS = ["brand", "date"]
DAILY_COLUMNS = [
    "brand", "date", "users", "new_users", "sessions", "pages_per_session",
    "avg_session_duration", "new_sessions_ratio", "bounce_rate", "clicks", "revenue",
    "unique_events", "ecommerce_conversion_rate",
]


#: A hit's share of a session total is the total over this; summed over the hits it gives the total.
HITS = "totals.hits"


#: What the report reads of a hit.
SITE_HIT_FIELDS = ("eventInfo",)


def event_key() -> Column:
    """Session, category, action and label; NULL if any of them is."""
    info = F.col("hit.eventInfo")
    return joined_key(
        F.col("sessionId"), info["eventCategory"], info["eventAction"], info["eventLabel"]
    )


def site_counts(hits: DataFrame) -> DataFrame:
    """Counts and session totals by brand and local date."""
    visit = F.col("totals.visits") == 1
    new = F.col("visitNumber") == 1
    return facet_report(
        hits,
        keys={"brand": F.col("brand"), "date": civil_date(F.col("visitStartDateTime"))},
        facets=[
            Facet(F.col("fullVisitorId"), {"users": None, "new_users": new}),
            Facet(
                F.col("sessionId"),
                {
                    "sessions": visit,
                    "new_sessions": visit & new,
                    "bounced_sessions": visit & (F.col("totals.bounces") == 1),
                },
                {
                    "visit_pageviews": Total("visit_pageviews"),
                    "time_on_site": Total("time_on_site"),
                    "revenue_micros": Total("revenue_micros"),
                    "transactions": Total("transactions"),
                },
            ),
            Facet(event_key(), {"unique_events": None}),
        ],
        measures={
            "visit_pageviews": F.when(visit, F.col("totals.pageviews")),
            "time_on_site": F.col("totals.timeOnSite"),
            "revenue_micros": F.col("totals.totalTransactionRevenue"),
            "transactions": F.col("totals.transactions"),
        },
        divisor=F.col(HITS),
    )


def site_metrics(hits: DataFrame) -> DataFrame:
    sessions = F.col("sessions")
    return site_counts(hits).select(
        *REPORT_KEYS,
        "users",
        "new_users",
        "sessions",
        safe_ratio(F.col("visit_pageviews"), sessions, 2).alias("pages_per_session"),
        safe_ratio(F.col("time_on_site"), sessions, 2).alias("avg_session_duration"),
        safe_ratio(F.col("new_sessions"), sessions, 4).alias("new_sessions_ratio"),
        safe_ratio(F.col("bounced_sessions"), sessions, 4).alias("bounce_rate"),
        round_to_long(micros(F.col("revenue_micros"))).alias("revenue"),
        "unique_events",
        safe_ratio(F.col("transactions"), sessions, 4).alias("ecommerce_conversion_rate"),
    )


def account_brands(customers: Sequence[DataFrame]) -> DataFrame:
    """Every (account, brand) pair ever seen, brand NULL for an unknown name.

    An account seen under several brands counts for each of them.
    """
    brand = classify_prefix(F.col("AccountDescriptiveName"), ACCOUNT_PREFIXES).alias("brand")
    return union_distinct([c.select("ExternalCustomerId", brand) for c in customers])


def ad_clicks(basic_stats: Sequence[DataFrame], customers: Sequence[DataFrame]) -> DataFrame:
    """Clicks by brand and date; summed by account before the join to the brands."""
    by_account = (
        union_distinct(basic_stats)
        .groupBy("ExternalCustomerId", F.col("Date").alias("date"))
        .agg(F.sum("Clicks").alias("clicks"))
    )
    joined = by_account.join(account_brands(customers), "ExternalCustomerId", "inner")
    return joined.groupBy(*REPORT_KEYS).agg(F.sum("clicks").alias("clicks"))


def daily_report(
    hits: DataFrame,
    basic_stats: Sequence[DataFrame],
    customers: Sequence[DataFrame],
    ordered: bool = True,
) -> DataFrame:
    """One row per brand and date of either side, 13 columns."""
    report = full_outer_report(ad_clicks(basic_stats, customers), site_metrics(hits), REPORT_KEYS)
    report = report.select(*DAILY_COLUMNS)
    return report.orderBy(*REPORT_KEYS) if ordered else report
