"""Advertising reports by account (or brand), date and campaign."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailmark import schemas
from trailmark.fixed_values import ACCOUNT_PREFIXES, HISTORY_ENDS, SEARCH_SLOTS, TOP_SLOT
from trailmark.functions import classify_prefix, micros, round_to_long, safe_ratio
from trailmark.operators.setops import union_distinct
from trailmark.operators.snapshots import latest_of_accounts


def top_impression_ratio(digits: int = 4) -> Column:
    slot, impressions = F.col("Slot"), F.col("Impressions")
    return safe_ratio(
        F.sum(F.when(slot == TOP_SLOT, impressions)),
        F.sum(F.when(slot.isin(*SEARCH_SLOTS), impressions)),
        digits,
    )


def campaign_day_stats(basic_stats: Sequence[DataFrame]) -> DataFrame:
    """Stats by date, account and campaign.

    Money is summed in whole micros and divided once, which is exact and independent
    of the order of summation.
    """
    clicks, cost = F.sum("Clicks"), micros(F.sum("Cost"))
    return (
        union_distinct(basic_stats)
        .groupBy("Date", "ExternalCustomerId", "CampaignId")
        .agg(
            clicks.alias("Clicks"),
            F.sum("Impressions").alias("impressions"),
            safe_ratio(clicks, F.sum("Impressions"), 4).alias("CTR"),
            safe_ratio(cost, clicks, 2).alias("CPC"),
            cost.alias("Cost"),
            top_impression_ratio().alias("Top_impression_percentage"),
            F.sum("ViewThroughConversions").alias("View_through_conversions"),
            safe_ratio(cost, F.sum("Conversions"), 2).alias("Cost_per_conversion"),
            safe_ratio(F.sum("Conversions"), clicks, 4).alias("Conversion_rate"),
        )
    )


def campaign_day_conversions(campaign_stats: Sequence[DataFrame]) -> DataFrame:
    """Whole conversions by date and campaign, all accounts together."""
    total = round_to_long(F.sum("CurrentModelAttributedConversions"))
    return union_distinct(campaign_stats).groupBy("Date", "CampaignId").agg(total.alias("Conversions"))


def ads_ongoing(
    campaigns: Sequence[DataFrame],
    customers: Sequence[DataFrame],
    campaign_stats: Sequence[DataFrame],
    basic_stats: Sequence[DataFrame],
    cookie_stats: Sequence[DataFrame],
    ordered: bool = True,
) -> DataFrame:
    """One row per account, date and campaign, 16 columns.

    Give the tables with all their columns: rows that differ in any are kept apart.

    Rows multiply where a campaign or customer has different latest rows in two
    accounts, and where cookie stats have several rows for a date and campaign.
    """
    inputs = [
        (campaigns, schemas.ADS_CAMPAIGN),
        (customers, schemas.ADS_CUSTOMER),
        (campaign_stats, schemas.ADS_CAMPAIGN_STATS),
        (basic_stats, schemas.ADS_BASIC_STATS),
        (cookie_stats, schemas.ADS_COOKIE_STATS),
    ]
    for accounts, columns in inputs:
        for rows in accounts:
            schemas.require(rows, columns)
    campaign = latest_of_accounts(campaigns, ["CampaignId"]).select(
        "CampaignId",
        F.col("CampaignName").alias("Campaign_name"),
        F.col("AdvertisingChannelType").alias("Advertising_channel_type"),
    )
    customer = latest_of_accounts(customers, ["ExternalCustomerId"]).select(
        "ExternalCustomerId",
        F.col("AccountDescriptiveName").alias("Account"),
        F.col("AccountCurrencyCode").alias("Currency_code"),
    )
    top_share = F.col("AbsoluteTopImpressionPercentage").cast("double")
    cookies = union_distinct(cookie_stats).select(
        "Date", "CampaignId", top_share.alias("Absolute_top_impression_percentage")
    )
    # The two small sides with the same key are joined first, so that the large one meets
    # that key in a single join, which adaptive execution may then split.
    by_campaign_day = campaign_day_conversions(campaign_stats).join(cookies, ["Date", "CampaignId"], "inner")
    report = (
        campaign_day_stats(basic_stats)
        .join(campaign, "CampaignId", "inner")
        .join(customer, "ExternalCustomerId", "inner")
        .join(by_campaign_day, ["Date", "CampaignId"], "inner")
        .select(
            "Account",
            "Date",
            "Campaign_name",
            "Advertising_channel_type",
            "Currency_code",
            "Clicks",
            "impressions",
            "CTR",
            "CPC",
            "Cost",
            "Absolute_top_impression_percentage",
            "Top_impression_percentage",
            "Conversions",
            "View_through_conversions",
            "Cost_per_conversion",
            "Conversion_rate",
        )
    )
    return report.orderBy("Campaign_name", "Date") if ordered else report


def by_brand(report: DataFrame) -> DataFrame:
    """Brand in place of the account name."""
    account, *rest = report.columns
    return report.select(classify_prefix(F.col(account), ACCOUNT_PREFIXES).alias("Brand"), *rest)


def ads_combined(ongoing: DataFrame, history: DataFrame, ongoing_from: str = HISTORY_ENDS) -> DataFrame:
    """The ongoing report from a date on, with the whole history, as distinct rows.

    History columns are matched by position. Rows of two accounts of a brand that agree
    in all other columns become one. ``ongoing`` need not be ordered.
    """
    recent = ongoing.where(F.col("Date") >= F.lit(ongoing_from).cast("date"))
    return union_distinct([by_brand(recent), by_brand(history)], same_names=False)
