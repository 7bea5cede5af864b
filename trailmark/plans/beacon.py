"""In-store beacon events: staging and data checks."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailmark.fixed_values import BEACON_BRANDS, BEACON_EVENT_TYPES, BEACON_UID_LENGTH
from trailmark.functions import civil_date, joined_key, split_field, utc_date
from trailmark.operators.checks import Check, accepted_values, not_null, unique, value_lengths_to_equal


def beacon_stage(beacon: DataFrame) -> DataFrame:
    """Event and store names apart, instants as UTC dates, 10 columns."""
    return beacon.select(
        split_field(F.col("event_name"), "_", 0).alias("event_name"),
        split_field(F.col("event_name"), "_", 1).alias("store_name"),
        "event_start_at",
        "event_end_at",
        "receiver_uid",
        "event_type",
        utc_date(F.col("event_time")).alias("event_date"),
        utc_date(F.col("first_follow")).alias("first_follow_date"),
        civil_date(F.col("bind_date")).alias("bind_date"),
        "brand_id",
    )


def beacon_checks() -> list[Check]:
    event_key = joined_key(*[F.col(c) for c in ("event_name", "receiver_uid", "event_type", "event_time")])
    return [
        unique(event_key, "event_name-receiver_uid-event_type-event_time", by_hash=True),
        not_null("event_name"),
        value_lengths_to_equal("receiver_uid", BEACON_UID_LENGTH),
        not_null("receiver_uid"),
        accepted_values("event_type", BEACON_EVENT_TYPES),
        not_null("brand_id"),
        accepted_values("brand_id", BEACON_BRANDS),
    ]
