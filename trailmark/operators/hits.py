"""Nested session rows to one row per hit."""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailmark.fixed_values import LOCAL_OFFSET_HOURS
from trailmark.functions import epoch_to_civil, joined_key, kv_lookup
from trailmark.operators.attach import attach_by_key
from trailmark.operators.identity import last_known_of_sessions

IdKeys = Sequence[int] | Mapping[str, Sequence[int]]

# Fields kept of each session struct.
SESSION_STRUCTS = {
    "totals": (
        "visits", "hits", "pageviews", "timeOnSite",
        "transactions", "totalTransactionRevenue", "bounces",
    ),
    "trafficSource": ("referralPath", "campaign", "source", "medium", "keyword", "adContent"),
    "device": (
        "browser", "operatingSystem", "isMobile", "mobileDeviceBranding",
        "mobileDeviceModel", "mobileDeviceInfo", "deviceCategory",
    ),
    "geoNetwork": ("continent", "subContinent", "country", "region", "metro", "city"),
}

# Fields read of each hit; ``time`` becomes ``hitDateTime`` in the output.
HIT_FIELDS = (
    "type", "hitNumber", "time", "isInteraction", "isEntrance", "isExit",
    "referer", "page", "product", "contentGroup", "eventInfo", "experiment",
)


def unnest_hits(sessions: DataFrame, fields: Sequence[str] | None = None) -> DataFrame:
    """Session x its hits, as column ``hit``; sessions without hits vanish.

    With ``fields`` only those hit fields are read from storage: zipping the field
    arrays names each leaf, so the scan is pruned to them.
    """
    hits = F.col("hits")
    if fields:
        hits = F.arrays_zip(*[F.col(f"hits.{name}").alias(name) for name in fields])
    # Same as a plain explode, for which Spark would add a filter on the array's size
    # ahead of it and build the zipped array a second time there.
    return sessions.withColumn("hit", F.explode_outer(hits)).drop("hits").where(F.col("hit").isNotNull())


def repack(struct: str, fields: Sequence[str]) -> Column:
    """Narrow a struct to the named fields."""
    return F.struct(*[F.col(f"{struct}.{name}").alias(name) for name in fields]).alias(struct)


def member_id(pairs: Column, id_keys: IdKeys, brand: Column) -> Column:
    """Member id of a hit: one key list for all rows, or one per brand."""
    if not isinstance(id_keys, Mapping):
        return kv_lookup(pairs, id_keys)
    by_keys: dict[tuple[int, ...], list[str]] = {}
    for code, keys in id_keys.items():
        by_keys.setdefault(tuple(keys), []).append(code)
    return F.coalesce(
        *[F.when(brand.isin(codes), kv_lookup(pairs, keys)) for keys, codes in by_keys.items()]
    )


def hit_ids(sessions: DataFrame, id_keys: IdKeys) -> DataFrame:
    """Each hit's own member id with the visitor and order it counts for (narrow scan)."""
    hits = unnest_hits(
        sessions.select("brand", "fullVisitorId", "visitNumber", "hits"),
        ["hitNumber", "customDimensions"],
    )
    return hits.select(
        "brand",
        "fullVisitorId",
        "visitNumber",
        F.col("hit.hitNumber").alias("hitNumber"),
        member_id(F.col("hit.customDimensions"), id_keys, F.col("brand")).alias("marsId"),
    )


def visitor_ids(sessions: DataFrame, id_keys: IdKeys) -> DataFrame:
    """Each visitor's last known member id, from session rows (narrow scan)."""
    pairs = F.arrays_zip(
        F.col("hits.hitNumber").alias("hitNumber"), F.col("hits.customDimensions").alias("customDimensions")
    )
    candidates = F.transform(
        pairs,
        lambda h: F.struct(
            h["hitNumber"].alias("number"), member_id(h["customDimensions"], id_keys, F.col("brand")).alias("value")
        ),
    )
    return last_known_of_sessions(sessions, "marsId", ["brand", "fullVisitorId"], "visitNumber", candidates)


def identified_sessions(
    sessions: DataFrame,
    brand: str | None,
    id_keys: IdKeys | None,
    columns: Sequence[Column | str],
) -> DataFrame:
    """The columns of each session, with ``brand``, ``fullVisitorId`` and ``marsId``."""
    if brand is not None:
        sessions = sessions.withColumn("brand", F.lit(brand))
    visitor = ["brand", "fullVisitorId"]
    narrow = sessions.select(*visitor, "visitId", *columns)
    if id_keys is None:
        return narrow.withColumn("marsId", F.lit(None).cast("string"))
    return attach_by_key(narrow, visitor_ids(sessions, id_keys), visitor, ["visitId"])


def flatten_hits(
    sessions: DataFrame,
    brand: str | None,
    id_keys: IdKeys | None,
    offset_hours: int = LOCAL_OFFSET_HOURS,
    hit_fields: Sequence[str] = HIT_FIELDS,
) -> DataFrame:
    """One row per hit with the session's narrowed structs and the visitor's member id.

    ``brand`` is the code of the table's brand; None if the sessions of several brands
    come in one table with a ``brand`` column, with ``id_keys`` by brand. Without
    ``id_keys`` the member id is NULL, for reports that do not use it. ``hit_fields``
    are the fields of each hit that are read from storage and kept, one at least.

    The member id is attached to the session rows and the hits unnested afterwards:
    a shuffle then moves every session struct once rather than once per hit.
    """
    identified = identified_sessions(
        sessions,
        brand,
        id_keys,
        [
            joined_key(F.col("date"), F.col("fullVisitorId"), F.col("visitId")).alias("sessionId"),
            "visitNumber",
            "channelGrouping",
            "visitStartTime",
            *[repack(name, fields) for name, fields in SESSION_STRUCTS.items()],
            F.arrays_zip(*[F.col(f"hits.{name}").alias(name) for name in hit_fields]).alias("hits"),
        ],
    )
    return unnest_hits(identified).select(
        "brand",
        "marsId",
        "sessionId",
        "fullVisitorId",
        "visitId",
        "visitNumber",
        "channelGrouping",
        F.when(F.col("visitNumber") == 1, True).otherwise(False).alias("isNewVisit"),
        epoch_to_civil(F.col("visitStartTime"), "s", offset_hours).alias("visitStartDateTime"),
        *SESSION_STRUCTS,
        F.struct(
            *[
                epoch_to_civil(F.col("visitStartTime") * 1000 + F.col("hit.time"), "ms", offset_hours).alias("hitDateTime")
                if name == "time"
                else F.col(f"hit.{name}").alias(name)
                for name in hit_fields
            ]
        ).alias("hit"),
    )
