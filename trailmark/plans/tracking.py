"""Hit tables of all brands."""

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailmark.fixed_values import BRAND_ID_KEYS, LOCAL_OFFSET_HOURS
from trailmark.functions import epoch_to_civil
from trailmark.operators.hits import HIT_FIELDS, flatten_hits, identified_sessions
from trailmark.operators.setops import union_all
from trailmark.sources.writers import write_table

HIT_LAYOUT = ("visitStartDateTime", "channelGrouping", "isNewVisit")


def brand_hits(sessions: DataFrame, brand: str) -> DataFrame:
    """Hits of one brand's session table."""
    return flatten_hits(sessions, brand, BRAND_ID_KEYS[brand])


def all_hits(sessions_by_brand: Mapping[str, DataFrame]) -> DataFrame:
    """Hits of several brands kept in a table each."""
    return union_all([brand_hits(sessions, brand) for brand, sessions in sessions_by_brand.items()])


def branded_hits(
    sessions: DataFrame, identify: bool = True, hit_fields: Sequence[str] = HIT_FIELDS
) -> DataFrame:
    """Hits of several brands kept in one table with a ``brand`` column, in one pass.

    ``identify`` off leaves the member id NULL and saves its join. ``hit_fields`` narrows
    the scan to what a report uses.
    """
    return flatten_hits(sessions, None, BRAND_ID_KEYS if identify else None, hit_fields=hit_fields)


def branded_visits(sessions: DataFrame) -> DataFrame:
    """Sessions with hits, one row each: who visited and when, without the hits."""
    columns = [
        "visitNumber",
        "totals.visits",
        epoch_to_civil(F.col("visitStartTime"), "s", LOCAL_OFFSET_HOURS).alias("visitStartDateTime"),
        (F.size("hits.hitNumber") > 0).alias("_has_hits"),
    ]
    visits = identified_sessions(sessions, None, BRAND_ID_KEYS, columns)
    return visits.where("_has_hits").drop("_has_hits")


def write_hits(hits: DataFrame, table: str, schema: str | None = None) -> None:
    """Materialize hits, which several reports read, laid out for range skipping."""
    write_table(hits, table, schema, cluster_by=HIT_LAYOUT)
