"""Who a hit belongs to: member id within a visitor, device across members.

Every rule here is "one value per key, given back to all rows of the key". The value
is found by an aggregate, which combines on the map side and so never gathers a hot
visitor in one task, then attached by a join. A window over the key would.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailmark.functions import civil_date
from trailmark.operators.attach import attach_by_key

# A missing day ranks before every other day.
UNDATED = "0001-01-01"


#: Numbers that order rows are below this, so that two fit in one.
ORDER_LIMIT = (1 << 31) - 1


def packed_order(numbers: Sequence[Column]) -> Column:
    """One or two whole numbers as one of 64 bits with the same order, NULL first. It fits in a hash
    aggregate's row, which a struct does not. A number out of range is an error.
    """
    if len(numbers) > 2:
        raise ValueError("an order of at most two numbers")

    def raised(number: Column) -> Column:
        fits = number.between(0, ORDER_LIMIT - 1)
        wrong = F.raise_error(F.concat(F.lit("no order below 2^31: "), number.cast("string"))).cast("bigint")
        return F.when(number.isNull(), F.lit(0)).when(fits, number.cast("bigint") + 1).otherwise(wrong)

    first, *second = map(raised, numbers)
    return F.shiftleft(first, 32).bitwiseOR(second[0]) if second else first


def _value_of_last(rows: DataFrame, value: str, by: Sequence[str], packed: str) -> DataFrame:
    """Per ``by`` group, the non-NULL ``value`` of the largest ``packed`` number; ties take the largest value.

    The first grouping, by value too, needs numbers only; text is compared among a group's values.
    Groups without one are left out behind the aggregate: a filter ahead of it would
    evaluate the expression behind ``value`` a second time for every row.
    """
    last = rows.groupBy(*by, value).agg(F.max(packed).alias(packed)).where(F.col(value).isNotNull())
    return last.groupBy(*by).agg(F.max(F.struct(packed, value)).alias("_last")).select(*by, F.col(f"_last.{value}").alias(value))


def last_known(rows: DataFrame, value: str, by: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Per ``by`` group, the last non-NULL ``value`` in ``order``, one or two whole numbers; ties take the
    largest value. Groups without one are left out.
    """
    packed = packed_order([F.col(name) for name in order]).alias("_packed")
    return _value_of_last(rows.select(*by, value, packed), value, by, "_packed")


def fill_identity(
    rows: DataFrame,
    id_col: str,
    by: Sequence[str],
    order: Sequence[str],
    spread_by: Sequence[str],
) -> DataFrame:
    """Give every row of a visitor the visitor's last known id.

    ``spread_by`` tells rows of missing keys apart, which are many; ``order`` may not.
    """
    known = last_known(rows, id_col, by, order).withColumnRenamed(id_col, "_filled")
    filled = attach_by_key(rows, known, by, spread_by)
    return filled.withColumn(id_col, F.col("_filled")).drop("_filled")


def last_known_of_sessions(
    sessions: DataFrame, value: str, by: Sequence[str], order: str, candidates: Column
) -> DataFrame:
    """``last_known`` from session rows, without unnesting.

    ``candidates`` is an array of (number, value) structs of a session's hits; NULL values do
    not count. The last of each session is found within its row, then the last session's.
    """
    known = F.filter(candidates, lambda c: c["value"].isNotNull())
    rows = sessions.select(*by, F.col(order).alias("_order"), F.array_max(known).alias("_last"))
    packed = packed_order([F.col("_order"), F.col("_last.number")]).alias("_packed")
    return _value_of_last(rows.select(*by, F.col("_last.value").alias(value), packed), value, by, "_packed")


def ranked_day(at: Column) -> Column:
    return F.coalesce(civil_date(at), F.lit(UNDATED).cast("date"))


def person_profile(rows: DataFrame, person: str, device: str, at: str) -> DataFrame:
    """One row per person, one of them for the unknown person.

    ``last_device`` is the device of the latest row (ties: the largest device id) and
    ``first_day`` the earliest day. The first step groups by person and device with
    fixed-width aggregates only; the text comparison runs on what is left.
    """
    known_device = F.when(F.col(person).isNotNull(), F.col(device)).alias(device)
    return (
        rows.select(person, known_device, at)
        .groupBy(person, device)
        .agg(F.max(at).alias("_at"), F.min(ranked_day(F.col(at))).alias("_day"))
        .groupBy(person)
        .agg(F.max(F.struct("_at", device)).alias("_last"), F.min("_day").alias("first_day"))
        .select(person, F.col(f"_last.{device}").alias("last_device"), "first_day")
    )


def stitched_device(person: str, device: str) -> Column:
    """A known person's last device, else the row's own."""
    return F.when(F.col(person).isNotNull(), F.col("last_device")).otherwise(F.col(device))


def stitch_identity(
    rows: DataFrame,
    person: str,
    device: str,
    at: str,
    spread_by: Sequence[str] | None = None,
    seen: DataFrame | None = None,
) -> DataFrame:
    """Replace ``device`` by the last device of the same known person.

    ``seen`` holds the same persons, devices and times in fewer or narrower rows.
    """
    profile = person_profile(rows if seen is None else seen, person, device, at).drop("first_day")
    attached = attach_by_key(rows, profile, [person], spread_by or [device, at])
    return attached.withColumn(device, stitched_device(person, device)).drop("last_device")


def first_day_flag(
    rows: DataFrame,
    person: str,
    at: str,
    flag: str = "isNewVisit",
    spread_by: Sequence[str] | None = None,
    seen: DataFrame | None = None,
) -> DataFrame:
    """TRUE on the rows of a person's first day; all unknown persons count as one.

    ``seen`` holds the same persons and times in fewer or narrower rows.
    """
    first = (rows if seen is None else seen).groupBy(person).agg(F.min(ranked_day(F.col(at))).alias("first_day"))
    attached = attach_by_key(rows, first, [person], spread_by or [at])
    return attached.withColumn(flag, ranked_day(F.col(at)) == F.col("first_day")).drop("first_day")
