"""Civil times and dates that do not depend on the session time zone."""

from pyspark.sql import Column
from pyspark.sql import functions as F

UNIT_INTERVALS = {"s": "INTERVAL '1' SECOND", "ms": "INTERVAL '0.001' SECOND", "us": "INTERVAL '0.000001' SECOND"}


def epoch_to_civil(value: Column, unit: str = "s", offset_hours: int = 0) -> Column:
    """Epoch count (seconds, milli- or microseconds, bigint) to civil time at an offset."""
    start = F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'") + F.expr(f"INTERVAL '{offset_hours}' HOUR")
    return start + value.cast("bigint") * F.expr(UNIT_INTERVALS[unit])


def civil_date(value: Column) -> Column:
    """Date of a civil time (no zone), or of an ISO date text."""
    return value.cast("date")


def utc_date(instant: Column) -> Column:
    """Date of an instant in UTC."""
    return F.date_from_unix_date(F.floor(F.unix_seconds(instant) / 86400).cast("int"))
