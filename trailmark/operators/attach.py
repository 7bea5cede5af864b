"""Left join of a one-row-per-key lookup that survives hot and missing keys."""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Copies of the lookup row for missing keys: this setting of the session, or 64.
SALTS_SETTING, SALTS = "spark.trailmark.salts", 64
_SALT = "_salt"


def _any_null(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])


def attach_by_key(
    rows: DataFrame,
    lookup: DataFrame,
    keys: Sequence[str],
    spread_by: Sequence[str],
    salts: int | None = None,
) -> DataFrame:
    """``rows`` left-joined with ``lookup`` (unique on ``keys``); NULL matches NULL.

    Rows with a missing key all share one lookup row, and there may be very many of
    them, so they are spread over ``salts`` copies of that row by a hash of
    ``spread_by``. A hot present key is split by adaptive skew-join handling. The
    salt also keeps the join's partitioning from being reused by a later grouping on
    the same keys, which would stop that split. No broadcast is forced: Spark
    broadcasts the lookup only when its measured size allows.
    """
    salts = salts or int(rows.sparkSession.conf.get(SALTS_SETTING, str(SALTS)))
    missing = _any_null(keys)
    salted_rows = rows.withColumn(
        _SALT,
        F.when(missing, F.pmod(F.xxhash64(*spread_by), F.lit(salts))).otherwise(F.lit(0)).cast("int"),
    )
    copies = F.when(missing, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    salted_lookup = lookup.withColumn(_SALT, F.explode(copies))
    for key in [*keys, _SALT]:
        salted_lookup = salted_lookup.withColumnRenamed(key, f"_r_{key}")
    condition = reduce(
        lambda a, b: a & b,
        [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys] + [F.col(_SALT) == F.col(f"_r_{_SALT}")],
    )
    joined = salted_rows.join(salted_lookup, condition, "left")
    return joined.drop(_SALT, f"_r_{_SALT}", *[f"_r_{k}" for k in keys])


def full_outer_report(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Merge two reports on shared keys, keeping the rows of both; NULL keys never match."""
    return left.join(right, list(keys), "full")
