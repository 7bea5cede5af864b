"""Declarative data checks: every check is a count of failures."""

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailmark.operators.bitfilter import bit_filter, passes


@dataclass(frozen=True)
class RowCheck:
    """Fails on each row where ``passes`` is FALSE (NULL passes), within ``where``."""

    name: str
    column: str
    passes: Column
    where: Column | None = None

    def failures(self) -> Column:
        failed = ~self.passes if self.where is None else ~self.passes & self.where
        return F.count_if(failed)


@dataclass(frozen=True)
class GroupCheck:
    """``passes`` is an aggregate; fails on each group where it is FALSE."""

    name: str
    column: str
    passes: Column
    group_by: Sequence[str]
    where: Column | None = None

    def failures(self, rows: DataFrame) -> DataFrame:
        rows = rows if self.where is None else rows.where(self.where)
        groups = rows.groupBy(*self.group_by).agg(self.passes.alias("_passes"))
        return groups.agg(F.count_if(~F.col("_passes")).alias("failures"))


#: 64-bit words of the filter of suspected keys: 128 KB, whatever the input.
FILTER_WORDS = 1 << 14


def key_hashes(key: Column) -> list[Column]:
    """128 bits of a key."""
    return [F.xxhash64(F.lit(seed), key) for seed in (1, 2)]


def suspects(keyed: DataFrame) -> DataFrame:
    """The rows of ``_key`` that may have an equal: all that have, and few others.

    Keys are counted by their hashes. The hashes that repeat set bits of an array of fixed size, which
    enters the plan as a scalar subquery; rows without their bit are unique. So of keys that do not
    repeat only hashes are shuffled, not text.
    """
    first, second = key_hashes(F.col("_key"))
    hashed = keyed.select(first.alias("_h1"), second.alias("_h2"))
    repeated = hashed.groupBy("_h1", "_h2").agg(F.count("*").alias("_n")).where("_n > 1")
    filled = bit_filter(repeated, F.col("_h1"), FILTER_WORDS)
    return keyed.where(passes(filled, first, FILTER_WORDS))


@dataclass(frozen=True)
class UniqueCheck:
    """Fails once per value of ``key`` that occurs on several rows; NULL is no value.

    ``by_hash`` is for wide keys of many rows, of which few repeat: a second scan saves the shuffle
    of the keys that do not.
    """

    name: str
    column: str
    key: Column
    by_hash: bool = False

    def failures(self, rows: DataFrame) -> DataFrame:
        keyed = rows.select(self.key.alias("_key")).where("_key IS NOT NULL")
        repeated = (suspects(keyed) if self.by_hash else keyed).groupBy("_key").agg(F.count("*").alias("_n"))
        return repeated.agg(F.count_if(F.col("_n") > 1).alias("failures"))


Check = RowCheck | GroupCheck | UniqueCheck


def not_null(column: str) -> RowCheck:
    return RowCheck("not_null", column, F.col(column).isNotNull())


def accepted_values(column: str, values: Sequence[str]) -> RowCheck:
    return RowCheck("accepted_values", column, F.col(column).isin(list(values)))


def value_lengths_to_equal(column: str, value: int, where: Column | None = None) -> RowCheck:
    check = expression_is_true(F.length(column) == value, column, where=where)
    return RowCheck("value_lengths_to_equal", column, check.passes, check.where)


def expression_is_true(
    passes: Column, column: str = "", group_by: Sequence[str] = (), where: Column | None = None
) -> RowCheck | GroupCheck:
    if group_by:
        return GroupCheck("expression_is_true", column, passes, tuple(group_by), where)
    return RowCheck("expression_is_true", column, passes, where)


def unique(key: Column, column: str, by_hash: bool = False) -> UniqueCheck:
    return UniqueCheck("unique", column, key, by_hash)


def run_checks(rows: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """(check, column, failures), one row per check.

    All row checks share a single pass and a single-row aggregate.
    """

    def labelled(counted: DataFrame, check: Check) -> DataFrame:
        return counted.select(
            F.lit(check.name).alias("check"), F.lit(check.column).alias("column"), "failures"
        )

    parts = []
    row_checks = [c for c in checks if isinstance(c, RowCheck)]
    if row_checks:
        counts = rows.agg(*[c.failures().alias(f"_{no}") for no, c in enumerate(row_checks)])
        results = [
            F.struct(
                F.lit(c.name).alias("check"),
                F.lit(c.column).alias("column"),
                F.col(f"_{no}").alias("failures"),
            )
            for no, c in enumerate(row_checks)
        ]
        parts.append(counts.select(F.inline(F.array(*results))))
    parts += [labelled(c.failures(rows), c) for c in checks if not isinstance(c, RowCheck)]
    return reduce(DataFrame.unionByName, parts)
