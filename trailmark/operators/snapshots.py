"""Latest version of each key in a table of daily snapshots."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trailmark.operators.setops import union_distinct

PARTITION_TIME = "_PARTITIONTIME"


def latest_snapshot(
    rows: DataFrame,
    keys: Sequence[str],
    version: str = PARTITION_TIME,
    tiebreak: Sequence[str] = (),
    drop_version: bool = True,
) -> DataFrame:
    """The row with the highest ``version`` per key.

    Equal versions are decided by ``tiebreak``, by default all other columns, largest
    first. Spark plans the rank filter as a per-task group limit ahead of the shuffle,
    so a hot key sends one row per task.
    """
    tiebreak = tiebreak or [c for c in rows.columns if c not in (*keys, version)]
    newest_first = Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in (version, *tiebreak)])
    latest = rows.withColumn("_rank", F.row_number().over(newest_first)).where("_rank = 1").drop("_rank")
    return latest.drop(version) if drop_version else latest


def latest_of_accounts(accounts: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Latest rows per account table, then their distinct union.

    A key held by two accounts with different rows stays twice.
    """
    return union_distinct([latest_snapshot(rows, keys) for rows in accounts])
