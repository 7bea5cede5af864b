"""Lookups in arrays of (index, value) pairs."""

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def kv_lookup(pairs: Column, keys: Sequence[int], strict: bool = True) -> Column:
    """Value of the first of ``keys`` present with a value, else NULL.

    ``pairs`` is ``array<struct<index, value>>``. In strict mode a key that
    occurs twice in one array is an error; otherwise its first entry is taken.
    """

    def one(key: int) -> Column:
        found = F.filter(pairs, lambda pair: pair["index"] == key)
        value = F.get(found, F.lit(0))["value"]
        if not strict:
            return value
        error = F.raise_error(F.lit(f"index {key} occurs more than once"))
        return F.when(F.size(found) > 1, error.cast("string")).otherwise(value)

    return F.coalesce(*[one(key) for key in keys])
