"""Classification and splitting of text codes."""

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def classify_prefix(value: Column, rules: Iterable[tuple[str, str]]) -> Column:
    """Code of the first rule whose LIKE prefix matches, else NULL."""
    (prefix, code), *rest = rules
    result = F.when(value.like(prefix + "%"), code)
    for prefix, code in rest:
        result = result.when(value.like(prefix + "%"), code)
    return result


def split_field(value: Column, separator: str, position: int, strict: bool = True) -> Column:
    """Field ``position`` (from 0) of a separated text.

    A missing field is an error in strict mode (under ANSI), else NULL.
    """
    parts = F.split(value, "\\Q" + separator + "\\E")
    return parts[position] if strict else F.get(parts, F.lit(position))


def joined_key(*parts: Column, separator: str = "-") -> Column:
    """Composite text key; NULL as soon as one part is NULL."""
    pieces: list[Column] = []
    for part in parts:
        pieces += [part.cast("string"), F.lit(separator)]
    return F.concat(*pieces[:-1])
