"""Exact distinct counts and conditional sums of many predicates in one pass.

Counting the distinct sessions under thirty predicates with thirty distinct
aggregates makes Spark copy every row thirty times. Here a row is copied once per
*facet* (session, channel, ...) by grouping sets. The first grouping, by keys and
facet value, folds all predicates into one bit mask and combines on the map side; the
second, by keys, counts bits. Nothing is gathered in lists, so no group is too large.

Shares of a total (a session's time, on each of its hits) are summed as whole totals by
divisor and divided once, so the result does not depend on the order of summation.
"""

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Predicates in one bit mask.
MASK_BITS = 63


@dataclass(frozen=True)
class Total:
    """Sum of a measure.

    With ``when_value``, SUM(IF(facet = when_value, measure, 0)): rows of other values
    count as 0, and only rows with a NULL measure count as nothing.
    """

    measure: str
    when_value: str | None = None


@dataclass(frozen=True)
class Facet:
    """A column to count distinct values of, or to split sums by.

    ``counts`` maps an output to the predicate a row must meet (None: any row) for its
    value to count.
    """

    value: Column
    counts: Mapping[str, Column | None] = field(default_factory=dict)
    totals: Mapping[str, Total] = field(default_factory=dict)


def facet_report(
    rows: DataFrame,
    keys: Mapping[str, Column],
    facets: Sequence[Facet],
    measures: Mapping[str, Column] | None = None,
    divisor: Column | None = None,
) -> DataFrame:
    """One row per ``keys``: the facets' counts (bigint) and totals.

    With ``divisor`` a row contributes measure / divisor to a total: measures are summed by
    facet value and divisor in a copy of the row of its own, and divided afterwards. A measure
    over zero is an error; one over NULL, or no measure, adds nothing.
    """
    measures = measures or {}
    predicates = [item for facet in facets for item in facet.counts.items()]
    bits = {name: divmod(no, MASK_BITS) for no, (name, _) in enumerate(predicates)}
    masks = [f"_mask{no}" for no in range(-(-len(predicates) // MASK_BITS))]

    def mask(no: int) -> Column:
        flags = [
            F.when(F.lit(True) if predicate is None else predicate, F.lit(1 << bits[name][1])).otherwise(F.lit(0))
            for name, predicate in predicates
            if bits[name][0] == no
        ]
        return reduce(lambda a, b: a.bitwiseOR(b), flags).cast("bigint")

    values = [f"_facet{no}" for no in range(len(facets))]
    split = [] if divisor is None else ["_divisor"]
    narrow = rows.select(
        *[column.alias(name) for name, column in keys.items()],
        *[facet.value.alias(name) for name, facet in zip(values, facets, strict=True)],
        *[divisor.alias(name) for name in split],
        *[mask(no).alias(name) for no, name in enumerate(masks)],
        *[column.alias(f"_sum_{name}") for name, column in measures.items()],
    )

    key_names = list(keys)
    by = [*values, *split]
    # The set of each facet's counts, then the sets of totals: by the facet's value only where a
    # total asks for one.
    count_sets = [[value] for value in values]
    total_sets = [
        [*([value] if any(t.when_value is not None for t in facet.totals.values()) else []), *split] if split else [value]
        for facet, value in zip(facets, values, strict=True)
    ]
    needed = [s for no, s in enumerate(count_sets) if facets[no].counts or not split]
    needed += [s for no, s in enumerate(total_sets) if facets[no].totals and s not in needed]
    sets = [s for no, s in enumerate(needed) if s not in needed[:no]]
    per_value = narrow.groupingSets([[*key_names, *s] for s in sets], *key_names, *by).agg(
        F.grouping_id().alias("_set"),
        *[F.bit_or(name).alias(name) for name in masks],
        *[F.sum(f"_sum_{name}").alias(f"_sum_{name}") for name in measures],
    )

    def within(columns: list[str]) -> Column:
        # grouping_id has a 0 bit for each column of the set, the last column lowest.
        return F.col("_set") == sum(1 << (len(by) - 1 - no) for no, name in enumerate(by) if name not in columns)

    outputs: dict[str, Column] = {}
    for no, (facet, value) in enumerate(zip(facets, values, strict=True)):
        for name in facet.counts:
            which, bit = bits[name]
            met = F.getbit(masks[which], F.lit(bit)).cast("boolean")
            outputs[name] = F.count_if(within(count_sets[no]) & F.col(value).isNotNull() & met)
        for name, total in facet.totals.items():
            amount = F.col(f"_sum_{total.measure}")
            if split:  # a measure over zero is an error; rows of the other sets have no divisor
                amount = F.when(within(total_sets[no]), amount / F.col("_divisor"))
            if total.when_value is not None:
                amount = F.when(F.col(value) == total.when_value, amount).otherwise(F.lit(0))
            outputs[name] = F.sum(F.when(within(total_sets[no]), amount))
    return per_value.groupBy(*key_names).agg(*[c.alias(name) for name, c in outputs.items()])
