"""Numbers and prefix hashes along the ordered rows of a key, however many rows one key has.

Rows are sorted by ranges of key and order, so a key may span several partitions. Each task numbers
its own rows; a range border parts at most one key, so the runs that need what stands before them
are at most two to a partition, and their offsets are found from these alone.

A prefix hash is a polynomial in the values of the rows up to it, modulo 2^61 - 1, in two bases.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from trailmark.llm.common import stored

PRIME = (1 << 61) - 1
BASES = (1_747_583_691_204_718_113, 903_418_562_377_100_849)
_P, _M30, _M31 = np.uint64(PRIME), np.uint64((1 << 30) - 1), np.uint64((1 << 31) - 1)
_30, _31, _61 = np.uint64(30), np.uint64(31), np.uint64(61)


def reduced(x: np.ndarray) -> np.ndarray:
    x = (x & _P) + (x >> _61)
    return np.where(x >= _P, x - _P, x)


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a * b modulo the prime, for numbers below it: 2^61 counts as 1."""
    ah, al, bh, bl = a >> _31, a & _M31, b >> _31, b & _M31
    middle = al * bh + ah * bl
    return reduced(ah * bh * np.uint64(2) + (middle >> _30) + ((middle & _M30) << _31) + al * bl)


class Powers:
    """Powers of a base, as many as were ever needed."""

    def __init__(self, base: int):
        self.known = np.array([1, base % PRIME], np.uint64)

    def upto(self, n: int) -> np.ndarray:
        while len(self.known) < n:
            step = times(self.known[-1:], self.known[1:2])
            self.known = np.concatenate([self.known, times(self.known, step)])
        return self.known[:n]


def running(terms: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of the terms since place first (of each), modulo the prime."""
    low = np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms & _M31)])
    high = np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms >> _31)])
    low, high = low[1:] - low[first], high[1:] - high[first]
    return reduced(times(reduced(high), np.uint64(1 << 31)) + reduced(low))


def _local(key: str, values: Sequence[str], fields: list[str]):
    """Numbers the rows of sorted partitions, and hashes them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        powers = [Powers(b) for b in BASES[: len(values)]]
        current, count, sums = None, 0, [0] * len(values)
        for batch in batches:
            size = batch.num_rows
            if not size:
                continue
            keys = batch.column(batch.schema.get_field_index(key))
            differs = np.ones(size, bool)
            if size > 1:
                differs[1:] = pc.not_equal(keys[1:], keys[:-1]).to_numpy(zero_copy_only=False)
            goes_on = keys[0].as_py() == current
            starts = np.flatnonzero(differs)
            lengths = np.diff(np.append(starts, size))
            first = np.repeat(starts, lengths)
            base = np.zeros(size, np.int64)
            if goes_on:
                base[: lengths[0]] = count
            place = np.arange(size) - first + base
            columns = [pa.array(np.full(size, part, np.int32)), pa.array(place)]
            after = []
            for which, name in enumerate(values):
                value = reduced(batch.column(batch.schema.get_field_index(name)).to_numpy(zero_copy_only=False).view(np.uint64))
                # Rows count from 1, so that a row of value 0 is not lost.
                value = reduced(value + np.uint64(1))
                here = running(times(value, powers[which].upto(int(place.max()) + 1)[place]), first)
                if goes_on:
                    here[: lengths[0]] = reduced(here[: lengths[0]] + np.uint64(sums[which]))
                before = np.zeros(size, np.uint64)
                before[1:] = np.where(differs[1:], 0, here[:-1])
                if goes_on:
                    before[0] = sums[which]
                after.append(int(here[-1]))
                columns += [pa.array(here.astype(np.int64)), pa.array(before.astype(np.int64))]
            current, count, sums = keys[size - 1].as_py(), int(place[-1]) + 1, after
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=fields)

    return run


def _folded(runs: list, values: Sequence[str]) -> list[tuple]:
    """(key, part, rows before, hashes before) of runs that follow another run of their key."""
    found, last, n, sums = [], object(), 0, [0] * len(values)
    for run in sorted(runs, key=lambda r: (r[0], r[1])):
        if run[0] != last:
            last, n, sums = run[0], 0, [0] * len(values)
        if n:
            found.append((run[0], run[1], n, *sums))
        sums = [(s + pow(b, n, PRIME) * h) % PRIME for s, b, h in zip(sums, BASES, run[3:], strict=False)]
        n += run[2]
    return found


def scanned(rows: DataFrame, key: str, order: Sequence[str], values: Sequence[str] = ()) -> DataFrame:
    """The rows with `place` (0 for the first of a key in the order), `total` (rows of the key) and, for
    each value column (a long), `hash_` and `before_`: the prefix hashes with and without the row.

    Keys are not null. Rows that are equal in key and order are numbered in any order. The result is
    made from a stored table.
    """
    names = [n for v in values for n in (f"hash_{v}", f"before_{v}")]
    fields = [*rows.schema.fields, StructField("part", IntegerType()), StructField("place", LongType())]
    fields += [StructField(n, LongType()) for n in names]
    ordered = rows.repartitionByRange(key, *order).sortWithinPartitions(key, *order)
    found = ordered.mapInArrow(_local(key, values, [f.name for f in fields]), StructType(fields))
    local = stored(found, "scanned")
    runs = local.groupBy(key, "part").agg(
        F.count("*").alias("n"), *[F.max_by(f"hash_{v}", "place").alias(f"hash_{v}") for v in values]
    )
    runs = stored(runs, "scanned-runs")
    totals = runs.groupBy(key).agg(F.sum("n").alias("total"), F.count("*").alias("runs"))
    # Keys of several runs span range borders: there are fewer of them than partitions.
    spanning = runs.join(totals.where("runs > 1").select(key), key, "left_semi")
    offsets = _folded([tuple(r) for r in spanning.select(key, "part", "n", *[f"hash_{v}" for v in values]).collect()], values)
    of_run = runs.select(key, "part").join(totals.select(key, "total"), key)
    numbered = local.join(of_run, [key, "part"])
    if not offsets:
        return numbered.drop("part")
    schema = StructType(
        [local.schema[key], local.schema["part"], StructField("n_before", LongType())]
        + [StructField(f"off_{v}", LongType()) for v in values]
    )
    added = F.broadcast(rows.sparkSession.createDataFrame(offsets, schema))
    return _shifted(numbered.join(added, [key, "part"], "left"), values)


def _shifted(rows: DataFrame, values: Sequence[str]) -> DataFrame:
    """Rows of runs that go on: their places and hashes move behind what stands before them."""
    names = ["place", "n_before", *[n for v in values for n in (f"hash_{v}", f"before_{v}", f"off_{v}")]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = dict(zip(batch.schema.names, batch.columns, strict=True))
            moved = np.flatnonzero(columns["n_before"].is_valid().to_numpy(zero_copy_only=False))
            if len(moved):
                for which, v in enumerate(values):
                    n = columns["n_before"].take(pa.array(moved)).to_numpy()
                    each, back = np.unique(n, return_inverse=True)
                    power = np.array([pow(BASES[which], int(x), PRIME) for x in each], np.uint64)[back]
                    off = columns[f"off_{v}"].take(pa.array(moved)).to_numpy().view(np.uint64)
                    for name in (f"hash_{v}", f"before_{v}"):
                        whole = columns[name].to_numpy().copy().view(np.uint64)
                        whole[moved] = reduced(times(whole[moved], power) + off)
                        columns[name] = pa.array(whole.view(np.int64))
                columns["place"] = pc.add(columns["place"], pc.fill_null(columns["n_before"], 0))
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    assert set(names) <= set(rows.columns)
    return rows.mapInArrow(run, rows.schema).drop("part", "n_before", *[f"off_{v}" for v in values])
