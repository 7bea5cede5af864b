"""Benchmark decontamination with one Aho-Corasick automaton over normalised windows of words.

Normalising lower-cases A-Z and turns every byte that is in no word into a space. Both keep each
byte's place, so a word's place in the normalised text is its place in the original. The automaton
runs over the text's words, as numbers, once.
"""

from __future__ import annotations

import re
from functools import reduce
from itertools import islice

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from trailmark.llm.common import free_name, shared, stored, text_function, utf8

#: Normalised byte of each byte: words are of digits, letters and all bytes from 0x80.
NORMAL = bytes(b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else b + 32 if 0x41 <= b <= 0x5A else 32 for b in range(256))
#: UTF-8 bytes of benchmark texts in one automaton, which bounds what is broadcast at once. A larger
#: benchmark makes more of them, so many in one pass over the documents.
BLOCK_BYTES, BLOCKS_PER_PASS = 2 << 20, 4


class Items:
    """The windows of some benchmark items."""

    def __init__(self):
        self.numbers: dict[bytes, int] = {}
        self.windows: dict[tuple[int, ...], set[str]] = {}
        self.size = 0

    def add(self, item: str | None, text: str, window: int) -> None:
        body = text.encode()
        self.size += len(body)
        words = body.translate(NORMAL).split()
        ids = tuple(self.numbers.setdefault(w, len(self.numbers) + 1) for w in words)
        for i in range(max(1, len(ids) - window + 1) if ids else 0):
            names = self.windows.setdefault(ids[i : i + window], set())
            if item is not None:
                names.add(item)

    def automaton(self):
        """Number of each word, and the automaton; built where it runs, once in a worker."""
        if not hasattr(self, "built"):

            class Numbers(dict):
                def __missing__(self, word):
                    return 0

            machine = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
            for ids, names in self.windows.items():
                machine.add_word(ids, (len(ids), sorted(names)))
            machine.make_automaton()
            self.built = Numbers(self.numbers), machine
        return self.built

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "built"}


def blocks(benchmark: DataFrame, item_id: str, text: str, window: int):
    """The benchmark's items in bounded blocks, one at a time."""
    block = Items()
    rows = benchmark.select(F.col(item_id).cast("string"), F.col(text).alias("body")).dropna(subset=["body"])
    for item, body in rows.toLocalIterator():
        block.add(item, body, window)
        if block.size >= BLOCK_BYTES:
            yield block
            block = Items()
    if block.windows:
        yield block


FOUND = StructType([
    StructField("n_words", LongType()),
    StructField("words", ArrayType(IntegerType())),  # numbers of the hit words, rising
    StructField("spans", ArrayType(StructType([StructField("start", IntegerType()), StructField("end", IntegerType())]))),
    StructField("items", ArrayType(StringType())),
])

PARTS = ("words", "spans", "items")


def scan(body: bytes, numbers: dict, machine) -> dict:
    """What FOUND holds; spans are code points of the original text, one for each run of hit words."""
    normal = body.translate(NORMAL)
    words = normal.split()
    items, covered = set(), []
    if machine:
        for last, (size, names) in machine.iter(tuple(map(numbers.__getitem__, words))):
            covered.append((last - size + 1, last + 1))
            items.update(names)
    if not covered:
        return {"n_words": len(words), "words": [], "spans": [], "items": []}
    mark = np.zeros(len(words) + 1, np.int32)
    starts, ends = np.array(covered).T
    np.add.at(mark, starts, 1)
    np.add.at(mark, ends, -1)
    hit = np.flatnonzero(np.cumsum(mark)[:-1] > 0)
    runs = np.split(hit, np.flatnonzero(np.diff(hit) > 1) + 1)
    places = [m.span() for m in re.finditer(rb"[^ ]+", normal)]
    spans, done, points = [], 0, 0
    for run in runs:
        span = {}
        for key, at in (("start", places[run[0]][0]), ("end", places[run[-1]][1])):
            points += len(body[done:at].decode())
            done = at
            span[key] = points
        spans.append(span)
    return {"n_words": len(words), "words": hit.tolist(), "spans": spans, "items": sorted(items)}


def find_contamination(
    documents: DataFrame,
    benchmark: DataFrame,
    window: int = 13,
    share: int = 20,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    result: str = "contamination",
) -> DataFrame:
    """Documents with a struct column: n_words, n_hit, items (ids of the items with occurring windows,
    sorted as strings), spans (of the original text) and contaminated (a word is hit, and at least one
    in share).

    A window is so many consecutive words of an item, or all words of a shorter item. Items with a null
    text take no part; the windows of one with a null id mark words, but it has no name to list; items
    with the same id count as one. A null or empty text has no words and is not contaminated. Rows stay
    as they are; a column named like the result is replaced. An empty benchmark finds nothing.

    A benchmark of more blocks than one pass takes is scanned in several. Each stores what it finds by
    the text's key, two 64-bit xxHashes, once for equal texts; documents are joined with it at the end.
    """
    def scanner(block):
        def make():
            numbers, machine = block().automaton() if block else ({}, None)

            def work(texts: pa.Array) -> pa.Array:
                return pa.array([scan(x, numbers, machine) for x in utf8(texts)], FOUND_ARROW)

            return work

        return text_function(FOUND, make)

    spark = documents.sparkSession
    texts = documents.select(F.col(text).alias("text"))
    keys = [F.xxhash64(F.lit(seed), "text").alias(f"k{seed}") for seed in (1, 2)]
    all_blocks = blocks(benchmark, item_id, item_text, window)
    first = list(islice(all_blocks, BLOCKS_PER_PASS))
    earlier: list[DataFrame] = []
    while (more := next(all_blocks, None)) is not None:
        found = texts.select(*keys, *[scanner(shared(spark, x))(F.col("text")).alias(f"found{k}") for k, x in enumerate(first)])
        each = found.select("k1", "k2", F.explode(F.array(*[F.struct(*[F.col(f"found{k}")[n].alias(n) for n in PARTS]) for k in range(len(first))])).alias("x"))
        hits = each.where(F.size("x.words") > 0).select("k1", "k2", "x.*")
        earlier.append(stored(hits.dropDuplicates(["k1", "k2", "words", "items"]), "contamination-pass"))
        first = [more, *islice(all_blocks, BLOCKS_PER_PASS - 1)]
    scanned, held = documents, []
    for block in first or [None]:
        held.append(free_name(scanned, f"found{len(held)}"))
        scanned = scanned.withColumn(held[-1], scanner(shared(spark, block) if block else None)(F.col(text)))
    n_words = F.col(held[0])["n_words"]
    found = [F.col(name) for name in held]
    if earlier:
        other, k1, k2 = (free_name(scanned, n) for n in ("earlier", "k1", "k2"))
        hits = reduce(DataFrame.unionByName, earlier)
        lists = hits.groupBy("k1", "k2").agg(*[F.flatten(F.collect_list(n)).alias(n) for n in PARTS])
        lists = stored(lists.select(F.col("k1").alias(k1), F.col("k2").alias(k2), F.struct(*PARTS).alias(other)), "contamination-hits")
        of_text = [F.xxhash64(F.lit(seed), F.col(text)) for seed in (1, 2)]
        scanned = scanned.join(lists, (of_text[0] == F.col(k1)) & (of_text[1] == F.col(k2)), "left").drop(k1, k2)
        held.append(other)
        found.append(F.col(other))

    def merged(name: str):
        if len(found) == 1:
            return found[0][name]
        lists = [F.coalesce(x[name], F.array().cast(FOUND[name].dataType)) for x in found]
        return F.array_sort(F.array_distinct(F.flatten(F.array(*lists))))

    n_hit = F.size(merged("words")).cast("long")
    return scanned.withColumn(
        result,
        F.struct(
            n_words.alias("n_words"),
            n_hit.alias("n_hit"),
            merged("items").alias("items"),
            merged("spans").alias("spans"),
            ((n_hit > 0) & (n_hit * share >= n_words)).alias("contaminated"),
        ),
    ).drop(*held)


FOUND_ARROW = pa.struct([
    ("n_words", pa.int64()),
    ("words", pa.list_(pa.int32())),
    ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
    ("items", pa.list_(pa.string())),
])
