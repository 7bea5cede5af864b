"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints that differ in at most R bits have a value in between: at most R // 2 bits from
the one, at most the rest from the other. So each fingerprint emits every value within half the
radius (rounded up), and the shuffle brings together those that share a value. Of a value's
fingerprints the ones within R // 2 bits are near; all are within R of every near one. Linking
each to the value's least near one keeps every component without emitting all pairs. Few
fingerprints exist within half the radius of a value (2,081 for R = 3), so a group is bounded.

Most fingerprints have no partner, and their values would fill the shuffle for nothing. A semi
join finds those that have one first: split in two halves, one half differs in at most R // 2
bits, so it meets the partner's half within that ball, and the whole distance is checked there.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType
from pyspark.sql.window import Window

from trailmark.llm.common import LOWER, free_name, stored, text_function, utf8
from trailmark.llm.components import components

#: Shingles whose bits are counted at once.
RUN = 1 << 16


def fingerprint(text: bytes, shingle: int) -> int:
    """A bit is 1 if it is set in over half of the shingles' hashes; without words zero. Signed."""
    words = text.translate(LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    starts = np.cumsum([0] + [len(w) + 1 for w in words]).tolist()
    count = max(1, len(words) - shingle + 1)
    ends = starts[shingle:] if len(words) >= shingle else [starts[-1]]
    bits = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, count, RUN):
        hashes = [digest(joined[a : b - 1], 42) for a, b in zip(starts[at : min(count, at + RUN)], ends[at : at + RUN], strict=True)]
        octets = np.array(hashes, np.uint64).view(np.uint8).reshape(-1, 8)
        bits += np.unpackbits(octets, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * bits > count, bitorder="little").view(np.int64)[0])


def fingerprints(text: Column, shingle: int) -> Column:
    def make():
        def work(texts: pa.Array) -> pa.Array:
            return pa.array([fingerprint(x, shingle) for x in utf8(texts)], pa.int64())

        return work

    return text_function(LongType(), make)(text)


def ball(bits: int, radius: int) -> list[tuple[int, int]]:
    """(mask, flipped bits) of all values within the radius of a value of so many bits."""
    masks = []
    for k in range(radius + 1):
        for places in combinations(range(bits), k):
            mask = sum(1 << p for p in places)
            masks.append((mask - (1 << 64) if mask >= 1 << 63 else mask, k))
    return masks


def _emitted(values: DataFrame, value: Column, bits: int, radius: int) -> DataFrame:
    """Each row once for each value in the ball, with key and flips. The masks are one constant."""
    masks = ball(bits, radius)
    numbers = F.split(F.lit(",".join(str(m) for m, _ in masks)), ",").cast("array<bigint>")
    flips = F.split(F.lit(",".join(str(k) for _, k in masks)), ",").cast("array<int>")
    ringed = F.explode(F.arrays_zip(numbers.alias("mask"), flips.alias("flips")))
    return values.withColumn("_x", ringed).select("*", value.bitwiseXOR(F.col("_x.mask")).alias("key"), F.col("_x.flips").alias("flips")).drop("_x")


def with_partner(prints: DataFrame, radius: int) -> DataFrame:
    """The distinct fingerprints fp that another one lies within the radius of."""
    low, high = F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned("fp", 32)
    halves = prints.select("fp", F.explode(F.array(low, high.bitwiseOR(F.lit(1 << 32)))).alias("half"))
    rings = _emitted(halves, F.col("half"), 32, radius // 2).select("fp", "key")
    others = halves.select(F.col("fp").alias("other"), F.col("half").alias("key"))
    near = F.bit_count(F.col("fp").bitwiseXOR(F.col("other")))
    return rings.join(others, (rings["key"] == others["key"]) & (near > 0) & (near <= radius), "left_semi").select("fp").distinct()


def ball_links(prints: DataFrame, radius: int) -> DataFrame:
    """Links (a, b) between distinct fingerprints fp that join those within the radius of each other."""
    near_radius = radius // 2
    # Few rows become many: spread them first.
    spread = prints.repartition(int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions")), "fp")
    emitted = _emitted(spread, F.col("fp"), 64, radius - near_radius)
    near = F.when(F.col("flips") <= near_radius, F.col("fp"))
    groups = (
        emitted.groupBy("key")
        .agg(F.min(near).alias("a"), F.collect_list("fp").alias("members"))
        .where(F.col("a").isNotNull() & (F.size("members") > 1))
    )
    links = groups.select("a", F.explode("members").alias("b")).where(F.col("a") != F.col("b")).distinct()
    return links.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius)


def near_duplicates(
    documents: DataFrame, radius: int = 3, shingle: int = 3, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc_id, fp, component_id, component) for every document: its fingerprint, the least doc_id that
    links of at most radius differing bits reach from it, itself included, and the least fingerprint.

    A null text or one without words has fingerprint zero and links like any other. Null ids are
    never a component's id (if all are null, the id is null); rows with repeated ids each get a
    row; other columns are left out. An empty table gives an empty table.
    """
    prints = stored(
        documents.select(F.col(doc_id).alias("doc_id"), fingerprints(F.col(text), shingle).alias("fp")), "fingerprints"
    )
    classes = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "fingerprint-classes")
    joined = components(ball_links(stored(with_partner(classes.select("fp"), radius), "partners"), radius))
    rooted = joined.join(classes, joined["node"] == classes["fp"]).select("fp", "root", "least")
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    found = rooted.select("fp", "root").join(least, "root")
    of_class = stored(
        classes.join(found, "fp", "left").select(
            "fp",
            F.when(F.col("root").isNull(), F.col("least")).otherwise(F.col("component_id")).alias("component_id"),
            F.coalesce("root", "fp").alias("component"),
        ),
        "class-components",
    )
    return prints.join(of_class, "fp").select("doc_id", "fp", "component_id", "component")


def keep_one(documents: DataFrame, radius: int = 3, shingle: int = 3, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Documents without near-duplicates: one of each component stays, that with the least id. Of several
    rows with that id, or of rows with null ids where no other is there, the one with the least
    fingerprint stays, then with the least text. Columns are those of documents.
    """
    found = stored(near_duplicates(documents, radius, shingle, doc_id, text), "near-duplicates")
    kept_id, kept_fp, fp, rank = (free_name(documents, n) for n in ("kept_id", "kept_fp", "fp", "rank"))
    first = found.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    chosen = first.groupBy("component").agg(F.min("doc_id").alias(kept_id), F.min("fp").alias(kept_fp))
    rows = found.groupBy("doc_id").agg(F.count("*").alias("rows"))
    repeats = (F.col("rows") > 1) | F.col(kept_id).isNull()
    kept = chosen.join(rows, F.col(kept_id).eqNullSafe(F.col("doc_id"))).select(kept_id, kept_fp, repeats.alias("repeated"))
    kept = stored(kept, "kept-ids")

    def of_id(some: DataFrame) -> DataFrame:
        return documents.join(some.select(kept_id).distinct(), F.col(doc_id).eqNullSafe(F.col(kept_id)), "left_semi")

    repeated = kept.where("repeated").select(kept_id, kept_fp)
    if repeated.isEmpty():
        return of_id(kept)
    # An id alone does not tell these rows apart: their fingerprints do.
    printed = of_id(repeated).withColumn(fp, fingerprints(F.col(text), shingle))
    same = F.col(doc_id).eqNullSafe(F.col(kept_id)) & (F.col(fp) == F.col(kept_fp))
    rest = [F.col(c) for c in documents.columns if c not in (doc_id, text)]
    order = Window.partitionBy(doc_id, fp).orderBy(F.col(text).asc_nulls_last(), *rest)
    ranked = printed.join(repeated, same, "left_semi").withColumn(rank, F.row_number().over(order))
    return of_id(kept.where("NOT repeated")).unionByName(ranked.where(F.col(rank) == 1).drop(rank, fp))
