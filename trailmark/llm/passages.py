"""Passages that repeat across documents, by an anchored, hash-compared suffix sort.

A passage is a string of `width` bytes; it is removed where a document of a smaller id holds it too.
Sorting every suffix of a corpus would shuffle each byte many times, so suffixes are first cut down
to those that can matter. Copies of a whole text with a larger id go as a whole, and only the first takes
part. Of the grams (over half of the width) inside a window, the one of least hash is the window's
anchor: equal windows have equal anchors at equal places, so a window can only repeat if its anchor
does. Anchors are one in twelve bytes. Their hashes meet by a bucket of each, packed in rows of a chunk
of texts, each with the place it came from; those of a hash that two documents hold are sent back to
their chunk, the others go. So no filter or join has to tell them, whatever the input's size.

The rest are gathered with their surroundings, all bytes that any of their windows covers. Equal
surroundings are one row with the least document id, so that copies by the thousand are reduced ahead
of the shuffle. Where an anchor has several surroundings, their windows are the suffixes to sort: a
merge sort, merging by binary search, whose comparisons find the common extension of two suffixes
by binary search on prefix polynomial hashes (modulo 2^64). The sorted order is then verified on the
bytes of all neighbours, and sorted anew with another base if a collision misled it. Runs of equal
windows take the least id of their members.

An anchor with very many surroundings is not sorted in one task: its windows are grouped by their bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import (
    ArrayType, BinaryType, IntegerType, LongType, StructField, StructType,
)

from trailmark.llm.common import discard, free_name, stored, utf8
from trailmark.operators.bitfilter import bit_filter, passes

BASE = 0x9E3779B97F4A7C15
MIX = 0xD6E8FEB86659FD93
#: Bytes hashed together; a place among them and a hash share 64 bits.
BLOCK_BYTES, PLACE_BITS = 1 << 17, 20
#: Surroundings sorted together, about, and of one anchor at most; above that their windows are grouped.
SORTED_TOGETHER, SORTED_AT_MOST = 1 << 13, 1 << 14
#: 64-bit words of the filter of copies (2 MB), whatever the input.
COPY_WORDS = 1 << 18
#: Numbers that share a column have so many bits each.
PACKED_BITS = 10
#: Bytes of text, and documents at most, whose anchors are packed together; a bucket's row of them.
CHUNK_BYTES, CHUNK_TEXTS = 1 << 23, 1 << 16
#: Buckets of anchors, a power of two: so many at least, and so many times the shuffle's partitions.
LEAST_BUCKETS, BUCKETS_EACH = 1 << 10, 4
#: A packed anchor: bytes of its hash (beside the bucket's bits), of its document's number in the chunk, and of
#: its place in the chunk with the offsets.
HASH_BYTES, NUMBER_BYTES, AT_BYTES = 5, 2, 6
ANCHOR_BYTES = HASH_BYTES + NUMBER_BYTES + AT_BYTES


class Powers:
    """Powers modulo 2^64 of an odd base and of its inverse."""

    def __init__(self, base: int = BASE):
        self.base, self.up, self.down = base | 1, np.ones(1, np.uint64), np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            for name, base in (("up", self.base), ("down", pow(self.base, -1, 1 << 64))):
                factors = np.full(2 * n, base, np.uint64)
                factors[0] = 1
                setattr(self, name, np.multiply.accumulate(factors))
        return self.up[:n], self.down[:n]


def gram_hashes(data: np.ndarray, size: int, powers: Powers) -> np.ndarray:
    """A mixed hash of the bytes from each place on, as many as there are whole grams."""
    up, down = powers.upto(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:-1], out=sums[1:])
    n = len(data) - size + 1
    x = (sums[size:] - sums[:n]) * down[:n]
    x = (x ^ (x >> np.uint64(32))) * np.uint64(MIX)
    return x ^ (x >> np.uint64(29))


def sliding_least(x: np.ndarray, size: int) -> np.ndarray:
    """The least of each run of so many values."""
    have = 1
    while have < size:
        step = min(have, size - have)
        x = np.minimum(x[:-step], x[step:])
        have += step
    return x


def anchors(texts: list[bytes], width: int, gram: int, powers: Powers) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, gram's hash, place, least and largest offset of the windows that it anchors) of the texts'
    anchors; a window starts its offset before the anchor. Together no longer than a block, about.
    """
    data = np.frombuffer(b"".join(texts), np.uint8)
    edges = np.cumsum([0, *map(len, texts)])
    none = np.zeros(0, np.int64)
    if len(data) < width:
        return none, none.astype(np.uint64), none, none, none
    hashes = gram_hashes(data, gram, powers)
    mask = np.uint64((1 << PLACE_BITS) - 1)
    least = sliding_least((hashes & ~mask) | np.arange(len(hashes), dtype=np.uint64), width - gram + 1)
    owner = np.repeat(np.arange(len(texts)), np.diff(edges))[: len(least)]
    window = np.flatnonzero(np.arange(width, width + len(least)) <= edges[owner + 1])
    if not len(window):
        return none, none.astype(np.uint64), none, none, none
    anchor = (least[window] & mask).astype(np.int64)
    starts = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
    first, last = window[starts], window[np.append(starts[1:], len(window)) - 1]
    place = anchor[starts]
    text = owner[first]
    return text, hashes[place], place - edges[text], place - last, place - first


def blocks(texts: list[bytes], width: int) -> Iterator[list[tuple[int, int, bytes]]]:
    """The texts (number, start, bytes) in blocks; long ones in slices that share all but a byte of a window."""
    block, size = [], 0
    for i, text in enumerate(texts):
        for start in range(0, max(len(text) - width + 1, 0), BLOCK_BYTES):
            part = text[start : start + BLOCK_BYTES + width - 1] if len(text) > BLOCK_BYTES else text
            if size + len(part) > 2 * BLOCK_BYTES:
                yield block
                block, size = [], 0
            block.append((i, start, part))
            size += len(part)
            if part is text:
                break
    if block:
        yield block


def merge_sorted(data: np.ndarray, start: np.ndarray, group: np.ndarray, width: int, base: int) -> np.ndarray:
    """The order of the suffixes, those of a group together (they come so), by their first width bytes."""
    up, down = Powers(base).upto(len(data) + 1)
    # The hash of data[:n]; that of a part is whole[end] - whole[begin] * base ** size.
    whole = np.zeros(len(data) + 1, np.uint64)
    whole[1:] = np.cumsum((data.astype(np.uint64) + np.uint64(1)) * down[:-1]) * up[:-1]
    steps = [1 << k for k in range(width.bit_length() - 1, -1, -1)]

    def common(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Bytes that the suffixes share, width at most."""
        n = np.zeros(len(x), np.int64)
        for step in steps:
            fits = n + step <= width
            a, b = x + n, y + n
            shift = np.where(fits, step, 0)
            same = whole[a + shift] - whole[a] * up[step] == whole[b + shift] - whole[b] * up[step]
            n += np.where(fits & same, step, 0)
        return n

    def follows(x: np.ndarray, y: np.ndarray, or_equal: np.ndarray) -> np.ndarray:
        """Whether y comes before x, or equals it."""
        n = common(x, y)
        at = np.minimum(n, width - 1)
        return np.where(n == width, or_equal, data[y + at] < data[x + at])

    bounds = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    sizes = np.diff(np.append(bounds, len(group)))
    origin, size = np.repeat(bounds, sizes), np.repeat(sizes, sizes)
    order = np.arange(len(start))
    run = 1
    while run < sizes.max(initial=0):
        at = np.flatnonzero(size > run)
        rank = at - origin[at]
        pair = rank - rank % (2 * run)
        right = rank - pair >= run
        other = np.where(right, pair, pair + run)
        low, high = np.zeros(len(at), np.int64), np.clip(size[at] - other, 0, run)
        mine, there = start[order[at]], origin[at] + other
        open_ = np.flatnonzero(low < high)
        while len(open_):
            middle = (low[open_] + high[open_]) // 2
            less = follows(mine[open_], start[order[there[open_] + middle]], right[open_])
            low[open_] = np.where(less, middle + 1, low[open_])
            high[open_] = np.where(less, high[open_], middle)
            open_ = open_[low[open_] < high[open_]]
        merged = order.copy()
        merged[origin[at] + pair + (rank - pair) % run + low] = order[at]
        order = merged
        run *= 2
    return order


def equal_to_previous(data: np.ndarray, start: np.ndarray, group: np.ndarray, width: int) -> np.ndarray | None:
    """Whether each sorted suffix equals the one before it, compared byte by byte; None if some are out of order."""
    same = np.zeros(len(start), bool)
    for at in range(1, len(start), 1 << 14):
        here = np.arange(at, min(len(start), at + (1 << 14)))
        here = here[group[here] == group[here - 1]]
        x, y = (data[start[i][:, None] + np.arange(width)] for i in (here - 1, here))
        differs = x != y
        place = differs.argmax(1)
        rows = np.arange(len(here))
        same[here] = ~differs[rows, place]
        if (x[rows, place] > y[rows, place]).any():
            return None
    return same


def least_rows(texts: list[bytes], group: np.ndarray, left: np.ndarray, low: np.ndarray, high: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """For every window of the surroundings, in their order and rising offsets: (surroundings' number,
    the least number of those in its group with an equal window of that offset).
    """
    data = np.frombuffer(b"".join(texts), np.uint8)
    begin = np.cumsum([0, *map(len, texts)])[:-1]
    count = high - low + 1
    row = np.repeat(np.arange(len(texts)), count)
    offset = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count) + low[row]
    key = group[row] << PACKED_BITS | offset
    together = np.argsort(key, kind="stable")
    start, key = (begin + left)[row][together] - offset[together], key[together]
    base = BASE
    while True:
        order = merge_sorted(data, start, key, width, base)
        same = equal_to_previous(data, start[order], key, width)
        if same is not None:
            break
        base = base * 5 + 2
    runs = np.flatnonzero(~same)
    least = np.minimum.reduceat(row[together][order], runs)
    found = np.empty(len(row), np.int64)
    found[together[order]] = np.repeat(least, np.diff(np.append(runs, len(row))))
    return row, found


def whole_groups(batches: Iterator[pa.RecordBatch], key: str, least: int) -> Iterator[pa.Table]:
    """The rows, which come sorted by the key, in tables of whole groups, of so many rows or more but the last."""
    waiting = None
    for batch in batches:
        if not batch.num_rows:
            continue
        more = pa.Table.from_batches([batch])
        waiting = pa.concat_tables([waiting, more]) if waiting is not None else more
        if len(waiting) < least:
            continue
        keys = waiting[key].to_numpy()
        whole = int(np.searchsorted(keys, keys[-1]))  # the last group may go on
        if whole:
            yield waiting.slice(0, whole)
            waiting = waiting.slice(whole)
    if waiting is not None and len(waiting):
        yield waiting


def bytes_of(numbers: np.ndarray, size: int) -> np.ndarray:
    """The numbers' lowest bytes, a row each."""
    return numbers.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :size]


def numbers_of(rows: np.ndarray) -> np.ndarray:
    """The numbers whose lowest bytes are the rows."""
    whole = np.zeros((len(rows), 8), np.uint8)
    whole[:, : rows.shape[1]] = rows
    return whole.view("<u8").reshape(-1).astype(np.uint64)


def packed_rows(sizes: np.ndarray, records: np.ndarray) -> pa.Array:
    """Binaries of so many records each."""
    edges = np.concatenate([[0], np.cumsum(sizes)]) * records.shape[1]
    if edges[-1] >= 1 << 31:
        raise ValueError("a batch's texts are too long to be handled together")
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(edges.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(records))])


def unpacked(column: pa.ChunkedArray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(records in each binary, all records as rows of bytes)."""
    values = column.to_pylist()
    return np.array([len(x) // size for x in values], np.int64), np.frombuffer(b"".join(values), np.uint8).reshape(-1, size)


def bucketed(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, the bits beside it) of anchors' hashes, which are small as the least of many."""
    x = hashes * np.uint64(BASE)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(MIX)
    return (x >> np.uint64(64 - bits)).astype(np.int64), x << np.uint64(bits) >> np.uint64(64 - 8 * HASH_BYTES)


class Chunk:
    """The anchors of some texts, and whose texts they are."""

    def __init__(self) -> None:
        self.size, self.number, self.ids, self.versions, self.starts, self.begins, self.anchors = 0, 0, [], [], [], [], []

    def add(self, block: list[tuple[int, int, bytes]], continues: bool, batch: pa.RecordBatch, found: tuple[np.ndarray, ...]) -> None:
        """A block of the batch's texts with its anchors; continues: its first text is the last block's last."""
        which, hashes, place, low, high = found
        text = np.array([i for i, _, _ in block])
        numbers = self.number + np.cumsum(np.concatenate([[0 if continues else 1], text[1:] != text[:-1]]))
        begins = self.size + np.cumsum([0, *(len(part) for _, _, part in block)])
        at = (begins[which] + place) << 2 * PACKED_BITS | low << PACKED_BITS | high
        self.anchors.append((hashes, numbers[which], at))
        self.ids.append(batch.column(0).take(pa.array(text)))
        self.versions.append(batch.column(1).take(pa.array(text)))
        self.starts += [start for _, start, _ in block]
        self.begins += begins[:-1].tolist()
        self.size, self.number = int(begins[-1]), int(numbers[-1])

    def rows(self, number: int, bits: int, names: list[str]) -> pa.RecordBatch:
        """A row for each bucket, and one of the texts. number: that of the chunk."""
        texts = [pa.concat_arrays(self.ids), pa.concat_arrays(self.versions), pa.array(self.starts, pa.int64()), pa.array(self.begins, pa.int64())]
        # A task that runs again may meet its rows in another order: its chunks are others then.
        known = hashlib.blake2b(repr((number, [x.to_pylist() for x in texts])).encode(), digest_size=8)
        chunk = int.from_bytes(known.digest(), "little", signed=True)
        hashes, numbers, at = (np.concatenate(x) for x in zip(*self.anchors, strict=True))
        bucket, rest = bucketed(hashes, bits)
        order = np.argsort(bucket.astype(np.uint16 if bits <= 16 else np.int64), kind="stable")
        records = np.concatenate([bytes_of(rest, HASH_BYTES), bytes_of(numbers, NUMBER_BYTES), bytes_of(at, AT_BYTES)], 1)[order]
        sizes = np.bincount(bucket, minlength=1)
        some = np.flatnonzero(sizes)
        edges = pa.array(np.append(0, np.full(len(some) + 1, len(self.starts))), pa.int32())
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.append(chunk & ((1 << bits) - 1), some), pa.int32()), pa.array(np.full(len(some) + 1, chunk)),
                packed_rows(np.append(0, sizes[some]), records), *(pa.ListArray.from_arrays(edges, x) for x in texts),
            ],
            names=names,
        )


def _chunk_type(bodies: DataFrame) -> StructType:
    id_type = bodies.schema["doc_id"].dataType
    lists = {"ids": id_type, "versions": LongType(), "starts": LongType(), "begins": LongType()}
    texts = [StructField(k, ArrayType(kind)) for k, kind in lists.items()]
    return StructType([StructField("chunk", LongType()), StructField("anchors", BinaryType()), *texts])


def _packed_anchors(bodies: DataFrame, width: int, gram: int, bits: int) -> DataFrame:
    """(bucket, chunk, anchors, ids, versions, starts, begins) of (doc_id, version, text): the packed anchors of a
    chunk of texts in a bucket, and a row without anchors of each chunk's texts: whose, from where in the
    text, from where in the chunk.
    """
    schema = StructType([StructField("bucket", IntegerType()), *_chunk_type(bodies).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, chunk, number = Powers(), Chunk(), TaskContext.get().partitionId() << 40
        for batch in batches:
            last = -1
            for block in blocks(utf8(batch.column(2)), width):
                if chunk.size and (chunk.size >= CHUNK_BYTES or chunk.number + len(block) >= CHUNK_TEXTS):
                    yield chunk.rows(number, bits, schema.names)
                    chunk, number, last = Chunk(), number + 1, -1
                chunk.add(block, block[0][0] == last, batch, anchors([b for _, _, b in block], width, gram, powers))
                last = block[-1][0]
        if chunk.size:
            yield chunk.rows(number, bits, schema.names)

    return bodies.select("doc_id", "version", "text").mapInArrow(run, schema)


def _shared_anchors(packed: DataFrame) -> DataFrame:
    """(chunk, anchors, ids, versions, starts, begins): the places and offsets of anchors whose hash two documents
    of the chunks hold; the rows of texts as they are.
    """
    schema = StructType([f for f in packed.schema.fields if f.name != "bucket"])

    def work(rows: pa.Table) -> pa.RecordBatch:
        bucket = rows["bucket"].to_numpy()
        group = np.cumsum(np.concatenate([[0], bucket[1:] != bucket[:-1]])).astype(np.uint64)
        sizes, records = unpacked(rows["anchors"], ANCHOR_BYTES)
        row = np.repeat(np.arange(len(rows)), sizes)
        key = numbers_of(records[:, :HASH_BYTES]) | group[row] << np.uint64(8 * HASH_BYTES)
        order = np.argsort(key)
        ordered = key[order]
        same = np.concatenate([[False], ordered[1:] == ordered[:-1]])
        # Of the hashes that come twice or more, the documents; a row is all that a chunk has in a bucket.
        again = np.flatnonzero(same | np.append(same[1:], False))
        order, first = order[again], np.flatnonzero(~same[again])
        wanted = np.zeros(len(row), bool)
        if len(order):
            numbers = numbers_of(records[order, HASH_BYTES : HASH_BYTES + NUMBER_BYTES])
            document = row[order] << 8 * NUMBER_BYTES | numbers.astype(np.int64)
            several = np.minimum.reduceat(document, first) < np.maximum.reduceat(document, first)
            wanted[order] = np.repeat(several, np.diff(np.append(first, len(order))))
        found = np.bincount(row[wanted], minlength=len(rows))
        rows = rows.set_column(rows.schema.get_field_index("anchors"), "anchors", packed_rows(found, records[wanted, HASH_BYTES + NUMBER_BYTES :]))
        rows = rows.filter(pa.array((found > 0) | (sizes == 0))).select(schema.names).combine_chunks()
        return pa.RecordBatch.from_arrays([c.chunk(0) if c.num_chunks else pa.array([], c.type) for c in rows.columns], names=schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from map(work, whole_groups(batches, "bucket", 1))

    return packed.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, schema)


def _document_anchors(shared: DataFrame) -> DataFrame:
    """(row, doc_id, version, ats) of the chunks' shared anchors: their places in the text with the offsets
    packed behind. Rows are numbered; a text in several slices has several.
    """
    id_type = shared.schema["ids"].dataType.elementType
    schema = StructType([
        StructField("row", LongType()), StructField("doc_id", id_type), StructField("version", LongType()), StructField("ats", ArrayType(LongType())),
    ])

    def work(rows: pa.Table, number: int) -> pa.RecordBatch:
        """Of one chunk."""
        if np.count_nonzero(np.diff(rows["ids"].combine_chunks().offsets.to_numpy())) != 1:
            raise RuntimeError("a chunk's texts are not there once: its task ran again with rows in another order")
        _, records = unpacked(rows["anchors"], AT_BYTES)
        at = np.sort(numbers_of(records).astype(np.int64))
        ids, versions, starts, begins = (rows[k].combine_chunks().flatten() for k in ("ids", "versions", "starts", "begins"))
        starts, begins = starts.to_numpy(), begins.to_numpy()
        text = np.searchsorted(begins, at >> 2 * PACKED_BITS, "right") - 1
        at = at + ((starts - begins)[text] << 2 * PACKED_BITS)
        with_any, first = np.unique(text, return_index=True)
        lists = pa.ListArray.from_arrays(pa.array(np.append(first, len(at)), pa.int32()), pa.array(at))
        which = pa.array(with_any)
        return pa.RecordBatch.from_arrays([pa.array(number + np.arange(len(with_any))), ids.take(which), versions.take(which), lists], names=schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 40
        for rows in whole_groups(batches, "chunk", 1):
            chunk = rows["chunk"].to_numpy()
            edges = np.flatnonzero(np.concatenate([[True], chunk[1:] != chunk[:-1], [True]]))
            for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                found = work(rows.slice(a, b - a), number)
                number += found.num_rows
                yield found

    return shared.repartition("chunk").sortWithinPartitions("chunk").mapInArrow(run, schema)


def _surroundings(width: int, gram: int):
    """A column function of texts and their anchors' places: (place, span, bytes) of each."""
    shape = StructType([StructField("place", LongType()), StructField("span", IntegerType()), StructField("around", BinaryType())])
    mask, few, most = (1 << 2 * PACKED_BITS) - 1, (1 << PACKED_BITS) - 1, width - gram

    def cut(texts: pa.Array, ats: pa.Array) -> pa.Array:
        bodies = utf8(texts)
        flat = ats.flatten().to_numpy()
        size = np.diff(ats.offsets.to_numpy())
        owner = np.repeat(np.arange(len(bodies)), size)
        place = flat >> 2 * PACKED_BITS
        low, high = flat >> PACKED_BITS & few, flat & few
        # The bytes that windows of any offset cover, of which those of these offsets stay.
        data = np.frombuffer(b"".join([bytes(most), *bodies, bytes(width)]), np.uint8)
        begin = np.cumsum([0, *map(len, bodies)])[:-1][owner] + place
        sizes = high + width - low
        around = np.empty((int(sizes.sum()), 1), np.uint8)
        column, done = np.arange(most + width), 0
        for i in range(0, len(begin), 1 << 14):
            here = slice(i, i + (1 << 14))
            covered = (column >= most - high[here, None]) & (column < most + width - low[here, None])
            kept = np.lib.stride_tricks.sliding_window_view(data, most + width)[begin[here]][covered]
            around[done : done + len(kept), 0] = kept
            done += len(kept)
        # A span is the bytes before the anchor, then the offsets.
        span = high << 2 * PACKED_BITS | flat & mask
        rows = pa.StructArray.from_arrays([pa.array(place), pa.array(span, pa.int32()), packed_rows(sizes, around)], names=[f.name for f in shape.fields])
        return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *size]), pa.int32()), rows)

    cut.__annotations__ = {"texts": pa.Array, "ats": pa.Array, "return": pa.Array}
    return arrow_udf(cut, ArrayType(shape))


def _sorted_parts(groups: DataFrame, width: int) -> DataFrame:
    """(k1, k2, most, parts): for the surroundings (anchor, span, around, least, k1, k2, most) of whole anchors,
    the offsets from..to of windows with the same least id.
    """
    id_type = groups.schema["least"].dataType
    part = StructType([StructField("from", IntegerType()), StructField("to", IntegerType()), StructField("least", id_type)])
    schema = StructType([*(StructField(k, LongType()) for k in ("k1", "k2")), StructField("most", id_type), StructField("parts", ArrayType(part))])
    few = (1 << PACKED_BITS) - 1

    def work(rows: pa.Table) -> pa.RecordBatch:
        anchor, span = rows["anchor"].to_numpy(), rows["span"].to_numpy().astype(np.int64)
        group = np.cumsum(np.concatenate([[0], anchor[1:] != anchor[:-1]]))
        left, low, high = span >> 2 * PACKED_BITS, span >> PACKED_BITS & few, span & few
        several = np.bincount(group)[group] > 1
        alone, those = np.flatnonzero(~several), np.flatnonzero(several)
        row = least = start = end = np.zeros(0, np.int64)
        if len(those):
            around = rows["around"].take(pa.array(those)).to_pylist()
            row, found = least_rows(around, group[those], left[those], low[those], high[those], width)
            new = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (found[1:] != found[:-1])]))
            first, end = np.searchsorted(row, row[new]), np.append(new[1:], len(row)) - 1
            row, least = those[row[new]], those[found[new]]
            start, end = new - first + low[row], end - first + low[row]
        row, least = np.concatenate([row, alone]), np.concatenate([least, alone])
        start, end = np.concatenate([start, low[alone]]), np.concatenate([end, high[alone]])
        order = np.argsort(row, kind="stable")
        parts = pa.StructArray.from_arrays(
            [pa.array(start[order], pa.int32()), pa.array(end[order], pa.int32()), rows["least"].combine_chunks().take(pa.array(least[order]))],
            names=[f.name for f in part.fields],
        )
        edges = np.searchsorted(row[order], np.arange(len(rows) + 1))
        lists = pa.ListArray.from_arrays(pa.array(edges, pa.int32()), parts)
        return pa.RecordBatch.from_arrays([*(rows[c].combine_chunks() for c in ("k1", "k2", "most")), lists], names=schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from map(work, whole_groups(batches, "anchor", SORTED_TOGETHER))

    gathered = groups.repartition("anchor").sortWithinPartitions("anchor", "least")
    return gathered.select("anchor", "span", "around", "least", "k1", "k2", "most").mapInArrow(run, schema)


def _grouped_parts(groups: DataFrame, width: int) -> DataFrame:
    """The same by grouping windows on their bytes, for anchors of very many surroundings."""
    few = (1 << PACKED_BITS) - 1
    span = F.col("span")
    low, high = F.shiftright(span, PACKED_BITS).bitwiseAND(F.lit(few)), span.bitwiseAND(F.lit(few))
    windows = groups.select("k1", "k2", "least", "most", "around", "span", F.explode(F.sequence(low, high)).alias("offset"))
    start = F.shiftright("span", 2 * PACKED_BITS) - F.col("offset") + 1
    windows = stored(windows.select("k1", "k2", "least", "most", "offset", F.substring("around", start, F.lit(width)).alias("window")), "windows")
    least = stored(windows.groupBy("offset", "window").agg(F.min("least").alias("of_window")), "least-windows")
    met = windows.join(least, ["offset", "window"])
    part = F.struct(F.col("offset").alias("from"), F.col("offset").alias("to"), F.col("of_window").alias("least"))
    return met.groupBy("k1", "k2", "most").agg(F.collect_list(part).alias("parts"))


def _firsts_and_copies(documents: DataFrame, width: int, doc_id: str, text: str) -> tuple[DataFrame, DataFrame]:
    """(doc_id, version, text) of the first documents of each text that has a window, and (doc_id, version, spans)
    of the others, which go as a whole. Texts are equal if 128 bits of xxHash are.

    The others are told by a filter of fixed size first, so only the texts it lets through are shuffled.
    """
    whole = documents.select(F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("version"), F.col(text).alias("text"))
    whole = whole.where(F.col("doc_id").isNotNull() & (F.octet_length("text") >= width)).withColumn("other", F.xxhash64(F.lit(2), "text"))
    keys = ["version", "other"]
    keyed = stored(whole.select("doc_id", *keys, F.octet_length("text").cast("long").alias("n")), "text-keys")
    least = stored(keyed.groupBy(*keys).agg(F.min("doc_id").alias("least"), F.count("*").alias("rows")).where("rows > 1").drop("rows"), "repeated-texts")
    copies = stored(keyed.join(least, keys).where("doc_id > least").select("doc_id", *keys, "n").distinct(), "copies")
    discard(keyed, least)
    key = F.xxhash64("doc_id", "version")
    maybe = passes(bit_filter(copies, key, COPY_WORDS), key, COPY_WORDS)
    doubtful = stored(whole.where(maybe).join(copies.drop("n"), ["doc_id", *keys], "left_anti"), "doubtful-texts")
    firsts = whole.where(~maybe).unionByName(doubtful).drop("other")
    return firsts, copies.select("doc_id", "version", F.array(F.struct(F.lit(0).cast("long").alias("begin"), F.col("n").alias("end"))).alias("spans"))


def repeated_spans(
    documents: DataFrame, width: int = 50, doc_id: str = "doc_id", text: str = "text", sorted_at_most: int = SORTED_AT_MOST
) -> DataFrame:
    """(doc_id, version, spans) of documents with passages to remove: begin and end, in bytes, of spans,
    which may overlap. version is the 64-bit xxHash of the text, which tells rows of one id apart.
    """
    if not 8 <= width < 1 << PACKED_BITS:
        raise ValueError(f"width must be 8 to {(1 << PACKED_BITS) - 1}")
    gram = 14 * width // 25
    bodies, copies = _firsts_and_copies(documents, width, doc_id, text)
    buckets = max(LEAST_BUCKETS, BUCKETS_EACH * int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    packed = _packed_anchors(bodies, width, gram, (buckets - 1).bit_length())
    # Equal rows are one document: once is enough, and which does not matter. A long text's slices meet here.
    listed = _document_anchors(_shared_anchors(packed)).groupBy("doc_id", "version").agg(F.min("row").alias("row"), F.collect_list("ats").alias("all"))
    ats = F.when(F.size("all") > 1, F.array_distinct(F.flatten("all"))).otherwise(F.get("all", F.lit(0)))
    wanted = stored(listed.select("row", "doc_id", "version", ats.alias("ats")), "document-anchors")
    met = bodies.join(wanted, ["doc_id", "version"]).select("row", "doc_id", _surroundings(width, gram)("text", "ats").alias("s"))
    around = stored(met.select("row", "doc_id", F.inline("s")), "surroundings")
    keys = [F.xxhash64(F.lit(1), "span", "around").alias("k1"), F.xxhash64(F.lit(2), "around", "span").alias("k2")]

    distinct = around.groupBy("span", "around").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"))
    size = F.shiftright("span", 2 * PACKED_BITS)
    anchor = F.xxhash64(F.substring("around", size + 1, F.lit(gram))).alias("anchor")
    distinct = stored(distinct.select("span", "around", "least", "most", *keys, anchor), "distinct-surroundings")
    if distinct.groupBy("k1", "k2").agg(F.count("*").alias("n")).where("n > 1").limit(1).count():
        raise ValueError("two surroundings have the same 128-bit key")
    many = stored(distinct.groupBy("anchor").agg(F.count("*").alias("n")).where(F.col("n") > sorted_at_most).select("anchor"), "frequent-anchors")
    if many.limit(1).count():
        parts = _sorted_parts(distinct.join(many, "anchor", "left_anti"), width).unionByName(_grouped_parts(distinct.join(many, "anchor"), width))
    else:
        parts = _sorted_parts(distinct, width)
    # Surroundings that no document loses a window for go: most that met in an anchor only.
    parts = parts.withColumn("parts", F.filter("parts", lambda p: p["least"] < F.col("most"))).where(F.size("parts") > 0)
    parts = stored(parts.drop("most"), "window-parts")
    discard(distinct, many)

    members = around.select("row", "doc_id", "place", *keys).join(parts, ["k1", "k2"])
    spans = members.select("row", "doc_id", "place", F.inline("parts")).where(F.col("least") < F.col("doc_id"))
    begin, end = F.col("place") - F.col("to"), F.col("place") - F.col("from") + width
    spans = stored(spans.select("row", F.struct(begin.alias("begin"), end.alias("end")).alias("span")), "spans")
    discard(around, parts)
    of_row = spans.groupBy("row").agg(F.collect_list("span").alias("spans"))
    found = stored(wanted.select("row", "doc_id", "version").join(of_row, "row").drop("row"), "document-spans")
    discard(wanted, spans)
    return found.unionByName(copies)


def _kept():
    """A column function of texts and spans: the merged runs to remove, and the bytes that stay."""
    run = StructType([StructField("begin", LongType()), StructField("end", LongType())])
    shape = StructType([StructField("removed", ArrayType(run)), StructField("kept", BinaryType())])

    def cut(texts: pa.Array, spans: pa.Array) -> pa.Array:
        removed, kept = [], []
        for body, found in zip(utf8(texts), spans, strict=True):
            runs: list[list[int]] = []
            values = found.values
            if values is not None and len(values):
                begin, end = (values.field(k).to_numpy() for k in (0, 1))
                order = np.argsort(begin, kind="stable")
                begin, reach = begin[order], np.maximum.accumulate(end[order])
                first = np.flatnonzero(np.concatenate([[True], begin[1:] > reach[:-1]]))
                runs = np.stack([begin[first], reach[np.append(first[1:], len(begin)) - 1]], 1).tolist()
            edges = [0, *(x for r in runs for x in r), len(body)]
            removed.append([{"begin": a, "end": b} for a, b in runs])
            kept.append(b"".join(body[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
        arrow = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
        return pa.StructArray.from_arrays([pa.array(removed, arrow), pa.array(kept, pa.binary())], names=["removed", "kept"])

    cut.__annotations__ = {"texts": pa.Array, "spans": pa.Array, "return": pa.Array}
    return arrow_udf(cut, shape)


def remove_passages(
    documents: DataFrame, width: int = 50, doc_id: str = "doc_id", text: str = "text", name: str = "passages", sorted_at_most: int = SORTED_AT_MOST
) -> DataFrame:
    """Documents with a struct: removed (begin, end in bytes of the maximal runs) and kept (the other bytes).

    A byte goes if a string of `width` bytes over it also starts in a document with a smaller doc_id, on
    the texts as they came. A null text is empty. A row with a null id loses nothing, and nothing goes
    for its sake, since no id is smaller or larger; rows with equal ids do not look at each other. The
    kept bytes may break a character. A column of the struct's name is replaced. An empty table gives an
    empty table.
    """
    found = repeated_spans(documents, width, doc_id, text, sorted_at_most)
    version, of_id, of_version, spans = (free_name(documents, n) for n in ("version", "span_id", "span_version", "spans"))
    found = found.select(F.col("doc_id").alias(of_id), F.col("version").alias(of_version), F.col("spans").alias(spans))
    met = documents.withColumn(version, F.xxhash64(text)).join(
        found, (F.col(doc_id) == F.col(of_id)) & (F.col(version) == F.col(of_version)), "left"
    )
    return met.withColumn(name, _kept()(F.col(text), F.col(spans))).drop(version, of_id, of_version, spans)
