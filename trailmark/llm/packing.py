"""Order-preserving packing of documents into sequences of a fixed number of tokens.

A task takes its documents in order as one stream of tokens and chooses window cuts by dynamic
programming. The least cost of cutting the stream at candidate j is

    cost(j) = cut(j) + min over i within one window before j of cost(i) + capacity - (end(j) - end(i))

where cut(j) is 0 at a document's end, SENTENCE at a sentence's end, and INSIDE elsewhere. The
minimum of cost(i) + end(i) over the sliding range comes from a monotone queue, so each candidate
is put in and taken out once. Streams are cut in stretches; what a stretch leaves open goes to the
next, so memory is bounded by a stretch or the longest document. The end of a task's stream is
padded, or cut in powers of two if that costs less.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import deque
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from trailmark.llm.common import shared, utf8
from trailmark.llm.tokens import WordEncoder

#: Costs of a cut, in tokens of padding.
SENTENCE, INSIDE = 4.0, 16.0
#: A candidate inside a sentence each so many tokens, where no other is.
STEP = 32
#: Tokens in a stretch, at least.
STRETCH = 1 << 19


def candidates(ends: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Where a document of size tokens may be cut, its end last, and what each cut costs."""
    cuts = np.unique(np.append(ends[(ends > 0) & (ends < size - 1)], size))
    gaps = np.diff(cuts, prepend=0)
    wide = np.flatnonzero(gaps > STEP)
    more = [np.arange(cuts[i] - gaps[i] + STEP, cuts[i], STEP) for i in wide]
    places = np.concatenate([cuts, *more])
    costs = np.concatenate([np.full(len(cuts), SENTENCE), np.full(len(places) - len(cuts), INSIDE)])
    costs[len(cuts) - 1] = 0.0
    order = np.argsort(places, kind="stable")
    return places[order], costs[order]


def best_cuts(
    places: np.ndarray, costs: np.ndarray, capacity: int, closing: Callable[[int], float]
) -> list[int]:
    """The window ends (indexes into places) of the cheapest way to cut a stream that starts at 0
    and may be cut at places. Neighbouring places lie at most capacity apart. The last cut leaves at
    most capacity tokens, at the cost that closing gives.
    """
    ends, price = [0, *places.tolist()], [0.0, *costs.tolist()]
    total, came = [0.0] * len(ends), [0] * len(ends)
    queue: deque[tuple[float, int]] = deque([(0.0, 0)])  # cost + end and index, both rising
    for j in range(1, len(ends)):
        end = ends[j]
        while ends[queue[0][1]] < end - capacity:
            queue.popleft()
        least, i = queue[0]
        total[j] = least + capacity - end + price[j]
        came[j] = i
        key = total[j] + end
        while queue and queue[-1][0] >= key:
            queue.pop()
        queue.append((key, j))
    size = ends[-1]
    open_ends = range(bisect_left(ends, size - capacity), len(ends))
    j = min(open_ends, key=lambda i: total[i] + closing(size - ends[i]))
    cuts = []
    while j:
        cuts.append(j - 1)
        j = came[j]
    return cuts[::-1]


def powers(size: int) -> list[int]:
    """The powers of two that add up to size, falling."""
    return [1 << k for k in range(size.bit_length() - 1, -1, -1) if size >> k & 1]


def tail_cost(size: int, capacity: int) -> float:
    """Of the end of a stream: padded, or cut in powers of two, which need no padding."""
    return min(capacity - size, (size.bit_count() - 1) * INSIDE) if size else 0.0


def by_bytes(batch: pa.RecordBatch, limit: int = 1 << 18) -> Iterator[pa.RecordBatch]:
    """Slices of the batch with at most about limit bytes of texts (column 1), or one row."""
    sizes = np.array(pc.fill_null(pc.binary_length(batch.column(1)), 0), np.int64)
    block = (np.cumsum(sizes) - sizes) // limit
    starts = np.flatnonzero(np.diff(block, prepend=-1))
    for a, b in zip(starts, [*starts[1:], len(block)], strict=True):
        yield batch.slice(a, b - a)


class Stream:
    """Packs the documents it is given, in order. Yields (row, start, ids, document's tokens, sequence, offset)."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.sequence = 0
        self.open: list[list] = []  # row, ids, place of the first in its document, document's tokens, cuts, costs
        self.tokens = 0

    def add(self, row, ids: np.ndarray, ends: np.ndarray) -> Iterator[tuple]:
        self.open.append([row, ids, 0, len(ids), *candidates(ends, len(ids))])
        self.tokens += len(ids)
        if self.tokens >= STRETCH:
            yield from self.cut(last=False)

    def cut(self, last: bool) -> Iterator[tuple]:
        if not self.open:
            return
        starts = np.cumsum([0, *(len(x[1]) for x in self.open)])
        places = np.concatenate([x[4] + s for x, s in zip(self.open, starts, strict=False)])
        costs = np.concatenate([x[5] for x in self.open])
        if last:
            cuts = best_cuts(places, costs, self.capacity, lambda n: tail_cost(n, self.capacity))
        else:  # what is left goes to the next stretch and costs nothing yet
            cuts = best_cuts(places, costs, self.capacity, lambda n: 0.0)
        windows = places[cuts].tolist()
        begin = windows[-1] if windows else 0
        if last and (left := int(starts[-1]) - begin):
            whole = self.capacity - left <= tail_cost(left, self.capacity)
            windows += [begin + left] if whole else (begin + np.cumsum(powers(left))).tolist()
        at, which = 0, 0
        for end in windows:
            offset = 0
            while at < end:
                while starts[which + 1] <= at:
                    which += 1
                row, ids, first, whole = self.open[which][:4]
                a, b = at - starts[which], min(end, starts[which + 1]) - starts[which]
                yield row, first + int(a), ids[a:b], whole, self.sequence, offset
                offset += int(b - a)
                at += int(b - a)
            self.sequence += 1
        rest = []
        for x, start in zip(self.open, starts, strict=False):
            done = max(0, at - int(start))
            if done < len(x[1]):
                keep = x[4] > done
                rest.append([x[0], x[1][done:], x[2] + done, x[3], x[4][keep] - done, x[5][keep]])
        self.open = rest
        self.tokens = sum(len(x[1]) for x in rest)


def pack(
    documents: DataFrame,
    tokenizer_path: str,
    end_id: int = 2,
    capacity: int = 4096,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """A row for each piece of a document in a sequence.

    Columns: doc_id, start (its document's tokens before it), length, ids (little-endian unsigned
    32-bit), doc_tokens, sequence_id, offset (place in the sequence). Every document ends with
    end_id, so a null or empty text is one piece of one token; rows with null or repeated ids are
    packed like others; other columns are left out. An empty table gives no pieces. Sequences
    hold documents of one input partition, in its order: read documents from a stored table, so
    that a task that runs again gives the same sequences.
    """
    encoder = shared(documents.sparkSession, WordEncoder(tokenizer_path))
    id_type = documents.schema[doc_id].dataType
    fields = {
        "doc_id": id_type, "start": LongType(), "length": LongType(), "ids": BinaryType(),
        "doc_tokens": LongType(), "sequence_id": LongType(), "offset": LongType(),
    }
    schema = StructType([StructField(n, t) for n, t in fields.items()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder()
        stream = Stream(capacity)
        base = TaskContext.get().partitionId() << 40
        id_arrow = None

        def made(pieces: list[tuple]) -> pa.RecordBatch:
            rows, starts, ids, wholes, sequences, offsets = zip(*pieces, strict=True)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(rows, id_arrow),
                    pa.array(starts, pa.int64()),
                    pa.array([len(x) for x in ids], pa.int64()),
                    pa.array([x.astype("<u4").tobytes() for x in ids], pa.binary()),
                    pa.array(wholes, pa.int64()),
                    pa.array([base + s for s in sequences], pa.int64()),
                    pa.array(offsets, pa.int64()),
                ],
                names=list(fields),
            )

        pieces = []
        for batch in batches:
            id_arrow = batch.column(0).type
            for some in by_bytes(batch):
                encoded = words.batch_ids(utf8(some.column(1)))
                for row, (ids, ends) in zip(some.column(0).to_pylist(), encoded, strict=True):
                    pieces += stream.add(row, np.append(ids, np.int32(end_id)), ends)
                if len(pieces) >= 1000:
                    yield made(pieces)
                    pieces = []
        pieces += stream.cut(last=True)
        if pieces:
            yield made(pieces)

    return documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, schema)
