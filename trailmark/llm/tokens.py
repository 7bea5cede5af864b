"""Token counts and ids by a public tokenizer, whole texts.

For counts, the parts of all texts of an Arrow batch that are not remembered go to the library in
batches balanced by UTF-8 bytes, and lengths only come back.

Texts are cut where no token can span the cut: for the sentence-piece model at single spaces
between other characters (no piece has a space mark after its first character), for the word
model at ASCII white space (its rules drop white space and never look across it). The parts,
mostly words, repeat; each is encoded by the library once for as long as a worker remembers it.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from trailmark.llm.common import LOWER, shared, text_function

#: Parts remembered by a worker; the memory is emptied when it is full.
REMEMBERED = 600_000
#: Longer parts are encoded each time.
LONG_PART = 64
#: UTF-8 bytes, about, that go to the library in one call, and in one slice of a long text.
BATCH_BYTES = 1 << 20
SPACE_MARK = "▁"


def slices(text: str, size: int = BATCH_BYTES // 4) -> Iterator[str]:
    """The text cut at safe single spaces, which are left out, into slices a little over size."""
    start = 0
    while len(text) - start > size:
        at = text.find(" ", start + size)
        while at > 0 and (text[at - 1] == " " or text[at + 1 : at + 2] in ("", " ")):
            at = text.find(" ", at + 1)
        if at < 0:
            break
        yield text[start:at]
        start = at + 1
    yield text[start:]


def parts(text: str) -> list[str]:
    """The text's parts between safe single spaces."""
    found = text.split(" ")
    if "" in found and len(found) > 1:
        found = re.split("(?<=[^ ]) (?=[^ ])", text)
    return found


def by_bytes(texts: list[str], limit: int = BATCH_BYTES) -> Iterator[list[str]]:
    """The texts in batches of at most limit UTF-8 bytes, or of one text."""
    batch, size = [], 0
    for text in texts:
        n = len(text) if text.isascii() else len(text.encode())
        if batch and size + n > limit:
            yield batch
            batch, size = [], 0
        batch.append(text)
        size += n
    if batch:
        yield batch


class PieceCounter:
    """Counts a sentence-piece model's tokens. Sent to executors, it loads the model there."""

    def __init__(self, path: str):
        self.path = path
        self.model = None
        self.known: dict[str, int] = {}

    def __getstate__(self):
        return {"path": self.path, "model": None, "known": {}}

    def encode_lengths(self, texts: list[str]) -> list[int]:
        """The library's token counts, texts of about the same bytes to a call."""
        if self.model is None:
            import sentencepiece

            self.model = sentencepiece.SentencePieceProcessor(model_file=self.path)
        out = []
        for batch in by_bytes(texts):
            out += map(len, self.model.encode(batch, num_threads=1))
        return out

    def part_lengths(self, units: list[list[str]]) -> list[int]:
        """The tokens of each list of parts. What no list's parts are known for goes to the library together."""
        get = self.known.get
        found = [list(map(get, u)) for u in units]
        new = list({x for u, f in zip(units, found, strict=True) if None in f for x, n in zip(u, f, strict=True) if n is None})
        if not new:
            return list(map(sum, found))
        lengths = dict(zip(new, self.encode_lengths(new), strict=True))
        totals = [
            sum(lengths[x] if n is None else n for x, n in zip(u, f, strict=True)) if None in f else sum(f)
            for u, f in zip(units, found, strict=True)
        ]
        if len(self.known) > REMEMBERED:
            self.known.clear()
        self.known.update((x, n) for x, n in lengths.items() if len(x) <= LONG_PART)
        return totals

    def units(self, texts: list[str | None]) -> Iterator[tuple[int, list[str]]]:
        """The number of a text and parts of it, a slice's at a time."""
        for i, text in enumerate(texts):
            if text and SPACE_MARK in text:  # the mark stands for a space: such a text is not cut
                yield i, [text]
            elif text:
                for piece in slices(text):
                    yield i, parts(piece)

    def count(self, text: str | None) -> int:
        return self.counts([text])[0]

    def counts(self, texts: list[str | None]) -> list[int]:
        """The tokens of each text. Slices are looked at together up to a batch's bytes, so memory is bounded
        by a batch, or by a text that cannot be cut.
        """
        totals = [0] * len(texts)
        held: list[tuple[int, list[str]]] = []
        size = 0

        def add() -> None:
            for (i, _), n in zip(held, self.part_lengths([u for _, u in held]), strict=True):
                totals[i] += n

        for i, unit in self.units(texts):
            held.append((i, unit))
            size += sum(map(len, unit)) + len(unit)
            if size >= BATCH_BYTES:
                add()
                held, size = [], 0
        add()
        return totals


def count_tokens(
    documents: DataFrame, model_path: str, text: str = "text", limit: int = 4096
) -> DataFrame:
    """Documents with n_bytes, n_tokens and over_limit (more tokens than limit).

    A null or empty text has no bytes and no tokens. Rows stay as they are, repeated ones and null
    ids included; columns of the three names are replaced. An empty table gives an empty table.
    """
    counter = shared(documents.sparkSession, PieceCounter(model_path))

    def make():
        counts = counter().counts

        def work(texts: pa.Array) -> pa.Array:
            return pa.array(counts(texts.to_pylist()), pa.int64())

        return work

    counted = text_function(LongType(), make)
    whole = F.coalesce(F.col(text), F.lit(""))
    return (
        documents.withColumn("n_bytes", F.octet_length(whole).cast("long"))
        .withColumn("n_tokens", counted(whole))
        .withColumn("over_limit", F.col("n_tokens") > limit)
    )


#: The byte-level alphabet: printable bytes stand for themselves, the others for the code points from 256.
_PRINTABLE = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
_OTHERS = [b for b in range(256) if b not in _PRINTABLE]
BYTE_LETTERS = [chr(b) if b in _PRINTABLE else chr(256 + _OTHERS.index(b)) for b in range(256)]


class WordEncoder:
    """Ids of whole texts by a word model of the tokenizers library, whose rules drop white space."""

    #: After a letter, a run of these at a word's end is a run of its own to the model's rules.
    SIGNS = ".,!?&*%$#"
    #: Below, letters are Latin, composed, and letters in every version of Unicode.
    LATIN = "\u0250"
    #: Words remembered by a worker, and the bytes of the longest: 300 bytes each at most.
    REMEMBERED, LONG_WORD = 500_000, 64
    ENDED = re.compile(rb"[.!?][\"')\]]*$")
    #: Such a run behind a plain letter, which may as well be a word of its own.
    BEHIND = re.compile(rb"(?<=[a-z])([.,!?&*%$#]+)(?=\s|\Z)")

    def __init__(self, path: str):
        self.path = path
        self.model = None

    def __getstate__(self):
        return {"path": self.path, "model": None}

    def load(self) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(self.path)
        self.merge = self.model.model.tokenize
        self.forget()

    def forget(self) -> None:
        self.place: dict[bytes, int] = {}
        self.first = np.zeros(0, np.int64)  # of a word, where its ids start
        self.size = np.zeros(0, np.int32)
        self.ends = np.zeros(0, bool)
        self.ids = np.zeros(1 << 16, np.int32)
        self.used = 0

    def forget_from(self, place: int, used: int) -> None:
        """Forget the words learned last."""
        while len(self.place) > place:
            self.place.popitem()
        self.first, self.size, self.ends = self.first[:place], self.size[:place], self.ends[:place]
        self.used = used
        if len(self.ids) > 1 << 22 and len(self.ids) > 4 * used:
            self.ids = self.ids[: 2 * used + 1].copy()

    def parted(self, text: bytes) -> bytes:
        """The text with fewer different words and the same ids: the model lower-cases, and drops white space.
        Its special strings are matched as they stand, so a text that may hold one is left.
        """
        return text if b"<|" in text else self.BEHIND.sub(rb" \1", text.translate(LOWER))

    def encode(self, text: str) -> list[int]:
        return self.model.encode(text, add_special_tokens=False).ids

    def part_ids(self, part: str) -> list[int]:
        """Ids of a part. Latin letters alone are one run: lower-cased, they go right to the merges."""
        lower = part.lower() if part.isalpha() and max(part) < self.LATIN else ""
        if lower and lower.isalpha() and max(lower) < self.LATIN:
            letters = lower if lower.isascii() else "".join(map(BYTE_LETTERS.__getitem__, lower.encode()))
            return [t.id for t in self.merge(letters)]
        return self.encode(part)

    def learn(self, words: list[bytes]) -> None:
        """Remember words not met before."""
        ids, sizes, ends, tails = [], [], [], {}
        for word in words:
            if word.isalpha():  # plain letters, most words
                found = [t.id for t in self.merge(word.lower().decode())]
                ids += found
                sizes.append(len(found))
                ends.append(False)
                continue
            whole = word.decode()
            body = whole.rstrip(self.SIGNS)
            before = len(ids)
            # A capital may become a letter and a sign, as U+0130 does; then the sign joins the run.
            last = body[-1:].lower()[-1:]
            if body and body != whole and last.isalpha() and last < self.LATIN:
                ids += self.part_ids(body)
                tail = whole[len(body) :]
                if tail not in tails:
                    tails[tail] = self.encode(tail)
                ids += tails[tail]
            else:
                ids += self.part_ids(whole)
            sizes.append(len(ids) - before)
            ends.append(bool(self.ENDED.search(word)))
        self.place.update(zip(words, range(len(self.place), len(self.place) + len(words)), strict=True))
        size = np.array(sizes, np.int32)
        start = self.used + np.cumsum(size, dtype=np.int64) - size
        while self.used + len(ids) > len(self.ids):
            self.ids = np.resize(self.ids, 2 * len(self.ids))
        self.ids[self.used : self.used + len(ids)] = ids
        self.used += len(ids)
        self.first = np.concatenate([self.first, start])
        self.size = np.concatenate([self.size, size])
        self.ends = np.concatenate([self.ends, np.array(ends, bool)])

    def batch_ids(self, texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each text its ids, and the positions in them after which a sentence ends."""
        if self.model is None:
            self.load()
        if len(self.place) > self.REMEMBERED:
            self.forget()
        split = [self.parted(t).split() for t in texts]
        words = list(chain.from_iterable(split))
        at = np.fromiter(map(self.place.get, words, repeat(-1)), np.int64, len(words))
        new = np.flatnonzero(at < 0).tolist()
        remembered = None
        if new:
            distinct = {words[i] for i in new}
            self.learn([w for w in distinct if len(w) <= self.LONG_WORD])
            remembered = len(self.place), self.used
            self.learn([w for w in distinct if len(w) > self.LONG_WORD])
            at[new] = [self.place[words[i]] for i in new]
        size = self.size[at]
        after = np.cumsum(size, dtype=np.int64)
        # Each word's ids lie together: their place moves on by one within a word.
        ids = self.ids[np.repeat(self.first[at] - (after - size), size) + np.arange(int(size.sum()))]
        ends = self.ends[at]
        if remembered:
            self.forget_from(*remembered)
        edges = np.cumsum([0, *map(len, split)])
        before = np.concatenate([[0], after])[edges]
        for k in range(len(split)):
            word, stop = edges[k], edges[k + 1]
            yield ids[before[k] : before[k + 1]], after[word:stop][ends[word:stop]] - before[k]
