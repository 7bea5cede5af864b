"""Collocations by top-order marginalisation.

Every word of a piece of text starts one window: itself and the words that follow it in the piece, in
lead columns padded with null. Only whole windows are counted; Spark's ROLLUP over the lead columns
sums them to successively shorter prefixes, and the prefixes of all windows are all phrases. No
phrase of another length is ever made from the text.

A phrase that is frequent enough has only runs of words that are. So ahead of the windows, runs of two
words, then of three, are counted by a 64-bit hash, and the hashes of frequent ones set bits in a
filter of fixed size. A window ends where a run in it is not in the filter: prefixes that go
missing are too rare to be reported, and a filter that lets rare runs pass (hashes that meet, or
more runs than bits) costs time only. All counts that are reported come from the windows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType
from pyspark.sql.window import Window

from trailmark.llm.common import LOWER, shared, step_settings, stored, utf8

#: Bytes that part words, and those that part pieces too.
GAPS, ENDS = b" \t", b".,;:!?\n\x0b\x0c\r"
KINDS = np.zeros(256, np.uint8)
KINDS[list(GAPS)], KINDS[list(ENDS)] = 1, 2
LOWERED = np.frombuffer(LOWER, np.uint8)
GAP = re.compile(b"[" + re.escape(GAPS + ENDS) + b"]")
WORD = re.compile(b"[^" + re.escape(GAPS + ENDS) + b"]+")
#: Bits of a filter, a power of two: 2 MB, whatever the input.
FILTER_BITS = 1 << 24
#: Sizes of the runs that are filtered.
FILTERED = (2, 3)
#: UTF-8 bytes looked at together, about, and hashes counted together.
BLOCK_BYTES, COUNTED = 1 << 20, 1 << 20
FOLD, MIX = 0xFF51AFD7ED558CCD, 0xD6E8FEB86659FD93


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(MIX)
    return x ^ (x >> np.uint64(29))


def blocks(texts: list[bytes], longest: int) -> Iterator[list[tuple[int, bytes, int]]]:
    """The texts (number, bytes, own) in blocks. Long ones are cut between words; a cut part is followed
    by the words that windows from its own bytes may need.
    """
    block, size = [], 0
    for i, text in enumerate(texts):
        at = 0
        while at < len(text):
            cut = end = len(text)
            if end - at > BLOCK_BYTES:
                gap = GAP.search(text, at + BLOCK_BYTES)
                cut = gap.start() if gap else end
                after = cut
                for _ in range(longest - 1):
                    word = WORD.search(text, after)
                    after = word.end() if word else end
                end = after
            block.append((i, text[at:end], cut - at))
            size += end - at
            at = cut
            if size >= BLOCK_BYTES:
                yield block
                block, size = [], 0
    if block:
        yield block


class Words:
    """The words of a block of texts, in order: codes into a dictionary of distinct words, the text of
    each, whether it goes on in the piece of the word before, and whether it is the block's own.
    """

    def __init__(self, block: list[tuple[int, bytes, int]]):
        data = LOWERED[np.frombuffer(b"".join(b for _, b, _ in block), np.uint8)]
        sizes = np.array([len(b) for _, b, _ in block])
        edges = np.cumsum(sizes) - sizes
        kinds = KINDS[data]
        letter = kinds == 0
        first, last = letter.copy(), letter.copy()
        first[1:] &= ~letter[:-1]
        last[:-1] &= ~letter[1:]
        first[edges] = letter[edges]
        last[edges + sizes - 1] = letter[edges + sizes - 1]
        start, stop = np.flatnonzero(first), np.flatnonzero(last) + 1
        offsets = np.concatenate([[0], np.cumsum(stop - start)])
        letters = np.ascontiguousarray(data[letter])
        words = pa.Array.from_buffers(pa.large_string(), len(start), [None, pa.py_buffer(offsets), pa.py_buffer(letters)])
        encoded = words.dictionary_encode()
        self.codes, self.known = encoded.indices.to_numpy(), encoded.dictionary
        part = np.searchsorted(edges, start, side="right") - 1
        self.text = np.array([i for i, _, _ in block])[part]
        self.own = start - edges[part] < np.array([n for _, _, n in block])[part]
        pieces = np.cumsum(kinds == 2)[start]
        self.goes_on = np.zeros(len(start), bool)
        self.goes_on[1:] = (pieces[1:] == pieces[:-1]) & (part[1:] == part[:-1])

    def hashes(self, languages: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each word, and of its language; languages: a hash for each text."""
        each = np.array([xxhash.xxh64_intdigest(w.as_buffer()) for w in self.known.cast(pa.large_binary())], np.uint64)
        return each[self.codes], languages[self.text]


def runs(words: Words, languages: np.ndarray, filters: Sequence[np.ndarray], longest: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """How many words the window from each word has, and for each filtered size the run hashes from each
    word. The window is cut where a run of a size for which there is a filter is not in it.
    """
    word, language = words.hashes(languages)
    n = len(word)
    hashes = []
    for size in FILTERED[: len(filters) + 1]:
        x = language[: max(n - size + 1, 0)]
        for k in range(size):
            x = mixed(x * np.uint64(FOLD) + word[k : k + len(x)])
        hashes.append(x)
    reach = np.ones(n, np.int64)
    for m in range(2, longest + 1):
        if n < m:
            break
        fits = (reach[: n - m + 1] == m - 1) & words.goes_on[m - 1 :]
        for size, bits, x in zip(FILTERED, filters, hashes, strict=False):
            if size <= m:  # the run of the size that ends with the window
                slot = (x[m - size :] & np.uint64(FILTER_BITS - 1)).astype(np.int64)
                fits &= bits[slot >> 3] >> (slot & 7).astype(np.uint8) & 1 == 1
        reach[: n - m + 1] += fits
    return reach, hashes


def _language_hashes(languages: pa.Array) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(x) for x in languages.to_pylist()], np.uint64)


def frequent_runs(texts: DataFrame, filters: list[np.ndarray], least: int) -> np.ndarray:
    """The filter of the next size: bits of the hashes of runs that occur at least so often, at the places
    that the filters of smaller sizes leave.
    """
    size = FILTERED[len(filters)]
    get = shared(texts.sparkSession, filters)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, waiting, held = get(), [], 0

        def counted() -> pa.RecordBatch:
            hashes, counts = np.unique(np.concatenate(waiting), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), pa.array(counts.astype(np.int64))], names=["run", "n"])

        for batch in batches:
            languages = _language_hashes(batch.column(0))
            for block in blocks(utf8(batch.column(1)), size):
                words = Words(block)
                reach, hashes = runs(words, languages, known, size)
                x = hashes[-1]
                found = x[(reach[: len(x)] == size) & words.own[: len(x)]]
                waiting.append(found)
                held += len(found)
                if held >= COUNTED:
                    yield counted()
                    waiting, held = [], 0
        if held:
            yield counted()

    each = texts.mapInArrow(run, "run bigint, n bigint")
    frequent = each.groupBy("run").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    slot = F.col("run").bitwiseAND(F.lit(FILTER_BITS - 1))
    bit = F.expr("shiftleft(1, cast(run & 7 AS int))")
    octets = frequent.groupBy(F.shiftright(slot, 3).cast("int").alias("at")).agg(F.bit_or(bit).cast("int").alias("bits"))
    bits = np.zeros(FILTER_BITS // 8, np.uint8)
    with step_settings(texts.sparkSession):
        found = octets.toArrow()
    bits[found["at"].to_numpy()] = found["bits"].to_numpy()
    return bits


def lead_windows(texts: DataFrame, filters: list[np.ndarray], longest: int) -> DataFrame:
    """(lang, w1 .. w<longest>, n): the windows of all words, equal ones of a block together."""
    get = shared(texts.sparkSession, filters)
    leads = [f"w{k + 1}" for k in range(longest)]
    schema = StructType([StructField("lang", StringType()), *(StructField(w, StringType()) for w in leads), StructField("n", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = get()
        for batch in batches:
            languages = batch.column(0).dictionary_encode()
            hashed = _language_hashes(languages.dictionary)[languages.indices.to_numpy()]
            for block in blocks(utf8(batch.column(1)), longest):
                words = Words(block)
                if not len(words.codes):
                    continue
                reach, _ = runs(words, hashed, known, longest)
                at = np.flatnonzero(words.own)
                table = {"lang": languages.indices.to_numpy()[words.text[at]]}
                for k, name in enumerate(leads):
                    there = np.minimum(at + k, len(words.codes) - 1)
                    table[name] = np.where(reach[at] > k, words.codes[there], -1)
                counted = pa.table(table).group_by(["lang", *leads]).aggregate([([], "count_all")])
                columns = [languages.dictionary.take(counted["lang"].combine_chunks())]
                for name in leads:
                    codes = counted[name].to_numpy()
                    columns.append(words.known.take(pa.array(codes, mask=codes < 0)).cast(pa.string()))
                columns.append(counted["count_all"].combine_chunks())
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return texts.mapInArrow(run, schema)


def phrase_counts(documents: DataFrame, longest: int = 5, least: int = 100, lang: str = "lang", text: str = "text") -> DataFrame:
    """(lang, size, phrase, f): occurrences of every phrase of up to `longest` words that has `least`; with
    size 0 and a null phrase, the words of the language.
    """
    texts = documents.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).alias("text")).where("text <> ''")
    filters: list[np.ndarray] = []
    for size in FILTERED:
        if size <= longest:
            filters.append(frequent_runs(texts, filters, least))
    leads = [f"w{k + 1}" for k in range(longest)]
    windows = lead_windows(texts, filters, longest).groupBy("lang", *leads).agg(F.sum("n").alias("n"))
    windows = stored(windows, "lead-windows")
    rolled = windows.rollup("lang", *leads).agg(F.sum("n").alias("f"), F.grouping_id().alias("left_out"))
    # The columns that a level leaves out are the last ones, each a bit. A padded window stands for itself
    # at its own size only.
    levels = [(F.col("left_out") == (1 << (longest - size)) - 1) & F.col(leads[size - 1]).isNotNull() for size in range(1, longest + 1)]
    size = F.when(F.col("left_out") == (1 << longest) - 1, 0)
    for k, level in enumerate(levels):
        size = size.when(level, k + 1)
    phrase = F.when(size > 0, F.concat_ws(" ", *leads)).alias("phrase")
    return rolled.select("lang", size.alias("size"), phrase, "f").where((F.col("size") == 0) | (F.col("f") >= least))


def exact_score(a: str, n: str, l: str, r: str):
    """floor(1000 a n / (l r)) in whole numbers of 38 digits."""
    return F.expr(f"(cast({a} AS decimal(19,0)) * cast({n} AS decimal(19,0)) * cast(1000 AS decimal(4,0))) div (cast({l} AS decimal(19,0)) * cast({r} AS decimal(19,0)))")


def collocations(
    documents: DataFrame, longest: int = 5, least: int = 100, top: int = 2000, lang: str = "lang", text: str = "text"
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of the best phrases of 2 to `longest` words in each language.

    Texts are lower-cased A-Z, parted at `.,;:!?` and line ends into pieces, and those at spaces and tabs
    into words. a: the phrase's occurrences, at least `least`. Of its cuts in two, l and r are the
    occurrences of the parts, and the score is the least floor(1000 a n / (l r)), with n words in the
    language; of equal cuts the first. A phrase that a longer one holds in all its occurrences is left
    out. A null or empty text has no words; a null language is `und`. Repeated rows count again; other
    columns do not matter. Tables without such phrases, or empty, give an empty table.
    """
    if longest < 2:
        raise ValueError("a phrase has two words at least")
    counts = stored(phrase_counts(documents, longest, least, lang, text), "phrase-counts")
    phrases = counts.where("size > 0").drop("size")
    candidates = counts.where("size > 1").withColumnRenamed("f", "a")
    words = F.split("phrase", " ")
    cuts = candidates.select("lang", "phrase", "a", "size", words.alias("words"), F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cuts = cuts.select(
        "lang", "phrase", "a", "k",
        F.array_join(F.slice("words", 1, F.col("k")), " ").alias("left_part"),
        F.array_join(F.slice("words", F.col("k") + 1, F.col("size")), " ").alias("right_part"),
    )
    for part, f in (("left_part", "l"), ("right_part", "r")):
        cuts = stored(cuts.join(phrases.select("lang", F.col("phrase").alias(part), F.col("f").alias(f)), ["lang", part]), f"cuts-{f}")
    totals = counts.where("size = 0").select("lang", F.col("f").alias("n"))
    # Stored, so that a language of most phrases does not hold up the join.
    scored = stored(cuts.join(totals, "lang").withColumn("score", exact_score("a", "n", "l", "r")), "scored-cuts")
    best = scored.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("best"))
    # If a longer phrase holds all occurrences, so does one that is longer by a word.
    longer = candidates.where("size > 2").select(
        "lang", "a", F.explode(F.array(F.array_join(F.slice(words, 1, F.col("size") - 1), " "), F.array_join(F.slice(words, 2, F.col("size")), " "))).alias("phrase")
    )
    longer = longer.groupBy("lang", "phrase").agg(F.max("a").alias("held"))
    left = best.join(longer, ["lang", "phrase"], "left").where("held IS NULL OR held < a")
    left = left.select("lang", "phrase", "a", "best.l", "best.r", "n", "best.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = left.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
