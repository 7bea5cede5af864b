"""Language identification by a blended-spectrum string kernel.

Two texts are as alike as the number of runs of one to three letters that occur in both, over the
geometric mean of their own numbers (presence, not counts; of runs that a landmark has). Letters of
all scripts are told apart. The kernel's values against a few landmark texts are mapped by the
Nystroem method, and a kernel ridge regression for each language against the rest scores them.
Scoring a text counts the landmarks of its runs, and a batch's counts are multiplied by the weights.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from trailmark.llm.common import bounded_sample, free_name, held_out, shared, text_function

#: Bounds of what is learned from: rows of each language, characters of a row.
ROWS_PER_LANGUAGE, LONGEST = 300, 20_000
LANDMARKS_PER_LANGUAGE = 32
MAX_LANGUAGES = 200
RIDGE = 1e-3
#: Texts scored by one product, and code points looked at at once.
BATCH, RUN = 128, 1 << 20
#: Runs whose landmarks are looked up at once.
PLACES = 1 << 10
UNKNOWN = "und"
LETTER = regex.compile(r"\p{L}")
#: The symbol of all code points that are no letter; letters and marks are their own.
NO_LETTER = 1
RETURNS = StructType([StructField("lang_pred", StringType()), StructField("score", DoubleType())])


@cache
def kept_codes() -> np.ndarray:
    """For each code point whether it keeps its identity: letters and the marks of letters."""
    kept = np.zeros(0x110000, bool)
    kept[[ord(c) for c in regex.findall(r"[\p{L}\p{M}]", "".join(map(chr, range(0x110000))))]] = True
    return kept


class Spectrum:
    """The landmarks' runs of one to three symbols, and which landmarks have each."""

    def __init__(self, texts: list[str]):
        self.codes = np.zeros(0, np.int64)
        for at in range(0, len(texts), BATCH):
            some = [g for t in texts[at : at + BATCH] for g in self.grams(t)]
            self.codes = np.unique(np.concatenate([self.codes, *some]))
        self.width = len(self.codes)
        runs = [self.places(t).astype(np.int32) for t in texts]
        self.size = np.array([len(r) for r in runs])
        order = np.argsort(np.concatenate(runs), kind="stable")
        # The landmarks of a run are owners from its start to the next run's.
        self.owners = np.repeat(np.arange(len(texts), dtype=np.int32), self.size)[order]
        self.starts = np.cumsum([0, *np.bincount(np.concatenate(runs), minlength=self.width)])

    def symbols(self, text: str) -> np.ndarray:
        codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        return np.where(kept_codes()[codes], codes, NO_LETTER).astype(np.int64)

    def grams(self, text: str):
        """The text's runs, a stretch of the text at a time: each is the code points of its symbols, 21
        bits each. No symbol is 0, so runs of different lengths differ.
        """
        for at in range(0, max(1, len(text)), RUN):
            a = self.symbols(text[at : at + RUN + 2])  # runs go over the edge
            pairs = a[:-1] << 21 | a[1:]
            yield np.unique(np.concatenate([a, pairs, pairs[:-1] << 21 | a[2:]]))

    def places(self, text: str) -> np.ndarray:
        """Which of the landmarks' runs the text has, rising."""
        found = []
        for g in self.grams(text):
            at = np.searchsorted(self.codes, g)
            at[at == self.width] = 0
            found.append(at[self.codes[at] == g] if self.width else at[:0])
        return found[0] if len(found) == 1 else np.unique(np.concatenate(found))

    def presence(self, texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), self.width), bool)
        for row, text in zip(out, texts, strict=True):
            row[self.places(text)] = True
        return out

    def common(self, places: np.ndarray) -> np.ndarray:
        """For each landmark the number of these runs that it has."""
        out = np.zeros(len(self.size), np.int64)
        for at in range(0, len(places), PLACES):
            start, stop = self.starts[places[at : at + PLACES]], self.starts[places[at : at + PLACES] + 1]
            size = stop - start
            each = np.repeat(stop - np.cumsum(size), size) + np.arange(size.sum())
            out += np.bincount(self.owners[each], minlength=len(out))
        return out


class LanguageModel:
    def __init__(self, texts: list[str], languages: list[str]):
        self.languages = sorted(set(languages))
        of = np.array([self.languages.index(x) for x in languages])
        chosen = np.concatenate([np.flatnonzero(of == k)[:LANDMARKS_PER_LANGUAGE] for k in range(len(self.languages))])
        self.spectrum = Spectrum([texts[i] for i in chosen])
        among = self.kernel([texts[i] for i in chosen]).astype(np.float64)
        values, vectors = np.linalg.eigh(among)
        root = vectors / np.sqrt(np.maximum(values, 1e-6)) @ vectors.T
        mapped = np.concatenate([self.kernel(texts[i : i + BATCH]) for i in range(0, len(texts), BATCH)]) @ root
        target = np.eye(len(self.languages))[of]
        left = mapped.T @ mapped + RIDGE * len(texts) * np.eye(len(root))
        self.weights = (root @ np.linalg.solve(left, mapped.T @ target)).astype(np.float32)

    def kernel(self, texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), len(self.spectrum.size)), np.float32)
        for row, text in zip(out, texts, strict=True):
            places = self.spectrum.places(text)
            row[:] = self.spectrum.common(places) / np.sqrt(max(1, len(places)) * np.maximum(self.spectrum.size, 1))
        return out

    def scores(self, texts: list[str]) -> np.ndarray:
        return self.kernel(texts) @ self.weights


def learn_languages(
    documents: DataFrame, doc_id: str = "doc_id", text: str = "text", language: str = "lang"
) -> LanguageModel | None:
    """A model from at most ROWS_PER_LANGUAGE rows of each language, of at most LONGEST characters,
    that are not held out; the first by a hash of their id. None if there is no row to learn from.
    """
    usable = documents.select(F.col(doc_id).alias("id"), F.col(language).alias("lang"), F.col(text).alias("text")).where(
        F.col("id").isNotNull()
        & ~held_out("id")
        & F.col("lang").isNotNull()
        & F.col("text").rlike(r"\p{L}")
        & (F.length("text") <= LONGEST)
    )
    # Ids are sampled, and their texts fetched afterwards: a text is told apart by its 64-bit hash.
    ids = usable.select("id", "lang", F.xxhash64("text").alias("version")).distinct()
    most = ROWS_PER_LANGUAGE * MAX_LANGUAGES
    chosen = bounded_sample(ids, "lang", "id", ROWS_PER_LANGUAGE).limit(most + 1).collect()
    if not chosen:
        return None
    if len({r.lang for r in chosen}) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages to learn")
    # Bounded by the lines above, so the documents are not shuffled for it.
    few = F.broadcast(documents.sparkSession.createDataFrame(chosen, ids.schema))
    met = usable.withColumn("version", F.xxhash64("text")).join(few, ["id", "lang", "version"])
    rows = {(r.lang, r.id, r.text) for r in met.select("lang", "id", "text").collect()}
    return LanguageModel([r[2] for r in sorted(rows)], [r[0] for r in sorted(rows)])


def identify_language(documents: DataFrame, model: LanguageModel | None, text: str = "text") -> DataFrame:
    """Documents with lang_pred, a learned language, and score, from 0 to 1.

    A null text or one without letters is "und" with score 0, as is every text without a model. Equal
    scores go to the first language by name. Rows stay as they are; columns of the two names are
    replaced.
    """
    get = shared(documents.sparkSession, model)

    def make():
        known = get()

        def work(texts: pa.Array) -> pa.Array:
            bodies = texts.to_pylist()
            names, values = [UNKNOWN] * len(bodies), np.zeros(len(bodies))
            lettered = [i for i, t in enumerate(bodies) if t and LETTER.search(t)] if known else []
            for at in range(0, len(lettered), BATCH):
                some = lettered[at : at + BATCH]
                scored = known.scores([bodies[i] for i in some])
                best = scored.argmax(1)
                values[some] = np.clip(scored[np.arange(len(some)), best], 0, 1)
                for i, k in zip(some, best, strict=True):
                    names[i] = known.languages[k]
            return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(values)], names=["lang_pred", "score"])

        return work

    held = free_name(documents, "found")
    found = documents.withColumn(held, text_function(RETURNS, make)(F.col(text)))
    return found.withColumn("lang_pred", F.col(held)["lang_pred"]).withColumn("score", F.col(held)["score"]).drop(held)
