"""Ordinal quality: cumulative-link regression on graded ratings of hashed text.

P(grade <= k) = sigmoid(threshold_k - w.x): one weight vector for all grades, and thresholds that
rise. x holds the square roots of the shares of hashed features in a text: its words, their shapes,
their last signs, and whether a word repeats the one before it.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from trailmark.llm.common import bounded_sample, free_name, shared, text_function

#: Bounds of what is learned from: rows of each grade, characters of a row.
ROWS_PER_GRADE, LONGEST = 1500, 20_000
MAX_GRADES = 20
BUCKETS = 1 << 14
#: Words remembered by a worker, and the characters of the longest.
REMEMBERED, LONG_WORD = 250_000, 64
STEPS, RATE, DECAY = 300, 0.1, 1e-4
#: Selected if the probability of a good grade is at least this.
SELECT = 0.5
RUNS = re.compile(r"(.)\1+")
#: A text is read in stretches of so many characters, cut at white space.
STRETCH = 1 << 18
RETURNS = StructType([StructField("expected_grade", DoubleType()), StructField("tail_probability", DoubleType())])


def shape(word: str) -> str:
    """Letters as A and a, digits as 9, other characters as they are; runs of one are one."""
    kinds = ["A" if c.isupper() else "a" if c.isalpha() else "9" if c.isdigit() else c for c in word]
    return RUNS.sub(r"\1", "".join(kinds))


def bucket(kind: str, value: str) -> int:
    return zlib.crc32(f"{kind}:{value}".encode("utf-8", "surrogatepass")) % (BUCKETS - 1) + 1


class Features:
    """The features of texts; remembers words. Bucket 0 counts words that repeat the one before."""

    PER_WORD = 3

    def __init__(self):
        self.forget()

    def __getstate__(self):
        return {}

    def __setstate__(self, state):
        self.forget()

    def forget(self) -> None:
        self.place: dict[str, int] = {}
        self.table = np.zeros((1 << 12, self.PER_WORD), np.int32)

    def learn(self, words: set[str]) -> None:
        if len(self.place) > REMEMBERED:
            self.forget()
        for word in words:
            self.add(word)

    def add(self, word: str) -> None:
        n = len(self.place)
        if n == len(self.table):
            self.table = np.resize(self.table, (2 * n, self.PER_WORD))
        bare = word.rstrip(".,!?;:*%$#&|\"')")
        self.table[n] = bucket("word", bare.lower()), bucket("shape", shape(word)), bucket("end", word[len(bare) :])
        self.place[word] = n

    def counts(self, text: str) -> tuple[np.ndarray, int]:
        """Number of each feature, and of words."""
        total, n, start = np.zeros(BUCKETS), 0, 0
        while start < len(text):
            end = min(len(text), start + STRETCH)
            while end < len(text) and not text[end].isspace():
                end += 1
            words = text[start:end].split()
            start = end
            if not words:
                continue
            new = {w for w in words if w not in self.place}
            if new:
                if len(self.place) > REMEMBERED:
                    new = set(words)
                self.learn({w for w in new if len(w) <= LONG_WORD})
                kept = len(self.place)
                for w in new:
                    if len(w) > LONG_WORD:
                        self.add(w)
            at = np.fromiter(map(self.place.__getitem__, words), np.int64, len(words))
            if new:
                while len(self.place) > kept:  # long words are forgotten at once
                    self.place.popitem()
            total += np.bincount(self.table[at].ravel(), minlength=BUCKETS)
            total[0] += int((at[1:] == at[:-1]).sum())
            n += len(words)
        return total, n

    def vector(self, text: str) -> np.ndarray:
        counts, n = self.counts(text)
        return np.sqrt(counts / max(n, 1)).astype(np.float32)


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


class QualityModel:
    """Weights and thresholds, fitted by gradient steps on all rows at once."""

    def __init__(self, texts: list[str], grades: list[float]):
        self.features = Features()
        self.grades = sorted(set(grades))
        y = np.array([self.grades.index(g) for g in grades])
        x = np.empty((len(texts), BUCKETS), np.float32)
        for row, body in zip(x, texts, strict=True):
            row[:] = self.features.vector(body)
        self.features = Features()
        levels = len(self.grades)
        # Thresholds are a first one and the logarithms of the gaps that follow.
        below = np.array([(y <= k).mean() for k in range(levels - 1)])
        theta = np.log(np.clip(below, 1e-3, 1 - 1e-3) / (1 - np.clip(below, 1e-3, 1 - 1e-3)))
        params = np.concatenate([np.zeros(x.shape[1]), theta[:1], np.log(np.maximum(np.diff(theta), 1e-2))])
        first, second = np.zeros_like(params), np.zeros_like(params)
        for step in range(1, STEPS + 1 if levels > 1 else 1):
            gradient = self.gradient(params, x, y, levels)
            first = 0.9 * first + 0.1 * gradient
            second = 0.99 * second + 0.01 * gradient**2
            params = params - RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
        self.weights = params[: x.shape[1]].astype(np.float32)
        self.thresholds = self.rising(params[x.shape[1] :])

    @staticmethod
    def rising(t: np.ndarray) -> np.ndarray:
        return np.cumsum(np.concatenate([t[:1], np.exp(t[1:])]))

    def gradient(self, params, x, y, levels):
        width = x.shape[1]
        w, t = params[:width], params[width:]
        edges = np.concatenate([[-np.inf], self.rising(t), [np.inf]])
        eta = x @ w.astype(np.float32)
        upper, lower = sigmoid(edges[y + 1] - eta), sigmoid(edges[y] - eta)
        chance = np.maximum(upper - lower, 1e-9)
        up, low = upper * (1 - upper) / chance, lower * (1 - lower) / chance
        by_eta = (up - low) / len(y)
        by_edge = np.bincount(y, -up, levels + 1)[: levels - 1] + np.bincount(y - 1 + (y == 0), np.where(y == 0, 0, low), levels + 1)[: levels - 1]
        by_edge = by_edge / len(y)
        reach = np.cumsum(by_edge[::-1])[::-1]  # a gap moves all thresholds after it
        by_t = np.concatenate([reach[:1], reach[1:] * np.exp(t[1:])])
        return np.concatenate([x.T @ by_eta.astype(np.float32) + DECAY * w, by_t])

    def tails(self, text: str) -> np.ndarray:
        """P(grade >= k) for each grade but the lowest."""
        return sigmoid(float(self.features.vector(text) @ self.weights) - self.thresholds)


def learn_quality(
    documents: DataFrame, ratings: DataFrame, doc_id: str = "doc_id", text: str = "text", grade: str = "quality"
) -> QualityModel | None:
    """A model from at most ROWS_PER_GRADE rated rows of each grade, of at most LONGEST characters; the
    first by a hash of their id. Null grades, ids and empty texts are left out. None without ratings.
    """
    rated = ratings.select(F.col(doc_id).alias("id"), F.col(grade).cast("double").alias("grade")).dropna()
    most = ROWS_PER_GRADE * MAX_GRADES
    chosen = bounded_sample(rated.distinct(), "grade", "id", ROWS_PER_GRADE).limit(most + 1).collect()
    if not chosen:
        return None
    if len(chosen) > most or len({r.grade for r in chosen}) > MAX_GRADES:
        raise ValueError(f"more than {MAX_GRADES} grades")
    # Bounded by the lines above, so the documents are not shuffled for it.
    few = F.broadcast(documents.sparkSession.createDataFrame(chosen, "id " + rated.schema["id"].dataType.simpleString() + ", grade double"))
    bodies = documents.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    bodies = bodies.where(F.length(F.trim("text")).between(1, LONGEST))
    # Of rows that repeat an id, one is taken.
    rows = bodies.join(few, "id").groupBy("id", "grade").agg(F.min("text").alias("text")).orderBy("id", "grade").collect()
    if not rows:
        return None
    return QualityModel([r.text for r in rows], [r.grade for r in rows])


def rate_quality(
    documents: DataFrame, model: QualityModel | None, good: float = 1.0, text: str = "text"
) -> DataFrame:
    """Documents with expected_grade, tail_probability (of a grade of good or more) and selected
    (tail_probability is at least SELECT).

    A null text or one without words has the lowest grade: tail_probability 0, not selected. Without a
    model expected_grade and tail_probability are null and all are selected. Rows stay as they are;
    columns of the three names are replaced.
    """
    get = shared(documents.sparkSession, model)

    def make():
        known = get()

        def rate(body: str | None) -> dict:
            if known is None:
                return {"expected_grade": None, "tail_probability": None}
            grades = known.grades
            if not body or not body.strip():
                return {"expected_grade": grades[0], "tail_probability": 0.0}
            tails = known.tails(body)
            at = sum(g < good for g in grades)
            tail = 1.0 if at == 0 else 0.0 if at == len(grades) else float(tails[at - 1])
            return {"expected_grade": float(grades[0] + np.diff(grades) @ tails), "tail_probability": tail}

        def work(texts: pa.Array) -> pa.Array:
            kind = pa.struct([("expected_grade", pa.float64()), ("tail_probability", pa.float64())])
            return pa.array([rate(t.as_py()) for t in texts], kind)

        return work

    held = free_name(documents, "found")
    found = documents.withColumn(held, text_function(RETURNS, make)(F.col(text)))
    return (
        found.withColumn("expected_grade", F.col(held)["expected_grade"])
        .withColumn("tail_probability", F.col(held)["tail_probability"])
        .withColumn("selected", F.coalesce(F.col(held)["tail_probability"] >= SELECT, F.lit(True)))
        .drop(held)
    )
