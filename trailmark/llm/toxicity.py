"""Toxic spans and document scores by a linear-chain conditional random field.

Each word is outside (0) or toxic (1). A word's features are its lower-case form, its beginnings of
three to seven letters and its last three letters, hashed. Labels of words come from labelled
documents: a word of a toxic document is labelled toxic if one of its forms occurs in a far larger
share of toxic than of other documents. Forward-backward marginals give spans, and their sum,
maximum and rate a document's score by a logistic regression fitted on documents that the field
was not fitted on.

The odds of the two labels pass from word to word by a Moebius map. Maps compose as 2 x 2 matrices,
so all stretches of SEGMENT words in a batch are reduced side by side, then chained for each
document, then unrolled side by side: exact for texts of any length.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StructField, StructType

from trailmark.llm.common import bounded_sample, free_name, held_out, shared, text_function

#: Bounds of what is learned from: rows of each label, characters of a row.
ROWS_PER_LABEL, LONGEST = 1200, 20_000
BUCKETS = 1 << 18
SEGMENT = 64
#: A form marks toxic words if it occurs in so many toxic documents, so many times their due share.
LEAST_DOCUMENTS, LEAST_RATIO = 5, 6.0
STEPS, RATE, DECAY = 40, 0.3, 1e-5
REMEMBERED = 500_000
#: Characters of texts scored together.
BATCH = 1 << 21
#: A word whose marginal is at least this is in a span.
IN_SPAN = 0.5
WORD = re.compile(r"[^\W\d_]+")


def forms(word: str) -> list[str]:
    """A lower-case word's features, the word itself first."""
    return [word, *(f"{word[:k]}+" for k in range(3, 8) if len(word) > k), *([f"+{word[-3:]}"] if len(word) > 3 else [])]


def buckets(word: str) -> list[int]:
    return [zlib.crc32(f.encode("utf-8", "surrogatepass")) % BUCKETS for f in forms(word)]


def marginals(odds: np.ndarray, lengths: np.ndarray, transition: np.ndarray) -> np.ndarray:
    """P(toxic) of each word of consecutive texts. odds: of the words alone; transition: weights
    [from][to]. A text starts as if after an outside word.
    """
    return forward_backward(odds, lengths, transition)[0]


def forward_backward(
    odds: np.ndarray, lengths: np.ndarray, transition: np.ndarray, pairs: bool = False
) -> tuple[np.ndarray, np.ndarray]:
    """The marginals, and if asked for the expected number of each pair of labels [from][to], that of a
    text's start and first word included.
    """
    expected = np.zeros((2, 2))
    (t00, t01), (t10, t11) = transition
    lengths = lengths[lengths > 0]
    if not len(lengths):
        return np.zeros(0), expected
    per = -(-lengths // SEGMENT)
    rows = int(per.sum())
    first = np.cumsum(per) - per  # a text's first segment
    starts = np.cumsum(lengths) - lengths
    place = np.repeat(first * SEGMENT - starts, lengths) + np.arange(lengths.sum())
    e = np.ones(rows * SEGMENT)
    real = np.zeros(rows * SEGMENT, bool)
    e[place], real[place] = odds, True
    e, real = e.reshape(rows, SEGMENT).T.copy(), real.reshape(rows, SEGMENT).T.copy()

    def compose(forward: bool) -> np.ndarray:
        """Each segment's map as (a, b, c, d): x -> (a x + b) / (c x + d)."""
        a, b, c, d = np.ones(rows), np.zeros(rows), np.zeros(rows), np.ones(rows)
        for t in range(SEGMENT) if forward else range(SEGMENT - 1, -1, -1):
            m, x = real[t], e[t]
            p, q, r, s = (x * t11, x * t01, t10, t00) if forward else (x * t11, t10, x * t01, t00)
            na, nb, nc, nd = p * a + q * c, p * b + q * d, r * a + s * c, r * b + s * d
            scale = 1 / (na + nb + nc + nd)
            a, b = np.where(m, na * scale, a), np.where(m, nb * scale, b)
            c, d = np.where(m, nc * scale, c), np.where(m, nd * scale, d)
        return np.stack([a, b, c, d])

    ahead, back = compose(True), compose(False)
    enter, leave = np.zeros(rows), np.ones(rows)  # odds before a segment's first word, after its last
    order = np.argsort(-per, kind="stable")
    for k in range(1, int(per.max())):
        some = order[: np.searchsorted(-per[order], -k)]
        i = first[some] + k
        a, b, c, d = ahead[:, i - 1]
        enter[i] = (a * enter[i - 1] + b) / (c * enter[i - 1] + d)
        j = first[some] + per[some] - 1 - k
        a, b, c, d = back[:, j + 1]
        leave[j] = (a * leave[j + 1] + b) / (c * leave[j + 1] + d)
    x, before = enter, np.empty_like(e)
    prior = np.empty_like(e) if pairs else None
    for t in range(SEGMENT):
        if pairs:
            prior[t] = x
        x = np.where(real[t], e[t] * (t01 + t11 * x) / (t00 + t10 * x), x)
        before[t] = x
    y, out = leave, np.empty_like(e)
    for t in range(SEGMENT - 1, -1, -1):
        out[t] = before[t] * y / (1 + before[t] * y)
        if pairs:
            toxic = e[t] * y
            joint = np.stack([np.full(rows, t00), t01 * toxic, t10 * prior[t], t11 * prior[t] * toxic])
            expected += (joint / joint.sum(0))[:, real[t]].sum(1).reshape(2, 2)
        y = np.where(real[t], (t10 + t11 * e[t] * y) / (t00 + t01 * e[t] * y), y)
    return out.T.reshape(-1)[place], expected


def summary(p: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """What a document's score is made of: constant, log-odds of the largest marginal, logarithm of
    their sum, their rate, and logarithm of the number of words.
    """
    n = len(lengths)
    of = np.repeat(np.arange(n), lengths)
    largest = np.zeros(n)
    np.maximum.at(largest, of, p)
    total = np.bincount(of, p, n)
    largest = np.clip(largest, 1e-4, 1 - 1e-4)
    rate = total / np.maximum(lengths, 1)
    return np.stack([np.ones(n), np.log(largest / (1 - largest)), np.log1p(total), np.minimum(50 * rate, 5), 0.2 * np.log1p(lengths)], 1)


class ToxicityModel:
    def __init__(self, weights: np.ndarray, transition: np.ndarray, score: np.ndarray):
        self.weights, self.transition, self.score = weights, transition, score
        self.known: dict[str, float] = {}

    def __getstate__(self):
        return self.__dict__ | {"known": {}}

    def word_odds(self, words: list[str]) -> list[float]:
        found = list(map(self.known.get, words))
        if None in found:
            if len(self.known) > REMEMBERED:
                self.known.clear()
            new = {w for w, o in zip(words, found, strict=True) if o is None}
            fresh = {w: float(np.exp(np.clip(self.weights[buckets(w)].sum(), -20, 20))) for w in new}
            self.known.update(fresh)
            found = [fresh[w] if o is None else o for w, o in zip(words, found, strict=True)]
        return found

    def rate(self, texts: list[str]) -> tuple[np.ndarray, list[list[dict]]]:
        """Scores, and the toxic spans' places in code points."""
        odds, lengths = [], []
        for text in texts:
            # Lower-casing may change a text's length, so words are found in the original.
            of = self.word_odds([w.lower() for w in WORD.findall(text)])
            odds += of
            lengths.append(len(of))
        lengths = np.array(lengths, np.int64)
        p = marginals(np.array(odds, float), lengths, self.transition)
        score = 1 / (1 + np.exp(-np.clip(summary(p, lengths) @ self.score, -40, 40)))
        spans: list[list[dict]] = [[] for _ in texts]
        ends = np.cumsum(lengths)
        high = np.flatnonzero(p >= IN_SPAN)
        of = np.searchsorted(ends, high, side="right")
        for k in np.unique(of):
            wanted = set((high[of == k] - (ends[k] - lengths[k])).tolist())
            for i, m in enumerate(WORD.finditer(texts[k])):
                if i not in wanted:
                    continue
                if i - 1 in wanted:
                    spans[k][-1]["end"] = m.end()
                else:
                    spans[k].append({"start": m.start(), "end": m.end()})
        return score, spans


def label_words(texts: list[list[str]], toxic: np.ndarray) -> set[str]:
    """The forms that mark toxic words, from labelled documents' words."""
    with_form = {True: Counter(), False: Counter()}
    for words, label in zip(texts, toxic, strict=True):
        with_form[bool(label)].update({f for w in set(words) for f in forms(w) if not f.startswith("+")})
    n, m = max(1, int(toxic.sum())), max(1, int((~toxic).sum()))
    return {
        f for f, k in with_form[True].items()
        if k >= LEAST_DOCUMENTS and k / n >= LEAST_RATIO * (with_form[False][f] + 1) / m
    }


def fit(texts: list[str], toxic: np.ndarray, shares: dict[int, float]) -> ToxicityModel:
    """The field from the first of every two documents of a label, the score from the second. shares:
    of the labels among all labelled documents.
    """
    words = [[w.lower() for w in WORD.findall(t)] for t in texts]
    rank = np.where(toxic, np.cumsum(toxic), np.cumsum(~toxic))
    field = rank % 2 == 1
    marks = label_words([w for w, f in zip(words, field, strict=True) if f], toxic[field])

    vocabulary = sorted({w for ws in words for w in ws})
    number = {w: i for i, w in enumerate(vocabulary)}
    marked = np.array([any(f in marks for f in forms(w)) for w in vocabulary], bool)
    per_word = [buckets(w) for w in vocabulary]
    flat, owner = np.array([b for bs in per_word for b in bs], np.int64), np.repeat(np.arange(len(vocabulary)), [len(b) for b in per_word])
    at = np.array([number[w] for ws, f in zip(words, field, strict=True) if f for w in ws], np.int64)
    lengths = np.array([len(ws) for ws, f in zip(words, field, strict=True) if f], np.int64)
    y = marked[at] & np.repeat(toxic[field], lengths) if len(at) else np.zeros(0, bool)

    # Transitions start at their smoothed shares; words and transitions follow the field's gradient.
    starts = np.cumsum(lengths[lengths > 0]) - lengths[lengths > 0]
    previous = np.concatenate([[False], y[:-1]]) if len(y) else y
    previous[starts] = False
    observed = np.bincount(2 * previous + y, minlength=4).reshape(2, 2)
    steps = np.log((observed + 1) / (observed + 1).sum(1, keepdims=True))
    weights, velocity = np.zeros(BUCKETS), np.full(BUCKETS, 1e-8)
    steps_velocity = np.full((2, 2), 1e-8)
    for _ in range(STEPS if y.any() else 0):
        odds = np.exp(np.clip(np.bincount(owner, weights[flat], len(vocabulary)), -20, 20))
        p, expected = forward_backward(odds[at], lengths, np.exp(steps), pairs=True)
        by_word = np.bincount(at, p - y, len(vocabulary))
        gradient = np.bincount(flat, by_word[owner], BUCKETS) / len(lengths) + DECAY * weights
        velocity += gradient**2
        weights -= RATE * gradient / np.sqrt(velocity)
        gradient = (expected - observed) / len(lengths) + DECAY * steps
        steps_velocity += gradient**2
        steps = np.clip(steps - RATE * gradient / np.sqrt(steps_velocity), -20, 20)
    transition = np.exp(steps)
    model = ToxicityModel(weights.astype(np.float32), transition, np.zeros(5))

    rest = np.flatnonzero(~field) if (~field).any() else np.arange(len(texts))
    sizes = np.array([len(words[i]) for i in rest], np.int64)
    p = marginals(np.array([o for i in rest for o in model.word_odds(words[i])], float), sizes, transition)
    x, label = summary(p, sizes), toxic[rest].astype(float)
    # Weights bring the labels back to their shares among all.
    balance = np.where(label == 1, shares[1] / max(label.mean(), 1e-9), shares[0] / max(1 - label.mean(), 1e-9))
    score = np.zeros(x.shape[1])
    for _ in range(30):  # Newton's method
        q = 1 / (1 + np.exp(-np.clip(x @ score, -40, 40)))
        curve = balance * q * (1 - q)
        ridge = np.diag([1e-6, *[1e-2] * (x.shape[1] - 1)]) * len(x)
        score = score + np.linalg.solve((x.T * curve) @ x + ridge, x.T @ (balance * (label - q)) - ridge @ score)
    model.score = score
    model.known = {}
    return model


def learn_toxicity(
    documents: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", toxic: str = "toxic"
) -> ToxicityModel | None:
    """A model from at most ROWS_PER_LABEL labelled documents of each label (1, or 0), of at most LONGEST
    characters, that are not held out; the first by a hash of their id, one of equal texts. None
    if a label has no document.
    """
    known = labels.select(F.col(doc_id).alias("id"), F.col(toxic).cast("int").alias("toxic")).distinct()
    known = known.where(F.col("id").isNotNull() & ~held_out("id") & F.col("toxic").isin(0, 1))
    counts = {r.toxic: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(counts) < 2:
        return None
    chosen = bounded_sample(known, "toxic", "id", ROWS_PER_LABEL).collect()  # two labels, so bounded
    few = documents.sparkSession.createDataFrame(chosen, "id " + known.schema["id"].dataType.simpleString() + ", toxic int")
    bodies = documents.select(F.col(doc_id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    bodies = bodies.where(F.length("text") <= LONGEST).join(F.broadcast(few), "id")
    rows = bodies.groupBy(F.xxhash64("text"), "toxic").agg(F.min("text").alias("text")).orderBy("toxic", "text").collect()
    label = np.array([r.toxic == 1 for r in rows], bool)
    if label.all() or not label.any():
        return None
    everything = sum(counts.values())
    return fit([r.text for r in rows], label, {k: n / everything for k, n in counts.items()})


RETURNS = StructType([
    StructField("score", DoubleType()),
    StructField("spans", ArrayType(StructType([StructField("start", IntegerType()), StructField("end", IntegerType())]))),
])
ARROW = pa.struct([("score", pa.float64()), ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))])


def score_toxicity(documents: DataFrame, model: ToxicityModel | None, text: str = "text") -> DataFrame:
    """Documents with toxicity, a struct of score (0 to 1) and spans (start and end in code points).

    A null or empty text has the score of a text without words and no spans; without a model all score
    0. Rows stay as they are; a column named toxicity is replaced.
    """
    get = shared(documents.sparkSession, model)

    def make():
        known = get()

        def work(texts: pa.Array) -> pa.Array:
            bodies = [t or "" for t in texts.to_pylist()]
            out = []
            if known is None:
                return pa.array([{"score": 0.0, "spans": []}] * len(bodies), ARROW)
            batch, size = [], 0
            for i, body in enumerate(bodies):
                batch.append(body)
                size += len(body)
                if size >= BATCH or i == len(bodies) - 1:
                    scores, spans = known.rate(batch)
                    out += [{"score": s, "spans": x} for s, x in zip(scores.tolist(), spans, strict=True)]
                    batch, size = [], 0
            return pa.array(out, ARROW)

        return work

    held = free_name(documents, "found")
    found = documents.withColumn(held, text_function(RETURNS, make)(F.col(text)))
    return found.withColumn("toxicity", F.col(held)).drop(held)
