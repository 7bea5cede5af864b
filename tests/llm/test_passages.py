import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from trailmark.llm import passages
from trailmark.llm.passages import anchors, blocks, least_rows, remove_passages


def brute(documents, width):
    """documents: [(id, text)]. The removed runs and what is kept, of each."""
    least = {}
    for i, text in documents:
        body = (text or "").encode()
        for p in range(len(body) - width + 1):
            if i is not None:
                w = body[p : p + width]
                least[w] = min(least.get(w, i), i)
    found = []
    for i, text in documents:
        body = (text or "").encode()
        gone = np.zeros(len(body) + 2, bool)
        for p in range(len(body) - width + 1):
            if i is not None and least[body[p : p + width]] < i:
                gone[p + 1 : p + 1 + width] = True
        edges = np.flatnonzero(gone[1:] != gone[:-1]).tolist()
        runs = list(zip(edges[::2], edges[1::2], strict=True))
        found.append((i, runs, bytes(b for b, g in zip(body, gone[1:], strict=False) if not g)))
    return found


def cleaned(frame, **options):
    rows = remove_passages(frame, **options).collect()
    return [(r.doc_id, [tuple(x) for x in r.passages.removed], bytes(r.passages.kept)) for r in rows]


def corpus():
    chance = random.Random(9)
    words = [f"w{i}é" for i in range(40)] + ["the", "of"] * 10

    def prose(n):
        return " ".join(chance.choice(words) for _ in range(n))

    shared = [prose(chance.randrange(8, 40)) for _ in range(6)]
    documents = []
    for i in range(80):
        parts = [prose(chance.randrange(0, 30)) for _ in range(3)]
        if chance.random() < 0.6:
            parts.insert(1, chance.choice(shared))
        text = " ".join(parts)
        if documents and chance.random() < 0.2:
            text = chance.choice(documents)[1]
        if chance.random() < 0.3:
            at = chance.randrange(len(text) + 1)
            text = text[:at] + "x" + text[at:]
        documents.append((i, text))
    return documents


@pytest.mark.parametrize("width, sorted_at_most", [(50, 1 << 14), (50, 2), (20, 1 << 14), (9, 5)])
def test_equals_brute_force(spark, width, sorted_at_most):
    documents = corpus()
    frame = spark.createDataFrame(documents, "doc_id long, text string").repartition(5)
    found = cleaned(frame, width=width, sorted_at_most=sorted_at_most)
    assert sorted(found) == sorted(brute(documents, width)) and sum(bool(r) for _, r, _ in found) > 20


def test_runs_of_one_character_and_periods(spark):
    documents = [(0, "-" * 200), (1, "a" + "-" * 120 + "b"), (2, "-" * 49), (3, "ab" * 70), (4, "b" + "ab" * 40 + "c"), (5, "-" * 50 + "ab" * 25)]
    assert sorted(cleaned(spark.createDataFrame(documents, "doc_id long, text string"))) == brute(documents, 50)


def test_long_texts_are_cut_in_slices(spark, monkeypatch):
    chance = random.Random(2)
    long = "".join(chance.choice("abcdefgh ") for _ in range(3 * passages.BLOCK_BYTES))
    documents = [(0, long), (1, "x" + long[100_000:300_000] + "y"), (2, long[-60:])]
    found = cleaned(spark.createDataFrame(documents, "doc_id long, text string"))
    assert sorted(found) == [(0, [], long.encode()), (1, [(1, 200_001)], b"xy"), (2, [(0, 60)], b"")]


def test_a_text_over_several_chunks(spark):
    """Its slices are in chunks of their own, and passages over their edges are found."""
    long = np.random.default_rng(4).choice(np.frombuffer(b"abcdefgh ", np.uint8), passages.CHUNK_BYTES + 6 * passages.BLOCK_BYTES).tobytes().decode()
    edge = passages.CHUNK_BYTES + 2 * passages.BLOCK_BYTES
    documents = [(0, long), (1, "x" + long[edge - passages.BLOCK_BYTES * 3 : edge] + "y"), (2, long[-60:]), (3, "z" + long[passages.BLOCK_BYTES - 30 :][:60])]
    found = cleaned(spark.createDataFrame(documents, "doc_id long, text string").repartition(1))
    assert sorted(found) == [(0, [], long.encode()), (1, [(1, 1 + 3 * passages.BLOCK_BYTES)], b"xy"), (2, [(0, 60)], b""), (3, [(1, 61)], b"z")]


def test_only_passages_of_several_documents_are_gathered(spark, monkeypatch):
    """What a document repeats within itself is no work, whatever the number of such documents."""
    gathered = []

    def stored(frame, purpose):
        gathered.append((purpose, step := original(frame, purpose)))
        return step

    original = passages.stored
    monkeypatch.setattr(passages, "stored", stored)
    monkeypatch.setattr(passages, "discard", lambda *steps: None)
    lines = [hashlib.sha256(b"%d" % i).hexdigest() + "\n" for i in range(200)]
    shared = "a passage of over fifty bytes that stands in two of the documents"
    documents = [(i, line * 3 + shared * (i in (50, 120))) for i, line in enumerate(lines)]
    found = cleaned(spark.createDataFrame(documents, "doc_id long, text string").repartition(3))
    assert sorted(found) == sorted(brute(documents, 50)) and [i for i, runs, _ in found if runs] == [120]
    steps = dict(gathered)
    assert {r.doc_id for r in steps["document-anchors"].collect()} == {50, 120}
    assert steps["surroundings"].count() < 30


def test_each_window_has_one_anchor():
    chance = random.Random(3)
    texts = [bytes(chance.choice(b"abc") for _ in range(chance.randrange(200))) for _ in range(40)]
    for block in blocks(texts, 50):
        text, _, place, low, high = anchors([b for _, _, b in block], 50, 20, passages.Powers())
        windows = sorted((block[t][0], p - o) for t, p, a, b in zip(text, place, low, high, strict=True) for o in range(a, b + 1))
        assert windows == [(i, p) for i, t in enumerate(texts) for p in range(len(t) - 49)]


def test_a_collision_is_found_and_sorted_anew(monkeypatch):
    """With a base of 1 all bytes of equal sum collide; the bytes of neighbours tell."""
    chance = random.Random(5)
    around = [bytes(chance.choice(b"ab") for _ in range(12)) for _ in range(60)]
    zeros, ones = np.zeros(60, np.int64), np.ones(60, np.int64)

    def least():
        row, found = least_rows(around, zeros, 2 * ones, zeros, 2 * ones, 9)
        return list(zip(row.tolist(), found.tolist(), strict=True))

    want = [(i, min(j for j in range(60) if around[j][2 - o : 11 - o] == a[2 - o : 11 - o])) for i, a in enumerate(around) for o in range(3)]
    assert least() == want
    monkeypatch.setattr(passages, "BASE", 1)
    assert least() == want


def test_odd_rows(spark):
    long = "a passage of over fifty bytes that stands in several documents, as it is"
    rows = [
        (None, long, 1, "v"), (1, None, 2, "v"), (2, "", 3, "v"), (3, "é" * 10, 4, "v"), (4, f"own {long}", 5, "v"), (4, f"other {long}", 6, "v"),
        (5, long, 7, "v"), (5, long, 7, "v"), (6, f"{long}{long}!", 8, "v"),
    ]
    frame = spark.createDataFrame(rows, "doc_id long, text string, passages int, version string")
    got = remove_passages(frame)
    assert sorted(got.columns) == ["doc_id", "passages", "text", "version"]
    found = [(r.doc_id, [tuple(x) for x in r.passages.removed], bytes(r.passages.kept)) for r in got.collect()]
    assert sorted(found, key=str) == sorted(brute([r[:2] for r in rows], 50), key=str)
    assert remove_passages(frame.limit(0)).count() == 0
    assert got.where("version = 'v'").agg(F.count("*")).first()[0] == len(rows)
