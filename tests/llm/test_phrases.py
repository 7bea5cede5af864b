import random
import re
from collections import Counter

import pytest

from trailmark.llm import phrases
from trailmark.llm.phrases import Words, blocks, collocations, exact_score

from tests.llm import brute


def words_of(text):
    return [[w for w in re.split("[ \t]+", p) if w] for p in re.split("[.,;:!?\n\x0b\x0c\r]", brute.lowered(text))]


def brute_force(documents, longest, least, top):
    """documents: [(lang, text)]. The rows, in order."""
    count, total = {}, Counter()
    for lang, text in documents:
        f = count.setdefault(lang or "und", Counter())
        for piece in words_of(text):
            total[lang or "und"] += len(piece)
            for m in range(1, longest + 1):
                f.update(tuple(piece[i : i + m]) for i in range(len(piece) - m + 1))
    rows = []
    for lang, f in count.items():
        n, found = total[lang], []
        frequent = [p for p, a in f.items() if len(p) > 1 and a >= least]
        held = set()
        for p in frequent:
            held |= {q for i in range(len(p)) for j in range(i + 2, len(p) + 1) if len(q := p[i:j]) < len(p) and f[p] >= f[q]}
        for p in frequent:
            if p not in held:
                cuts = [(1000 * f[p] * n // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p))]
                score, k = min(cuts)
                found.append((-score, -f[p], " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, p, l, r) in enumerate(sorted(found)[:top], 1):
            rows.append((lang, rank, p.decode(), -a, l, r, n, -score))
    return sorted(rows)


def corpus():
    chance = random.Random(7)
    words = ["der", "Une", "é", "of the", "in", "x,", "y. Z", "a\tb", "ja\n", "nö", "q;"] + [f"w{i}" for i in range(30)]
    fixed = ["one two three four five six", "Once upon a time", "ja nein"]
    rows = []
    for _ in range(300):
        parts = [chance.choice(words if chance.random() < 0.8 else fixed) for _ in range(chance.randrange(60))]
        rows.append((chance.choice(["de", "fr", None, "und"]), chance.choice([" ", "  ", " \t"]).join(parts)))
    return rows


def found(frame, **options):
    return sorted(tuple(r) for r in collocations(frame, **options).collect())


@pytest.mark.parametrize("longest, least, top", [(5, 10, 2000), (5, 10, 6), (2, 3, 50), (7, 8, 2000), (3, 4, 30)])
def test_equals_brute_force(spark, longest, least, top):
    documents = corpus()
    frame = spark.createDataFrame(documents, "lang string, text string").repartition(5)
    want = brute_force(documents, longest, least, top)
    assert found(frame, longest=longest, least=least, top=top) == want and len(want) > 10


def test_a_saturated_filter_changes_nothing(spark, monkeypatch):
    """Eight bits let nearly every run pass."""
    documents = corpus()[:120]
    monkeypatch.setattr(phrases, "FILTER_BITS", 8)
    frame = spark.createDataFrame(documents, "lang string, text string")
    assert found(frame, least=5) == brute_force(documents, 5, 5, 2000)


def test_long_texts_are_cut_between_words(spark, monkeypatch):
    monkeypatch.setattr(phrases, "BLOCK_BYTES", 50)
    text = " ".join(t for _, t in corpus()[:100])
    for longest in (2, 5):
        parts = [b for block in blocks([text.encode()], longest) for b in block]
        assert len(parts) > 20 and sum(own for _, _, own in parts) == len(text.encode())
    words = [w for p in words_of(text) for w in p]
    own = []
    for block in blocks([text.encode(), b"", text.encode()], 5):
        w = Words(block)
        own += [w.known[c].as_py() for c, mine in zip(w.codes.tolist(), w.own, strict=True) if mine]
    assert own == words * 2
    # The tasks' functions are sent by value with the small blocks.
    frame = spark.createDataFrame([("de", text)], "lang string, text string")
    assert found(frame, least=5) == brute_force([("de", text)], 5, 5, 2000)


def test_scores_of_large_numbers(spark):
    a, n, l, r = 10**12 + 7, 10**13 + 1, 3 * 10**12 + 1, 2 * 10**12 + 3
    frame = spark.createDataFrame([(a, n, l, r)], "a long, n long, l long, r long")
    assert frame.select(exact_score("a", "n", "l", "r")).first()[0] == 1000 * a * n // (l * r)


def test_odd_rows(spark):
    rows = [
        ("de", None, 1, "x"), ("de", "", 2, "x"), (None, "ein Wort mehr", 3, "x"), (None, "ein Wort mehr", 3, "x"), ("und", "EIN WORT MEHR!", 4, "x"),
        ("fr", " ".join(["même mot"] * 60_000), 5, "x"), ("es", ".,;:!?\n \t", 6, "x"), ("en", "a b. a b, a\nb", 7, "x"),
    ]
    frame = spark.createDataFrame(rows, "lang string, text string, rank int, phrase string")
    want = brute_force([r[:2] for r in rows], 5, 2, 2000)
    assert found(frame, least=2) == want and ("und", 1, "ein wort mehr", 3, 3, 3, 9, 3000) in want
    assert collocations(frame.limit(0)).count() == 0
