import random

from trailmark.llm import contamination
from trailmark.llm.contamination import find_contamination

from tests.llm import brute


def corpus():
    chance = random.Random(4)
    words = [f"w{n}" for n in range(9)] + ["É", "straße", "x"]
    items = [(n, " ".join(chance.choice(words) for _ in range(chance.choice([2, 5, 14, 30])))) for n in range(25)]
    items += [(None, "w1 w2 w3"), (90, None), (91, "--"), (92, ""), (3, "only w1 here w2")]
    documents = []
    for n in range(80):
        body = [chance.choice(words) for _ in range(chance.choice([0, 3, 60, 300]))]
        if n % 3 == 0:
            source = (chance.choice(items[:25])[1]).split()
            body[len(body) // 2 : len(body) // 2] = source
        documents.append((n, chance.choice([" ", ", ", "-\n"]).join(w.upper() if n % 2 else w for w in body)))
    return items, [*documents, (80, None), (None, "w1 w2"), (5, documents[5][1])]


def test_equals_brute_force_in_one_block_and_in_many(spark, monkeypatch):
    items, documents = corpus()
    frame = spark.createDataFrame(documents, "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    known = [(i, t) for i, t in items if t is not None]
    # One block, one pass of several, and several passes.
    for size in (contamination.BLOCK_BYTES, 700, 120):
        monkeypatch.setattr(contamination, "BLOCK_BYTES", size)
        found = find_contamination(frame, benchmark)
        assert found.columns == ["doc_id", "text", "contamination"]
        rows = found.collect()
        assert len(rows) == len(documents)
        for row in rows:
            c = row.contamination
            n, hit, named = brute.contamination(row.text, known)
            assert (c.n_words, c.n_hit, list(c["items"]), c.contaminated) == (n, hit, named, hit > 0 and 20 * hit >= n)
        assert any(r.contamination.contaminated for r in rows) and not all(r.contamination.contaminated for r in rows)


def test_spans_are_places_in_the_original(spark):
    text = "Ünd dann: THE quick, brown—fox JUMPS. Ünd the quick brown"
    frame = spark.createDataFrame([(1, text)], "doc_id long, text string")
    benchmark = spark.createDataFrame([(7, "the Quick brown"), (8, "jumps")], "item_id long, text string")
    (row,) = find_contamination(frame, benchmark).collect()
    # The dash is a word character, so "brown—fox" is one word.
    assert [text[s.start : s.end] for s in row.contamination.spans] == ["JUMPS", "the quick brown"]
    assert list(row.contamination["items"]) == ["7", "8"] and row.contamination.n_hit == 4


def test_odd_rows(spark):
    frame = spark.createDataFrame([(1, "a b", 1, 2)], "doc_id long, text string, found int, contamination int")
    empty = spark.createDataFrame([], "item_id long, text string")
    got = find_contamination(frame, empty)
    assert got.columns == ["doc_id", "text", "found", "contamination"]
    assert got.first().found == 1 and got.first().contamination.n_words == 2 and not got.first().contamination.contaminated
    benchmark = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert find_contamination(frame.limit(0), benchmark).count() == 0
    long = spark.createDataFrame([(1, "z " * 200_000 + "a b")], "doc_id long, text string")
    assert find_contamination(long, benchmark).first().contamination.n_hit == 2
