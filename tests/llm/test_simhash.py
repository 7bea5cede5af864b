import random

from trailmark.llm import simhash
from trailmark.llm.components import components
from trailmark.llm.simhash import ball, fingerprint, keep_one, near_duplicates

from tests.llm import brute


def signed(value):
    return value - (1 << 64) if value >= 1 << 63 else value


def corpus(n=120):
    chance = random.Random(8)
    words = [f"w{i}" for i in range(400)]
    base = [[chance.choice(words) for _ in range(chance.choice([30, 200]))] for _ in range(12)]
    documents = []
    for i in range(n):
        body = list(chance.choice(base))
        for _ in range(chance.choice([0, 0, 1, 2, 30])):
            body[chance.randrange(len(body))] = chance.choice(words)
        documents.append((1000 - i, " ".join(body)))
    return [*documents, (5000, None), (5001, ""), (5002, " \n"), (5003, "one"), (5004, "One"), (5005, "two words")]


def test_ball():
    assert len(ball(64, 2)) == 1 + 64 + 64 * 63 // 2 and len({m for m, _ in ball(64, 2)}) == 2081
    assert all(bin(m & (1 << 64) - 1).count("1") == k for m, k in ball(64, 2))


def test_fingerprints_equal_brute_force():
    for _, text in [*corpus(40), (0, "É x\x0by\x0cz Ü"), (0, "a " * 9), (0, "A b c d")]:
        assert fingerprint((text or "").encode(), 3) == signed(brute.fingerprint(text))


def test_components_equal_brute_force(spark):
    documents = corpus()
    frame = spark.createDataFrame(documents, "doc_id long, text string")
    prints = {i: brute.fingerprint(t) for i, t in documents}
    for radius in (0, 1, 3, 5):
        found = {r.doc_id: (r.fp, r.component_id) for r in near_duplicates(frame, radius).collect()}
        groups = brute.components(prints, radius)
        assert found == {i: (signed(prints[i]), groups[i]) for i in prints}
    assert len(set(brute.components(prints).values())) < len(prints)


def test_a_chain_is_one_component(spark):
    chance = random.Random(1)
    links = [(i, i + 1) for i in range(300)] + [(chance.randrange(400, 600), chance.randrange(400, 600)) for _ in range(90)]
    links += [(7, 7), (None, 3)]
    groups = brute.Groups({n for x in links for n in x if n is not None})
    for a, b in links:
        if a is not None and a != b:
            groups.join(a, b)
    nodes = {n for a, b in links if a is not None and a != b for n in (a, b)}
    found = components(spark.createDataFrame(links, "a long, b long")).collect()
    assert len(found) == len(nodes) and {r.node: r.root for r in found} == {n: groups.find(n) for n in nodes}


def test_odd_rows(spark):
    rows = [(None, "a b c d", 1), (3, "a b c d", 2), (3, "a b c d", 3), (None, "other words here now", 4), (9, None, 5),
            (None, "quite another text of words", 6), (3, "a text that repeats the id three", 7)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, fp int")
    found = near_duplicates(frame)
    assert found.columns == ["doc_id", "fp", "component_id", "component"]
    assert sorted((r.doc_id or 0, r.component_id or 0) for r in found.collect()) == [
        (0, 0), (0, 0), (0, 3), (3, 3), (3, 3), (3, 3), (9, 9),
    ]
    kept = keep_one(frame)
    assert kept.columns == frame.columns
    assert sorted((r.doc_id or 0, r.text or "", r.fp) for r in kept.collect()) == [
        (0, "other words here now", 4), (0, "quite another text of words", 6), (3, "a b c d", 2),
        (3, "a text that repeats the id three", 7), (9, "", 5),
    ]
    assert near_duplicates(frame.limit(0)).count() == 0 and keep_one(frame.limit(0)).count() == 0


def test_a_text_of_more_shingles_than_are_counted_at_once():
    chance = random.Random(12)
    text = " ".join(chance.choice(["a", "Bc", "é", "word"]) + str(chance.randrange(900)) for _ in range(simhash.RUN + 5000))
    assert simhash.fingerprint(text.encode(), 3) % (1 << 64) == brute.fingerprint(text)
