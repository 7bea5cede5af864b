import random

from pyspark.sql import functions as F

from trailmark.llm.lines import dedup_lines

from tests.llm import brute


def corpus(n=60):
    chance = random.Random(6)
    words = [f"w{i}" for i in range(60)] + ["the", "of"] * 10
    popular = [[chance.choice(words) for _ in range(chance.choice([3, 12, 40]))] for _ in range(8)]
    documents = []
    for i in range(n):
        lines = []
        for _ in range(chance.choice([1, 3, 8])):
            line = list(chance.choice(popular)) if chance.random() < 0.6 else [chance.choice(words) for _ in range(chance.randrange(0, 30))]
            for _ in range(chance.choice([0, 0, 1, 2])):
                if line:
                    line[chance.randrange(len(line))] = chance.choice(words)
            text = chance.choice([" ", "  ", "\t"]).join(line)
            lines.append(text.upper() if chance.random() < 0.2 else f" {text}\r" if chance.random() < 0.2 else text)
        documents.append((i, "\n".join(lines)))
    return documents


def cleaned(documents, gone):
    return {i: "\n".join(l for n, l in enumerate(t.split("\n")) if (i, n) not in gone) for i, t in documents}


def test_equals_brute_force(spark):
    documents = corpus()
    frame = spark.createDataFrame(documents, "doc_id long, text string").repartition(5)
    for similarity, shingle in ((0.8, 5), (0.8, 1), (0.5, 2)):
        gone = brute.repeated_lines(documents, similarity, shingle)
        found = {r.doc_id: r for r in dedup_lines(frame, similarity, shingle).collect()}
        assert {i: r.text for i, r in found.items()} == cleaned(documents, gone)
        assert sum(r.n_removed for r in found.values()) == len(gone) > 10
        assert all(found[i].n_lines == len(t.split("\n")) for i, t in documents)


def test_a_large_group_of_variants(spark):
    """Each variant differs from the first in one word, from the others in two."""
    line = [f"t{i}" for i in range(60)]
    documents = [(i, " ".join(line[:i] + [f"v{i}"] + line[i + 1 :])) for i in range(60)] + [(99, " ".join(line))]
    frame = spark.createDataFrame(documents, "doc_id long, text string")
    found = {r.doc_id: r.text for r in dedup_lines(frame).collect()}
    assert found == cleaned(documents, brute.repeated_lines(documents))


def test_odd_rows(spark):
    rows = [
        (None, "same line of five words", 1, "x"), (1, None, 2, "x"), (2, "", 3, "x"), (3, "\n \n\n", 4, "x"),
        (4, "same line of five words\nown", 5, "x"), (5, "a b\nown", 6, "x"), (5, "a b\nown", 6, "x"), (5, "a c", 7, "x"),
        (6, " ".join(["long"] * 50_000), 8, "x"),
    ]
    frame = spark.createDataFrame(rows, "doc_id long, text string, n_lines int, version string")
    got = dedup_lines(frame)
    assert sorted(got.columns) == ["doc_id", "n_lines", "n_removed", "text", "version"]
    found = sorted((r.doc_id or 0, r.text, r.n_lines, r.n_removed) for r in got.where("doc_id <> 6 OR doc_id IS NULL").fillna("NULL", ["text"]).collect())
    assert found == [
        # A null id comes first, so its line stays and the later one goes.
        (0, "same line of five words", 1, 0), (1, "NULL", 0, 0), (2, "", 1, 0), (3, "\n \n\n", 4, 0),
        # Equal rows are one document: both lose what an earlier document has.
        (4, "own", 2, 1), (5, "a b", 2, 1), (5, "a b", 2, 1), (5, "a c", 1, 0),
    ]
    assert got.where("doc_id = 6").select(F.length("text")).first()[0] == 50_000 * 5 - 1
    assert dedup_lines(frame.limit(0)).count() == 0


def thue_morse(n):
    return "".join("ab"[i.bit_count() & 1] for i in range(n))


def test_words_that_a_polynomial_hash_takes_for_equal(spark):
    one = thue_morse(2048)
    other = one.translate(str.maketrans("ab", "ba"))
    documents = [(1, f"{one} x\nsame line"), (2, f"{other} x\n{one}  X"), (3, f"{other}\n{other.upper()} X\nsame  LINE")]
    frame = spark.createDataFrame(documents, "doc_id long, text string")
    found = {r.doc_id: r.text for r in dedup_lines(frame).collect()}
    assert found == cleaned(documents, brute.repeated_lines(documents)) == {1: documents[0][1], 2: f"{other} x", 3: other}


def test_tokens_that_meet_in_a_hash_are_verified(spark, monkeypatch):
    """With a few bits of each hash, and one class, nearly all tokens meet."""
    from trailmark.llm import lines

    monkeypatch.setattr(lines, "HASH_BITS", 3)
    monkeypatch.setattr(lines, "FILTER_WORDS", 1)
    documents = corpus(25)
    frame = spark.createDataFrame(documents, "doc_id long, text string")
    found = {r.doc_id: r.text for r in dedup_lines(frame, 0.8, 1).collect()}
    gone = brute.repeated_lines(documents, 0.8, 1)
    # Sets of such tokens differ from the lines', so some pairs may be missed, but none is made up.
    assert all(set(t.split("\n")) >= set(cleaned(documents, gone)[i].split("\n")) - {""} for i, t in found.items())


def test_plan_is_native(spark):
    frame = spark.createDataFrame(corpus(4), "doc_id long, text string")
    text = dedup_lines(frame)._jdf.queryExecution().toString()
    assert not any(n in text for n in ("Python", "InArrow", "Pandas"))


def test_long_lines_that_share_a_passage_are_not_paired(spark, monkeypatch):
    """Long lines with a common passage, no two alike, and one variant: pairs are few, none is lost."""
    from trailmark.llm import lines

    counts = {}
    kept = lines.stored

    def counting(frame, purpose):
        found = kept(frame, purpose)
        counts[purpose] = counts.get(purpose, 0) + found.count()
        return found

    monkeypatch.setattr(lines, "stored", counting)
    passage = " ".join(f"p{i}" for i in range(40))
    documents = [(i, f"{passage} " + " ".join(f"x{i}y{k}" for k in range(200))) for i in range(60)]
    documents.append((99, documents[7][1] + " end"))
    frame = spark.createDataFrame(documents, "doc_id long, text string")
    found = {r.doc_id: r.text for r in dedup_lines(frame).collect()}
    assert found == cleaned(documents, brute.repeated_lines(documents)) and found[99] == ""
    assert sum(n for p, n in counts.items() if p.endswith("line-pairs")) < 60


def test_variants_that_do_not_match_are_not_paired(spark, monkeypatch):
    """Lines of some eighty tokens with four words of a common line changed: few of the pairs are verified."""
    from trailmark.llm import lines

    counts = {}
    kept = lines.stored

    def counting(frame, purpose):
        found = kept(frame, purpose)
        counts[purpose] = counts.get(purpose, 0) + found.count()
        return found

    monkeypatch.setattr(lines, "stored", counting)
    chance = random.Random(4)
    documents = []
    for i in range(80):
        line = [f"t{k}" for k in range(87)]
        for k in chance.sample(range(87), 4):
            line[k] = f"v{i}x{k}"
        documents.append((i, " ".join(line)))
    frame = spark.createDataFrame(documents, "doc_id long, text string")
    found = {r.doc_id: r.text for r in dedup_lines(frame).collect()}
    assert found == cleaned(documents, brute.repeated_lines(documents))
    assert sum(n for p, n in counts.items() if p.endswith("line-pairs")) < 40


def test_words_of_odd_lines(spark):
    """Capitals beyond ASCII stay; every kind of white space parts words."""
    from trailmark.llm.lines import words_of

    bodies = [
        "", " ", "  A  b ", "Été ÉTÉ été", "İI ıK ΟΣ ǅ Ⅷ Ⓐ ÀB", "ñandú NIÑO", "a\tB\x0bC\x0cd\re", "\tA", "A\r", "Ünder  ÜBER\té", "ß SS", " A  B",
    ]
    frame = spark.createDataFrame(list(enumerate(bodies)), "i int, body string")
    found = dict(frame.select("i", words_of(F.col("body"))).collect())
    assert [found[i] for i in range(len(bodies))] == [brute.split(brute.lowered(b)) for b in bodies]


def test_copies_of_a_line_read_the_texts_of_pairs_only(spark):
    """Equal rows are one line; a copy goes if its first stays, and if it goes."""
    line = [f"t{k}" for k in range(40)]
    near = " ".join([*line[:-1], "other"])
    rows = [(None, near), (None, near), (1, " ".join(line)), (1, " ".join(line)), (2, f"{near}\n{' '.join(line)}\nnew"), (3, "new\nNEW")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = sorted((r.doc_id or 0, r.text, r.n_removed) for r in dedup_lines(frame).collect())
    assert found == [(0, near, 0), (0, near, 0), (1, "", 1), (1, "", 1), (2, "new", 2), (3, "", 2)]


def test_canonical_texts_are_equal_only_if_ascii_capitals_differ(spark):
    """All letters of two bytes, and some of more, beside each other and their lower case."""
    from trailmark.llm.lines import canonical

    letters = [chr(i) for i in range(0x80, 0x800)] + [chr(i) for i in (0x1E00, 0x2126, 0x212A, 0x212B, 0x3042, 0xFF21, 0x1F600)]
    texts = sorted({t for x in letters for t in (x, x.lower(), f"{x}\u00e9", f"A{x}b", f"a{x}B")} | {"K", "k", "Ab", "aB"})
    frame = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    found = dict(frame.select("i", canonical(F.col("text"))).collect())
    assert len({(brute.lowered(t), found[i]) for i, t in enumerate(texts)}) == len(set(found.values())) == len({brute.lowered(t) for t in texts})
