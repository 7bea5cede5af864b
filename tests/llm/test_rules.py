import random

import pytest

from trailmark.llm.rules import RULES, Rule, estimate, judge

from tests.llm import brute

GOOD = "The first sentence has some words in it. Another one follows with others. "


def corpus():
    chance = random.Random(5)
    words = ["a", "bc", "defg", "Hij.", "K!!", "l***", "|", "ümn"]
    texts = [None, "", " \n\t", "one", "a b c a b c", "\x0ba\x0cb\rc ", "a " * 60, "x y\n\nx y\n x y\nx y"]
    texts += [" ".join(chance.choice(words) for _ in range(chance.randrange(1, 200))).replace("bc a", "bc\na") for _ in range(120)]
    return [*enumerate(texts), (None, GOOD), (3, "one")]


def test_measures_equal_brute_force(spark):
    rows = corpus()
    frame = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, n_words string")
    found = judge(frame).collect()
    assert len(found) == len(rows)
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    got = sorted(((r.doc_id or 0, *(r[n] for n in names)) for r in found))
    assert got == sorted((i or 0, *brute.base_rules(t)) for i, t in rows)
    assert not any(r.kept and r.base_failed for r in found)
    assert judge(frame.limit(0)).count() == 0


def test_expectation_maximisation_recovers_accuracies():
    chance = random.Random(1)
    share, accuracies, patterns = 0.7, [(0.95, 0.9), (0.99, 0.3), (0.7, 0.65), (0.9, 0.9)], {}
    for _ in range(20_000):
        good = chance.random() < share
        right = [chance.random() < (a if good else b) for a, b in accuracies]
        votes = tuple(0 if chance.random() < 0.2 else (1 if r == good else -1) for r in right)
        patterns[votes] = patterns.get(votes, 0) + 1
    found_share, found = estimate(sorted(patterns.items()))
    assert found_share == pytest.approx(share, abs=0.03)
    assert all(x == pytest.approx(y, abs=0.04) for x, y in zip(found, accuracies))
    assert estimate([]) == (0.8, [])


def test_clean_texts_are_kept_and_junk_goes(spark):
    chance = random.Random(2)

    def prose(n):
        return " ".join("".join(chance.choice("abcdefgh") for _ in range(chance.randrange(2, 8))) + ("." if i % 9 == 8 else "") for i in range(n))

    good = [(i, prose(chance.randrange(60, 900))) for i in range(60)]
    bad = [(100 + i, " ".join(w.upper() + "***" for w in prose(100).replace(".", "").split())) for i in range(20)]
    kept = {r.doc_id: r.kept for r in judge(spark.createDataFrame(good + bad, "doc_id long, text string")).collect()}
    assert all(kept[i] for i, _ in good) and not any(kept[i] for i, _ in bad)


def test_own_rules_and_plan(spark):
    frame = spark.createDataFrame([(1, GOOD * 9), (2, GOOD * 9 + "x")], "doc_id long, text string")
    rules = (Rule("even", "doc_id % 2 = 0", "doc_id % 2 = 1"),)
    assert "vote_even" in judge(frame, rules).columns
    with pytest.raises(ValueError, match="at most"):
        judge(frame, RULES * 2)
    text = judge(frame)._jdf.queryExecution().toString()
    assert not any(n in text for n in ("Python", "Arrow", "Pandas"))


def test_posterior_is_bayes_rule_over_the_votes(spark):
    """As a plain product of chances, with the accuracies estimated from the plain vote patterns."""
    chance = random.Random(4)

    def text(i):
        prose = [f"{'abcdefgh'[n % 8]}{chr(97 + n // 8 % 26)}{chance.choice('xyz')}w" + "." * (n % 9 == 8) for n in range(60 + i)]
        return " ".join(prose + [f"X{n}***" for n in range(i % 4 * 25)])

    rows = [(i, text(i)) for i in range(120)]
    found = judge(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    names = [f"vote_{r.name}" for r in RULES]
    patterns = {}
    for r in found:
        if not r.base_failed:
            votes = tuple(r[n] for n in names)
            patterns[votes] = patterns.get(votes, 0) + 1
    assert len(patterns) > 2
    share, accuracies = estimate(sorted(patterns.items()))
    for r in found:
        yes, no = share, 1 - share
        for (a, b), n in zip(accuracies, names, strict=True):
            yes *= {1: a, -1: 1 - a, 0: 1}[r[n]]
            no *= {1: 1 - b, -1: b, 0: 1}[r[n]]
        assert r.posterior == pytest.approx(yes / (yes + no), rel=1e-9, abs=1e-12)
        assert r.kept == (not r.base_failed and r.posterior >= 0.5)


def test_a_very_long_text(spark):
    chance = random.Random(3)
    text = " ".join(chance.choice(["alpha", "beta", "Gamma.", "d\nd", "#x"]) + str(chance.randrange(400)) for _ in range(120_000))
    (r,) = judge(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
    assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute.base_rules(text)
