"""Quality rules as weak supervision.

Each rule votes for a document (1), against it (-1) or abstains (0). Expectation-maximisation over
the counts of vote patterns estimates each rule's accuracies and the share of good documents without
any label, and a document's posterior probability of being good replaces "all rules must pass".
A rule has two accuracies among its votes: a on good documents, b on others. A vote for adds
log(a / (1 - b)) to the log-odds, a vote against log((1 - a) / b). So a rule that votes for nearly
all says little by it, and much when it votes against.

All work on texts is column expressions. The driver sees the vote patterns only, at most 3 to the
number of rules, whatever the number of documents.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailmark.llm.common import SPACE, stored

#: Fixed by the contract: too few words, or over half of them in repeated windows.
LEAST_WORDS, REPEATED_PER_CENT = 50, 50
#: Bounds of an accuracy; a rule is never taken for worse than chance (a + b >= 1), so a vote for
#: never lowers the posterior.
LEAST, MOST = 0.01, 0.99
FIRST_ACCURACIES, FIRST_SHARE = (0.95, 0.5), 0.8
ROUNDS, SETTLED = 200, 1e-9
#: Kept if the posterior is at least this.
KEEP = 0.5
MAX_RULES = 12


@dataclass(frozen=True)
class Rule:
    """Votes for a document where good holds, else against it where bad holds, else abstains. The
    expressions are over the columns of text_measures; null is false.
    """

    name: str
    good: str
    bad: str

    def vote(self) -> Column:
        return F.when(F.expr(self.good), 1).when(F.expr(self.bad), -1).otherwise(0).cast("tinyint")


RULES = (
    Rule("length", "n_words >= 50 AND n_words <= 200000", "n_words < 20"),
    Rule("word_length", "word_chars BETWEEN 2.5 * n_words AND 10 * n_words", "n_words > 0 AND NOT word_chars BETWEEN 2 * n_words AND 15 * n_words"),
    Rule("symbols", "n_symbols <= 0.05 * n_words", "n_symbols > 0.2 * n_words"),
    Rule("dup_lines", "n_lines > 0 AND n_dup_lines <= 0.1 * n_lines", "n_dup_lines > 0.3 * n_lines"),
    Rule("repeats", "n_words > 0 AND n_repeat_words <= 0.1 * n_words", "n_repeat_words > 0.3 * n_words"),
    Rule("capitals", "n_upper <= 0.15 * word_chars", "n_upper > 0.3 * word_chars"),
    Rule("sentences", "n_stops BETWEEN 0.02 * n_words AND 0.4 * n_words", "n_words >= 100 AND n_stops < 0.005 * n_words"),
    Rule("plain_words", "n_plain_words >= 0.8 * n_words", "n_plain_words < 0.6 * n_words"),
    Rule("variety", "n_distinct_words >= 0.2 * least(n_words, 2000)", "n_distinct_words < 0.1 * least(n_words, 2000)"),
)


def text_measures(documents: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc_id, and what the rules look at) for each row. The arrays stand in columns of their own, each
    read more than once, so that each is made once for a row.
    """
    whole = documents.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    bare = F.regexp_replace("text", rf"^{SPACE}|{SPACE}\z", "")
    nothing = F.array().cast("array<string>")
    worded = whole.select(
        "*",
        F.when(bare == "", nothing).otherwise(F.split(bare, SPACE)).alias("words"),
        F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
    )
    words = F.col("words")

    def window(i: Column) -> Column:
        return F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2))

    windows = F.when(F.size("words") >= 3, F.transform(F.sequence(F.lit(0), F.size("words") - 3), window))
    hashed = worded.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("text", r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.length(F.regexp_replace("text", r"[^\p{Lu}]+", "")).cast("long").alias("n_upper"),
        F.length(F.regexp_replace("text", r"[^.!?]+|[.!?]+(?=[^\s.!?])", "")).cast("long").alias("n_stops"),
        F.size(F.array_distinct("words")).cast("long").alias("n_distinct_words"),
        # Letters, with at most one sign behind.
        F.size(F.filter("words", lambda w: w.rlike(r"^\p{L}+[.,;:!?]?\z"))).cast("long").alias("n_plain_words"),
        F.coalesce(windows, F.array().cast("array<bigint>")).alias("windows"),
    )
    # Equal windows stand together when sorted; only texts that have some are sorted.
    placed = F.sort_array(F.transform("windows", lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    none = F.array().cast("array<struct<h:bigint,i:int>>")
    ordered = hashed.withColumn("ordered", F.when(F.size(F.array_distinct("windows")) < F.size("windows"), placed).otherwise(none)).drop("windows")

    def twice(x: Column, k: Column) -> Column:
        same = [F.coalesce(F.get(F.col("ordered"), at)["h"] == x["h"], F.lit(False)) for at in (k - 1, k + 1)]
        return F.when(same[0] | same[1], x["i"])

    starts = F.array_sort(F.filter(F.transform("ordered", twice), lambda i: i.isNotNull()))
    repeated = ordered.withColumn("starts", starts).drop("ordered")
    # A window covers three words, less those that the next one covers too.
    own = F.transform("starts", lambda i, k: F.least(F.lit(3), F.coalesce(F.get(F.col("starts"), k + 1) - i, F.lit(3))))
    total = F.aggregate(own, F.lit(0), lambda a, x: a + x)
    return repeated.withColumn("n_repeat_words", total.cast("long")).drop("starts")


def vote_weights(accuracies: tuple[float, float]) -> tuple[float, float]:
    """What a vote for, and a vote against, adds to the log-odds."""
    a, b = accuracies
    return math.log(a / (1 - b)), math.log((1 - a) / b)


def estimate(patterns: list[tuple[tuple[int, ...], int]]) -> tuple[float, list[tuple[float, float]]]:
    """The share of good documents and each rule's two accuracies, from vote patterns and their counts."""
    rules = len(patterns[0][0]) if patterns else 0
    share, accuracies = FIRST_SHARE, [FIRST_ACCURACIES] * rules
    before = -math.inf
    for _ in range(ROUNDS if patterns else 0):
        good = total = likelihood = 0.0
        right = [[0.0, 0.0] for _ in range(rules)]  # votes that are right, on good documents and others
        cast = [[0.0, 0.0] for _ in range(rules)]
        for votes, n in patterns:
            yes, no = math.log(share), math.log(1 - share)
            for (a, b), v in zip(accuracies, votes, strict=True):
                if v:
                    yes += math.log(a if v > 0 else 1 - a)
                    no += math.log(b if v < 0 else 1 - b)
            top = max(yes, no)
            sum_ = math.exp(yes - top) + math.exp(no - top)
            p = math.exp(yes - top) / sum_
            likelihood += n * (top + math.log(sum_))
            good += n * p
            total += n
            for k, v in enumerate(votes):
                if v:
                    cast[k][0] += n * p
                    cast[k][1] += n * (1 - p)
                    right[k][v < 0] += n * (p if v > 0 else 1 - p)
        share = min(0.999, max(0.001, good / total))
        accuracies = []
        for r, c in zip(right, cast, strict=True):
            a = min(MOST, max(0.5, r[0] / c[0])) if c[0] else FIRST_ACCURACIES[0]
            b = min(MOST, max(LEAST, 1 - a, r[1] / c[1])) if c[1] else FIRST_ACCURACIES[1]
            accuracies.append((a, b))
        if likelihood - before < SETTLED * total:
            break
        before = likelihood
    return share, accuracies


def judge(documents: DataFrame, rules: tuple[Rule, ...] = RULES, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """For each row doc_id, the measures of text_measures, a vote for each rule (vote_<name>), posterior,
    base_failed and kept (not base_failed, and a posterior of KEEP or more).

    A null or empty text has no words and fails. Rows stay as they are, repeated ones and null ids
    included; other columns are left out. The measures are written to the shared folder once. An
    empty table gives an empty table.
    """
    if len(rules) > MAX_RULES:
        raise ValueError(f"at most {MAX_RULES} rules")
    votes = [f"vote_{r.name}" for r in rules]
    measured = text_measures(documents, doc_id, text)
    voted = stored(measured.select("*", *[r.vote().alias(v) for r, v in zip(rules, votes, strict=True)]), "rule-votes")
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEATED_PER_CENT * F.col("n_words"))
    # The rules are to tell apart what the fixed base leaves open.
    patterns = voted.where(~failed).groupBy(*votes).agg(F.count("*").alias("n")).orderBy(*votes).collect()
    share, accuracies = estimate([(tuple(r[v] for v in votes), r["n"]) for r in patterns])
    odds = F.lit(math.log(share / (1 - share)))
    for vote, accuracy in zip(votes, accuracies, strict=bool(accuracies)):
        good, bad = vote_weights(accuracy)
        odds = odds + F.when(F.col(vote) > 0, good).when(F.col(vote) < 0, bad).otherwise(0.0)
    return (
        voted.withColumn("posterior", 1 / (1 + F.exp(-odds)))
        .withColumn("base_failed", failed)
        .withColumn("kept", ~failed & (F.col("posterior") >= KEEP))
    )
