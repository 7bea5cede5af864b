"""Secret scan: candidates by pattern, false ones removed by a random forest.

A candidate is a run of key-like characters in a word, or what follows a secret's name and = or :,
of any length and signs. What the forest sees of it: its length, its
mix of characters and how often the kind changes, the likelihood of its letters' transitions in the
corpus's words, how much of it the corpus's words cover, the path-like signs around it in its word,
and its neighbouring words. It learns from labelled findings.
"""

from __future__ import annotations

import math

from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailmark.llm.common import SPACE, bounded_sample, stored

#: A run of key-like characters; it is a candidate with a digit, or if it is long.
RUN, LONG = r"[A-Za-z0-9+/_\-]{12,}", 20
#: A word of the dictionary occurs so often in all documents.
DICTIONARY_COUNT = 3
#: Words that announce a secret, and formats that are one.
HINTS = ("key", "token", "secret", "password", "passwd", "pwd", "auth", "credential", "bearer")
KNOWN_FORMATS = (r"^AKIA[A-Z0-9]{16}$", r"^gh[pousr]_[A-Za-z0-9]{36}$", r"^xox[abprs]-[A-Za-z0-9\-]{10,}$")
ASSIGNED = r"(?i)(token|secret|password|passwd|pwd|key)\s*[=:]\s*[\"']?$"
#: Bounds of what is learned from, and the forest.
ROWS_PER_LABEL, TREES, DEPTH, SEED = 2000, 20, 6, 7
#: What follows a secret's name, up to its closing quote, or to the end of the word or the next name in
#: it, less closing signs. Looked for in a word and the two before it, so it has to end with the last.
_LEAD = r"(?:key|token|secret|password|passwd|pwd|auth|authorization|credentials?|bearer)[\"']?\s?(?:=>|[=:]{1,2})\s?"
_CLOSING, _NEXT = r"[,;.)\]}>\"'`]*", r"[&;,]\w+="
NAMED_VALUE = (
    rf"(?i)(?<={_LEAD}\")[^\s\"]+(?=\S*$)|(?<={_LEAD}')[^\s']+(?=\S*$)"
    rf"|(?<={_LEAD})[^\s\"'=:>]\S*?(?=(?:{_CLOSING}|{_NEXT}\S*)$)"
)
#: Parts of paths that are words or numbers.
PLAIN_PATH = r"^[/_\-]*([0-9]+|[A-Za-z]+)([/_\-]+([0-9]+|[A-Za-z]+))*[/_\-]*$"
SECRET = 0.5
#: Symbols of transitions: a to z, any digit, any other.
SYMBOLS = 28
FEATURES = (
    "n_chars", "digit_share", "upper_share", "hex_share", "kind_changes", "distinct_share", "transitions",
    "coverage", "path_signs", "in_url", "quoted", "assigned", "hint_before", "hint_inside", "plain_after",
)


def candidates(documents: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc_id, word_no, part_no, word, before, after, value) of every candidate, whole texts."""
    worded = documents.select(F.col(doc_id).alias("doc_id"), F.split(F.coalesce(F.col(text), F.lit("")), SPACE).alias("words"))
    words = F.col("words")

    def hit(word: Column, i: Column) -> Column:
        near = [F.coalesce(F.get(words, i + k), F.lit("")) for k in (-2, -1, 1)]
        separated = word.rlike("[=:]") | near[1].rlike("[=:]")
        named = F.regexp_extract_all(F.concat_ws(" ", near[0], near[1], word), F.lit(NAMED_VALUE), F.lit(0))
        found = F.struct(
            i.alias("word_no"), word.alias("word"), F.concat_ws(" ", near[0], near[1]).alias("before"), near[2].alias("after"),
            F.when(separated, named).otherwise(F.array().cast("array<string>")).alias("named"),
        )
        return F.when(((F.length(word) >= 12) & word.rlike(RUN)) | separated, found)

    hits = F.filter(F.transform(words, hit), lambda h: h.isNotNull())
    each = worded.select("doc_id", F.explode_outer(hits).alias("h")).where(F.col("h").isNotNull()).select("doc_id", "h.*")
    runs = each.withColumn("runs", F.regexp_extract_all("word", F.lit(f"({RUN})")))
    # Named values come after the runs, unless they are one.
    values = F.concat("runs", F.array_except("named", "runs"))
    parts = runs.select("*", F.posexplode_outer(values).alias("part_no", "value"))
    key_like = F.col("value").rlike(f"^{RUN}$") & (F.col("value").rlike("[0-9]") | (F.length("value") >= LONG))
    return parts.where(key_like | F.array_contains("named", F.col("value"))).drop("runs", "named")


def word_counts(documents: DataFrame, text: str) -> DataFrame:
    """(term, n): lower-case words of three letters or more, over all documents."""
    terms = documents.select(F.explode_outer(F.split(F.lower(text), r"[^\p{L}]+")).alias("term"))
    return terms.where(F.length("term") >= 3).groupBy("term").agg(F.count("*").alias("n"))


def symbol(text: Column, i: Column) -> Column:
    code = F.ascii(F.substring(text, i, F.lit(1)))
    return F.when(code.between(97, 122), code - 97).when(code.between(48, 57), 26).otherwise(27)


def transition_table(counts: DataFrame) -> Column:
    """Logarithms of the chance of each symbol after each other, as a constant of SYMBOLS squared."""
    steps = counts.select("term", "n", F.explode_outer(F.sequence(F.lit(1), F.length("term") - 1)).alias("i"))
    pairs = steps.groupBy((symbol(F.col("term"), F.col("i")) * SYMBOLS + symbol(F.col("term"), F.col("i") + 1)).alias("pair"))
    found = dict(pairs.agg(F.sum("n").alias("n")).collect())  # at most SYMBOLS squared
    logs = []
    for a in range(SYMBOLS):
        row = [found.get(a * SYMBOLS + b, 0) + 1 for b in range(SYMBOLS)]
        logs += [f"{math.log(x / sum(row)):.6f}" for x in row]
    return F.split(F.lit(",".join(logs)), ",").cast("array<double>")


def coverage(found: DataFrame, counts: DataFrame) -> DataFrame:
    """(value, coverage): the share of a candidate's characters in its letter runs that are dictionary words."""
    values = found.select("value").distinct()
    runs = values.select("value", F.explode_outer(F.regexp_extract_all(F.lower("value"), F.lit("([a-z]{3,})"))).alias("term"))
    known = counts.where(F.col("n") >= DICTIONARY_COUNT).select("term", F.lit(True).alias("known"))
    covered = F.sum(F.when(F.col("known"), F.length("term")).otherwise(0)) / F.length("value")
    return runs.join(known, "term", "left").groupBy("value").agg(covered.alias("coverage"))


def with_features(found: DataFrame, covered: DataFrame, table: Column) -> DataFrame:
    value, word = F.col("value"), F.col("word")
    n = F.length(value)
    lower = F.lower(value)

    def share(pattern: str) -> Column:
        return F.length(F.regexp_replace(value, pattern, "")) / n

    def is_true(condition: Column) -> Column:
        return F.coalesce(condition, F.lit(False)).cast("double")

    kinds = F.regexp_replace(F.regexp_replace(F.regexp_replace(value, "[a-z]+", "a"), "[A-Z]+", "A"), "[0-9]+", "9")
    steps = F.when(n > 1, F.sequence(F.lit(1), n - 1)).otherwise(F.array().cast("array<int>"))
    likelihood = F.aggregate(
        steps, F.lit(0.0), lambda sum_, i: sum_ + F.get(table, symbol(lower, i) * SYMBOLS + symbol(lower, i + 1))
    )
    hints = "(?i)(" + "|".join(HINTS) + ")"
    # What stands before the value: the two words before, and the start of its own.
    lead = F.concat_ws(" ", "before", F.substring(word, F.lit(1), F.instr("word", value) - 1))
    return found.join(covered, "value").select(
        "doc_id", "word_no", "part_no", "value", "word", lead.alias("lead"),
        n.cast("double").alias("n_chars"),
        share("[^0-9]").alias("digit_share"),
        share("[^A-Z]").alias("upper_share"),
        share("[^0-9a-f]").alias("hex_share"),
        ((F.length(kinds) - 1) / n).alias("kind_changes"),
        (F.size(F.array_distinct(F.split(value, ""))) / n).alias("distinct_share"),
        (likelihood / F.greatest(n - 1, F.lit(1))).alias("transitions"),
        F.col("coverage").cast("double").alias("coverage"),
        F.length(F.regexp_replace(word, r"[^/\\.]+", "")).cast("double").alias("path_signs"),
        is_true(word.contains("://")).alias("in_url"),
        is_true(lead.rlike("[\"']$")).alias("quoted"),
        is_true(lead.rlike(r"[=:]\s*[\"']?$")).alias("assigned"),
        is_true(F.col("before").rlike(hints)).alias("hint_before"),
        is_true(word.rlike(hints)).alias("hint_inside"),
        is_true(F.col("after").rlike(r"^\p{L}+[.,]?$")).alias("plain_after"),
    )


def format_labels(featured: DataFrame) -> Column:
    """Labels of findings that leave no doubt, where none are at hand: 1 for values of a known format or
    assigned to a secret's name; 0 for plain numbers, plain letters and plain paths of addresses without
    credentials; else null. So are short values and those with other signs, which are in doubt.
    """
    value, word = F.col("value"), F.col("word")
    key_like = value.rlike(f"^{RUN}$") & (value.rlike("[0-9]") | (F.length(value) >= LONG))
    known = F.lit(False)
    for pattern in KNOWN_FORMATS:
        known = known | value.rlike(pattern)
    named = F.col("lead").rlike(ASSIGNED) & value.rlike("[0-9]") & value.rlike("[A-Za-z]")
    in_url = word.contains("://")
    plain = value.rlike(r"^([0-9\-]+|[A-Za-z/_\-]+)$") & ~in_url
    plain_path = in_url & value.rlike(PLAIN_PATH) & ~word.rlike("://[^/]*@") & ~F.col("lead").rlike(ASSIGNED)
    return F.when(known | (key_like & named), 1).when(key_like & (plain | plain_path), 0)


def scan_secrets(
    documents: DataFrame, findings: DataFrame | None = None, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """A row for each candidate: doc_id, word_no (its word, from 0), part_no (its place in the word), value,
    probability and is_secret (a probability of SECRET or more).

    findings: (value, label), labels 1 and 0, others are ignored; without it those of format_labels
    count. The forest learns from at most ROWS_PER_LABEL candidates of each label, the first by a hash
    of their value. If a label has none, nothing can be removed: all are secrets, probability null.
    Null and empty texts have no candidates. Rows with repeated or null ids are scanned like others;
    other columns are left out. Counts of words are over all documents.
    """
    found = stored(candidates(documents, doc_id, text), "secret-candidates")
    counts = stored(word_counts(documents, text), "word-counts")
    # Stored, so that the join with it is one of two tables, which a very common value does not hold up.
    covered = stored(coverage(found, counts), "secret-coverage")
    featured = with_features(found, covered, transition_table(counts))
    if findings is None:
        featured = featured.withColumn("label", format_labels(featured))
    else:
        known = findings.where(F.col("label").isin(0, 1)).groupBy("value").agg(F.max("label").cast("int").alias("label"))
        featured = featured.join(known, "value", "left")
    featured = stored(featured.drop("word", "lead"), "secret-features")
    result = featured.select("doc_id", "word_no", "part_no", "value")
    learned = featured.where(F.col("label").isNotNull()).select("value", "label", *FEATURES).dropDuplicates(["value"])
    learned = stored(bounded_sample(learned, "label", "value", ROWS_PER_LABEL), "secret-sample")
    if learned.select("label").distinct().count() < 2:
        return result.withColumn("probability", F.lit(None).cast("double")).withColumn("is_secret", F.lit(True))
    assembled = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, labelCol="label")
    # In the order of their values, so that the same rows make the same forest.
    fitted = forest.fit(assembled.transform(learned.orderBy("value")))
    scored = PipelineModel([assembled, fitted]).transform(featured)
    probability = vector_to_array("probability")[1]
    return scored.select("doc_id", "word_no", "part_no", "value", probability.alias("probability")).withColumn(
        "is_secret", F.col("probability") >= SECRET
    )
