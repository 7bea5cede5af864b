"""Near-duplicate lines by an exact set-similarity join; the first of them stays.

A line's tokens are its runs of `shingle` words, lower-cased A-Z, without repeats (all words if there
are fewer). Two lines match if the Jaccard similarity of their token sets is at least `similarity`.
The order of lines is that of (doc_id, hash of the text, number of the line); a line that matches
any earlier line is removed.

Lines of equal words are one to the join, the first of them; they are known by two 64-bit xxHashes of
their words, the only place where a hash decides. Of the different lines, two that match share one
of their first few tokens in any common order (prefix filter). The order is that of the tokens' hashes, so
it needs no counts; tokens are 64-bit xxHashes, less some bits, until a pair is verified on its words;
tokens that meet in a hash are one more candidate.

Prefix tokens that stand in one line only go as soon as the tokens are sorted. A pair that shares a token
is a candidate if the sizes (length filter), the tokens' places in both lines (positional filter) and the
parities of all tokens by their last bits (bitmap filter: each token that only one line has turns one bit) leave
room for a match. Sizes are dealt in classes of which matching lines are at most one apart, so that a
frequent token's lines meet those of like size only. To keep large groups of variants from being paired with
each other, each line is verified against one earlier line of its tokens first; only lines that do not match it
are joined with all earlier lines of their tokens.
"""

from __future__ import annotations

from fractions import Fraction
from functools import reduce
from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from trailmark.llm.common import discard, free_name, step_settings, stored
from trailmark.operators.bitfilter import bit_filter, passes

#: Bits of a token's hash, and 64-bit words of the filters of lines: 2 MB, whatever the input.
HASH_BITS = 48
#: Lines of more tokens have four words of parities.
SHORT = 30
FILTER_WORDS = 1 << 18
#: Parts in which the lines of a token are looked through.
PARTS = 64
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WHITE = "\t\n\x0b\x0c\r"
#: Letters beyond ASCII that lower() changes.
CAPITALS = r"[\p{javaUpperCase}\p{javaTitleCase}&&[^A-Z]]"
KEY, LINE = ["k1", "k2"], ["doc_id", "version", "no"]


class Threshold:
    """Jaccard similarity of at least a / b, in whole numbers."""

    def __init__(self, similarity: float):
        self.a, self.b = Fraction(str(similarity)).as_integer_ratio()

    def prefix_of(self, n: Column) -> Column:
        """Tokens in a prefix: n less the least overlap with a match, plus one."""
        return (n - F.ceil(n * self.a / self.b) + 1).cast("int")

    def size_class(self, n: Column) -> Column:
        """A class of sizes; lines that match are at most one class apart. The base is a little more than the
        largest quotient of their sizes, which leaves room for rounding.
        """
        return F.floor(F.log(n) / (log(self.b / self.a) * 1.001 + 1e-6))

    def possible(self, x: Column, y: Column) -> Column:
        """Whether lines of n tokens that share the token at pos, and whose parities are bits, can match."""
        both, ends = x["n"] + y["n"], self.a + self.b
        sizes = (self.b * F.least(x["n"], y["n"])) >= (self.a * F.greatest(x["n"], y["n"]))
        most = 1 + F.least(x["n"] - x["pos"] - 1, y["n"] - y["pos"] - 1)
        # Bits that differ are at most the tokens that one line has alone.
        own = F.bit_count(x["bits"].bitwiseXOR(y["bits"]))
        words = [F.get(x["parts"], i).bitwiseXOR(F.get(y["parts"], i)) for i in range(4)]
        of_parts = F.coalesce(reduce(lambda done, w: done + F.bit_count(w), words[1:], F.bit_count(words[0])), F.lit(0))
        near = [ends * n <= (self.b - self.a) * both for n in (own, of_parts)]
        return sizes & (ends * most >= self.a * both) & near[0] & near[1]

    def met(self, overlap: Column, n: Column) -> Column:
        """n: tokens of both lines together, shared ones twice."""
        return self.b * overlap >= self.a * (n - overlap)


def replaced(body: Column, signs: str, others: str) -> Column:
    """Each of the signs replaced, one after the other: a search over bytes each, where translate takes a text sign by sign."""
    return reduce(lambda done, pair: F.replace(done, F.lit(pair[0]), F.lit(pair[1])), zip(signs, others, strict=True), body)


def words_of(body: Column) -> Column:
    """Words of a line, lower-cased A-Z. All white space is made spaces, as one sign parts faster than a pattern;
    lines without capitals beyond ASCII are lower-cased as a whole. To look for a sign costs less than to replace it.
    """
    white = reduce(lambda a, b: a | b, [F.contains(body, F.lit(sign)) for sign in WHITE])
    spaced = F.when(white, replaced(body, WHITE, " " * len(WHITE))).otherwise(body)
    plain = (F.octet_length(body) == F.length(body)) | ~F.rlike(body, F.lit(CAPITALS))
    lower = F.when(plain, F.lower(spaced)).otherwise(replaced(spaced, UPPER, LOWER))
    several = white | F.contains(body, F.lit("  ")) | F.startswith(body, F.lit(" ")) | F.endswith(body, F.lit(" "))
    parted = F.split(lower, " ")
    return F.when(several | (body == ""), F.array_remove(parted, "")).otherwise(parted)


def lines_of(documents: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc_id, version, no, body) of every line."""
    return documents.select(
        F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("version"), F.posexplode_outer(F.split(F.col(text), "\n")).alias("no", "body")
    )


def canonical(text: Column) -> Column:
    """A text with A-Z lower-cased, in which every letter beyond ASCII is still told from every other. Texts of ASCII are
    lower-cased as they are. Of others each UTF-8 byte is read as a sign of Latin-1: lower() then also adds 32 to
    first bytes of two-byte signs (C2 to DE, but D7), which makes them first bytes of longer signs (or F5 to FE). The number of bytes
    that follow still tells which, so that different texts stay different, at a fraction of 26 replacements.
    """
    plain = F.octet_length(text) == F.length(text)
    return F.lower(F.when(plain, text).otherwise(F.decode(text.cast("binary"), "ISO-8859-1")))


def worded_lines(documents: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc_id, version, no, body) of every line with a word: its words in canonical form, with one space between them."""
    texts = documents.select(F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("version"), canonical(F.col(text)).alias("text"))
    white = WHITE.replace("\n", "")
    some = reduce(lambda a, b: a | b, [F.contains("text", F.lit(sign)) for sign in white])
    spaced = F.when(some, replaced(F.col("text"), white, " " * len(white))).otherwise(F.col("text"))
    spaced = texts.select("doc_id", "version", spaced.alias("text"))
    lines = spaced.select("doc_id", "version", F.posexplode_outer(F.split("text", "\n")).alias("no", "body")).where(F.ltrim("body") != "")
    body = F.col("body")
    wide = F.contains(body, F.lit("  ")) | F.startswith(body, F.lit(" ")) | F.endswith(body, F.lit(" "))
    narrow = F.array_join(F.array_remove(F.split(body, " "), ""), " ")
    return lines.select(*LINE, F.when(wide, narrow).otherwise(body).alias("body"))


def line_sets(worded: DataFrame, shingle: int, threshold: Threshold) -> DataFrame:
    """(doc_id, version, no, k1, k2, n, bits, parts, prefix): hashes of the line's words, the number of its tokens, the
    parities of the numbers of tokens by their last six bits (of a long line also by their last eight, in four words),
    and the least of them.
    """
    keys = [F.xxhash64("body").alias("k1"), F.xxhash64(F.lit(2), "body").alias("k2")]
    hashed = worded.select(*LINE, *keys, F.transform(F.split("body", " "), lambda w: F.xxhash64(w)).alias("hashed"))

    def shortened(token: Column) -> Column:
        return F.shiftrightunsigned(token, 64 - HASH_BITS)

    starts = F.slice("hashed", F.lit(1), F.greatest(F.size("hashed") - (shingle - 1), F.lit(0)))
    several = F.transform(starts, lambda w, i: shortened(F.xxhash64(w, *[F.get("hashed", i + k) for k in range(1, shingle)])))
    tokens = F.when(F.size("hashed") < shingle, F.array(shortened(F.xxhash64("hashed")))).otherwise(several)
    ordered = hashed.select(*LINE, *KEY, F.sort_array(F.array_distinct(tokens)).alias("ordered"))

    def turned(bits: Column, token: Column) -> Column:
        return bits.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), token.bitwiseAND(F.lit(63)).cast("int")))

    n = F.size("ordered")

    def part(k: int) -> Column:
        own = F.filter("ordered", lambda token: F.shiftright(token, 6).bitwiseAND(F.lit(3)) == k)
        return F.aggregate(own, F.lit(0).cast("bigint"), turned)

    parted = ordered.withColumn("parts", F.when(n > SHORT, F.array(*map(part, range(4)))))
    whole = reduce(lambda a, b: a.bitwiseXOR(b), [F.get("parts", i) for i in range(4)])
    bits = F.when(F.col("parts").isNull(), F.aggregate("ordered", F.lit(0).cast("bigint"), turned)).otherwise(whole).alias("bits")
    return parted.select(*LINE, *KEY, n.alias("n"), bits, "parts", F.slice("ordered", F.lit(1), threshold.prefix_of(n)).alias("prefix"))


def bodies_of(pairs: DataFrame, firsts: DataFrame, documents: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(k1, k2, body) of the lines of the pairs, from the documents; texts and lines of no pair go ahead of the shuffle, but for some."""
    ends = pairs.select(F.col("x1").alias("k1"), F.col("x2").alias("k2")).unionByName(pairs.select(F.col("y1").alias("k1"), F.col("y2").alias("k2")))
    wanted = stored(firsts.join(ends.distinct(), KEY).select(*KEY, *LINE), "wanted-lines")
    of_text, of_line = F.xxhash64(text), F.xxhash64("version", "no")
    near = documents.where(passes(bit_filter(wanted, F.col("version"), FILTER_WORDS), of_text, FILTER_WORDS))
    found = lines_of(near, doc_id, text).where(passes(bit_filter(wanted, of_line, FILTER_WORDS), of_line, FILTER_WORDS))
    same = F.col("doc_id").eqNullSafe(F.col("x_doc_id")) & (F.col("version") == F.col("x_version")) & (F.col("no") == F.col("x_no"))
    found = found.join(wanted.withColumnsRenamed({c: f"x_{c}" for c in LINE}), same)
    bodies = stored(found.select(*KEY, "body"), "line-bodies")
    discard(wanted)
    return bodies


def matches(pairs: DataFrame, bodies: DataFrame, shingle: int, threshold: Threshold) -> DataFrame:
    """(k1, k2) of the lines x of the pairs (x1, x2, y1, y2) whose sets of word runs match."""

    def named(side: str) -> DataFrame:
        return bodies.select(F.col("k1").alias(f"{side}1"), F.col("k2").alias(f"{side}2"), words_of(F.col("body")).alias(side))

    def runs(words: str) -> Column:
        places = F.sequence(F.lit(1), F.size(words) - (shingle - 1))
        several = F.transform(places, lambda i: F.array_join(F.slice(words, i, shingle), " "))
        return F.array_distinct(F.when(F.size(words) < shingle, F.array(F.array_join(words, " "))).otherwise(several))

    both = pairs.join(named("x"), ["x1", "x2"]).join(named("y"), ["y1", "y2"]).withColumns({side: runs(side) for side in "xy"})
    met = threshold.met(F.size(F.array_intersect("x", "y")), F.size("x") + F.size("y"))
    # The condition stands in an aggregate: as a filter it would move ahead of the runs, and make them anew.
    judged = both.groupBy(F.col("x1").alias("k1"), F.col("x2").alias("k2")).agg(F.bool_or(met).alias("met"))
    return judged.where("met").select(*KEY)


def shared_tokens(firsts: DataFrame, threshold: Threshold) -> DataFrame:
    """(token, size, pos, k1, k2, line, n, bits, parts) of each prefix token that stands in several lines."""
    each = firsts.select("k1", F.posexplode("prefix").alias("pos", "token"))
    of_token = Window.partitionBy("token").orderBy("k1", "pos")
    met = each.withColumns({"before": F.lag("k1").over(of_token), "after": F.lead("k1").over(of_token)})
    met = met.where("before IS NOT NULL OR after IS NOT NULL").drop("before", "after")
    # The first hash alone may be that of several lines: each is a candidate.
    sized = firsts.select(*KEY, F.struct(*LINE).alias("line"), "n", "bits", "parts", threshold.size_class(F.col("n")).alias("size"))
    return met.join(sized, "k1")


def pairs_at_hand(rows: DataFrame, threshold: Threshold) -> DataFrame:
    """A pair (x1, x2, y1, y2) for each line with a candidate among these: the first and the previous line in its part
    of a token's lines of a size class, and for each part's first line those of the parts that come first and before it.
    It is the candidate met most often.
    """
    member = F.struct("line", "n", "pos", "bits", "parts", *KEY)
    in_part = Window.partitionBy("token", "size", "part").orderBy("line", *KEY)
    parted = rows.withColumn("part", F.pmod(F.col("k1"), F.lit(PARTS)))
    met = parted.select(
        "token", "size", member.alias("x"), F.first(member).over(in_part).alias("first"), F.lag(member).over(in_part).alias("previous")
    )
    of_token = Window.partitionBy("token", "size").orderBy("x.line", "x.k1", "x.k2")
    heads = met.where("previous IS NULL").select(
        "x", F.first("x").over(of_token).alias("first"), F.lag("x").over(of_token).alias("previous")
    )
    near = met.select("x", "first", "previous").unionByName(heads)
    each = [possible_pairs(near.select("x", F.col(y).alias("y")), threshold) for y in ("first", "previous")]
    return best_pairs(each[0].unionByName(each[1]).groupBy("x1", "x2", "y1", "y2").count())


def best_pairs(counted: DataFrame) -> DataFrame:
    """Of each line x's pairs the one met most often."""
    best = counted.groupBy("x1", "x2").agg(F.max(F.struct("count", "y1", "y2")).alias("y"))
    return best.select("x1", "x2", "y.y1", "y.y2")


def possible_pairs(pairs: DataFrame, threshold: Threshold) -> DataFrame:
    x, y = F.col("x"), F.col("y")
    kept = pairs.where((y["line"] < x["line"]) & threshold.possible(x, y))
    return kept.select(x["k1"].alias("x1"), x["k2"].alias("x2"), y["k1"].alias("y1"), y["k2"].alias("y2"))


def repeated_lines(
    documents: DataFrame, similarity: float = 0.8, shingle: int = 5, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc_id, version, no) of every line to remove."""
    threshold = Threshold(similarity)
    sets = line_sets(worded_lines(documents, doc_id, text), shingle, threshold)
    # One line of each key, the first, meets others by its tokens; its copies go. Equal rows are one line.
    of_key = Window.partitionBy(*KEY).orderBy(*LINE)
    first, own = F.first(F.struct(*LINE)).over(of_key), F.struct(*LINE)
    told = sets.withColumns({"copy": ~own.eqNullSafe(first), "before": F.lag("k1").over(of_key)})
    told = told.where("copy OR before IS NULL").drop("before")
    # Of the copies, no tokens are of use.
    without = {c: F.when(~F.col("copy"), F.col(c)) for c in ("bits", "parts", "prefix")}
    all_lines = stored(told.withColumns(without), "lines")
    firsts = all_lines.where("NOT copy")
    rows = stored(shared_tokens(firsts, threshold), "line-tokens")

    def matched_of(pairs: DataFrame) -> DataFrame:
        bodies = bodies_of(pairs, firsts, documents, doc_id, text)
        found = stored(matches(pairs, bodies, shingle, threshold), "matched-lines")
        discard(bodies)
        return found

    near = stored(pairs_at_hand(rows, threshold), "line-pairs")
    matched = matched_of(near)
    # A line that does not match the one at hand is compared with every earlier line of its tokens.
    member = F.struct("line", "n", "pos", "bits", "parts", *KEY)
    sizes = F.explode(F.array(*[F.col("size") + k for k in (-1, 0, 1)])).alias("size")
    xs = rows.join(matched, KEY, "left_anti").select("token", sizes, member.alias("x"))
    ys = rows.select(F.col("token").alias("of"), F.col("size").alias("sized"), member.alias("y"))
    met = xs.join(
        ys,
        (F.col("token") == F.col("of")) & (F.col("size") == F.col("sized")) & (F.col("y.line") < F.col("x.line")) & threshold.possible(F.col("x"), F.col("y")),
    )
    counted = possible_pairs(met.select("x", "y"), threshold).groupBy("x1", "x2", "y1", "y2").count()
    pair = ["x1", "x2", "y1", "y2"]
    more = stored(counted.join(near, pair, "left_anti"), "more-line-pairs")
    discard(rows, near)
    # Of those, too, the one met most often goes first.
    best = stored(best_pairs(more), "best-line-pairs")
    others = matched_of(best)
    of_x = others.select(F.col("k1").alias("x1"), F.col("k2").alias("x2"))
    rest = stored(more.drop("count").join(of_x, ["x1", "x2"], "left_anti").join(best, pair, "left_anti"), "rest-of-line-pairs")
    discard(more, best)
    last = matched_of(rest)
    discard(rest)

    # Copies go whether or not their first does.
    gone = stored(matched.unionByName(others).unionByName(last).select(*KEY), "gone-lines")
    discard(matched, others, last)
    found = all_lines.where("copy").select(*LINE).unionByName(firsts.join(gone, KEY, "left_semi").select(*LINE))
    found = stored(found, "repeated-lines")
    discard(all_lines, gone)
    return found


def dedup_lines(
    documents: DataFrame, similarity: float = 0.8, shingle: int = 5, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Documents without the lines that match an earlier line; with n_lines and n_removed.

    Lines are parted by newlines; those without a word are never removed. A null text stays null and has
    no lines, an empty one has one. Rows with equal ids and texts are one document to the comparison:
    they stay and lose the same lines. Null ids come first in the order. Columns of the two names are
    replaced. An empty table gives an empty table.
    """
    gone = repeated_lines(documents, similarity, shingle, doc_id, text)
    version, lines, left = (free_name(documents, n) for n in ("version", "lines", "left"))
    of_id, of_version, nos = (free_name(documents, n) for n in ("gone_id", "gone_version", "gone_nos"))
    by_text = gone.groupBy(F.col("doc_id").alias(of_id), F.col("version").alias(of_version))
    by_text = stored(by_text.agg(F.collect_set("no").alias(nos)), "removed-lines")
    met = documents.withColumn(version, F.xxhash64(text)).join(
        by_text, F.col(doc_id).eqNullSafe(F.col(of_id)) & (F.col(version) == F.col(of_version)), "left"
    )
    split = met.withColumn(lines, F.split(F.col(text), "\n"))
    places = F.sequence(F.lit(0), F.size(lines) - 1)
    kept = F.transform(F.array_except(places, F.col(nos)), lambda i: F.get(F.col(lines), i))
    whole = F.when(F.col(nos).isNull(), F.col(text)).otherwise(F.array_join(kept, "\n"))
    return (
        split.withColumn(left, whole)
        .withColumn("n_lines", F.coalesce(F.size(lines), F.lit(0)).cast("long"))
        .withColumn("n_removed", F.coalesce(F.size(nos), F.lit(0)).cast("long"))
        .withColumn(text, F.col(left))
        .drop(version, lines, left, of_id, of_version, nos)
    )
