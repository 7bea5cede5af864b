"""The registered queries of the operators, over their whole tables, and their digest columns."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trailmark.llm.common import held_out, table
from trailmark.llm.contamination import find_contamination
from trailmark.llm.language import identify_language, learn_languages
from trailmark.llm.lines import dedup_lines
from trailmark.llm.packing import pack
from trailmark.llm.passages import remove_passages
from trailmark.llm.phrases import collocations
from trailmark.llm.quality import learn_quality, rate_quality
from trailmark.llm.rules import judge
from trailmark.llm.secret_scan import scan_secrets
from trailmark.llm.simhash import near_duplicates
from trailmark.llm.tokens import count_tokens
from trailmark.llm.toxicity import learn_toxicity, score_toxicity
from trailmark.llm.trie import forked, prefix_trie, turn_keys


def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    found = identify_language(documents.select("doc_id", "text"), learn_languages(documents))
    return found.select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score")


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    rated = rate_quality(documents, learn_quality(documents, table(spark, sf_dir, "labels")))
    return rated.select("doc_id", "expected_grade", "tail_probability", "selected")


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        F.col("word_no").cast("long").alias("word_no"),
        F.col("part_no").cast("long").alias("part_no"),
        F.sha2(F.col("value").cast("binary"), 256).alias("value_sha256"),
        F.length("value").cast("long").alias("length"),
        "probability",
        "is_secret",
    )


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = count_tokens(documents, public_tokenizers.path("piece_bpe_32k.model"))
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit")


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    fingerprint = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return found.select("doc_id", fingerprint.alias("fingerprint"), "component_id")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cleaned.select("doc_id", "n_lines", "n_removed", "text")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = score_toxicity(documents, learn_toxicity(documents, table(spark, sf_dir, "labels")))
    score = F.col("toxicity.score")
    return found.select(
        "doc_id",
        held_out("doc_id").alias("held_out"),
        score.alias("score"),
        (score >= 0.3).cast("int").alias("predicted"),
        F.col("toxicity.spans").alias("spans"),
    )


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_contamination(documents, table(spark, sf_dir, "benchmark"))
    items = F.col("contamination.items")
    return found.select(
        "doc_id",
        "contamination.n_words",
        "contamination.n_hit",
        F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ",").cast("binary"), 256).alias("items_sha256"),
        "contamination.contaminated",
    )


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge(table(spark, sf_dir, "documents"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "posterior"
    )


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    conv = F.col("conv")
    kept = F.crc32(conv.cast("string").cast("binary")) % 9
    keys = forked(turn_keys(conversations), kept, base=conv - conv % 5, most=8)
    return prefix_trie(keys, conversations.select(F.col("conv_id").alias("conv")).dropna().distinct())


def op12_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_passages(table(spark, sf_dir, "documents").select("doc_id", "text"))
    removed = F.col("passages.removed")
    total = F.aggregate(removed, F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["begin"])
    return found.select(
        "doc_id",
        F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"),
        total.alias("n_removed"),
        F.size(removed).cast("long").alias("n_spans"),
        F.sha2("passages.kept", 256).alias("kept_sha256"),
    )


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_language,
        op2_quality,
        op3_secrets,
        op4_token_counts,
        op5_simhash,
        op6_packing,
        op7_line_dedup,
        op8_toxicity,
        op9_decontamination,
        op10_quality_rules,
        op11_conversation_trie,
        op12_passages,
        op13_phrases,
    )
}
