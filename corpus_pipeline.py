"""Documents to packed training sequences: rated, cleaned of repeated lines, near-duplicates and
benchmark passages, then packed. Each stage is written as Parquet and read again by the next.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trailmark.llm.common import stored, table
from trailmark.llm.contamination import find_contamination
from trailmark.llm.lines import dedup_lines
from trailmark.llm.packing import pack
from trailmark.llm.quality import learn_quality, rate_quality
from trailmark.llm.simhash import keep_one


def carried(docs: DataFrame) -> DataFrame:
    """doc_id, text, and all columns but the text in one, so that none clashes with an operator's."""
    return docs.select("doc_id", "text", F.struct(*[F.col(c) for c in docs.columns if c.lower() != "text"]).alias("carried"))


def restored(rows: DataFrame, columns: list[str]) -> DataFrame:
    return rows.select(*[F.col("text").alias(c) if c.lower() == "text" else F.col("carried").getField(c).alias(c) for c in columns])


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier selects, as they are. Null and empty texts go, if there are
    ratings to learn from; else all stay. Repeated rows stay or go alike.
    """
    rated = rate_quality(carried(docs), learn_quality(docs.select("doc_id", "text"), table(spark, sf_dir, "labels")))
    return restored(rated.where("selected"), docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that match an earlier one; n_chars, if there, follows the text. Null
    texts stay null; repeated rows stay and lose the same lines; null ids come first in the order.
    """
    cleaned = restored(dedup_lines(carried(docs)), docs.columns)
    lengths = {c: F.length("text").cast("long") for c in docs.columns if c.lower() == "n_chars"}
    return cleaned.withColumns(lengths) if lengths else cleaned


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, as it is: that of the least id. Texts without words
    are alike, null ones too; of rows that repeat an id, one stays.
    """
    return keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage, as they are. Null and empty texts hold none."""
    found = find_contamination(carried(docs), table(spark, sf_dir, "benchmark"))
    return restored(found.where(~F.col("contamination.contaminated")), docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents in sequences of at most 4,096 tokens; other columns are left out. A null
    or empty text is a piece of one token.
    """
    pieces = pack(docs, public_tokenizers.path("word_bpe_49k.json"))
    # Stored, as a stored step hands small batches to Python; without the ids it is small.
    return stored(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"), "pipeline-packing")


STAGES = [
    ("quality", quality),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: SQL expresses neither the classifier nor the packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
