"""The registered queries against their SQL, or against plain versions."""

import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest

import __spark_entry__ as driver
import corpus_pipeline
from tests.compare import TABLES
from trailmark.llm.common import table
from trailmark.llm.oracles import LLM_ORACLES
from trailmark.llm.queries import LLM_QUERIES

from tests.llm import brute

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts():
    return dict(duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall())


def test_all_are_registered():
    assert {n.split("_")[0] for n in LLM_QUERIES} == {f"op{n}" for n in range(1, 14)}
    assert set(LLM_QUERIES) | {"pipeline"} <= set(driver.queries()) and set(LLM_ORACLES) <= set(driver.oracle_sql())


@pytest.mark.parametrize("name", sorted(LLM_ORACLES))
def test_query_equals_its_sql(spark, name):
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    frame, oracle = LLM_QUERIES[name](spark, SF), connection.sql(LLM_ORACLES[name])
    columns = sorted(frame.columns)
    assert columns == sorted(oracle.columns)
    got = sorted(tuple(r) for r in frame.select(*columns).collect())
    assert got == sorted(oracle.project(", ".join(columns)).fetchall()) and got


def test_token_counts(spark, texts):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    for r in LLM_QUERIES["op4_token_counts"](spark, SF).collect():
        n = len(model.encode(texts[r.doc_id]))
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(texts[r.doc_id].encode()), n, n > 4096)


def test_simhash(spark, texts):
    prints = {i: brute.fingerprint(t) for i, t in texts.items()}
    groups = brute.components(prints)
    for r in LLM_QUERIES["op5_simhash"](spark, SF).collect():
        assert (r.fingerprint, r.component_id) == (f"{prints[r.doc_id]:016x}", groups[r.doc_id])


def check_pieces(pieces, texts):
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = {i: np.array(model.encode(t or "", add_special_tokens=False).ids + [2], "<u4") for i, t in texts.items()}
    size, next_start = {}, dict.fromkeys(ids, 0)
    for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)):
        assert size.setdefault(p.sequence_id, 0) == p.offset
        size[p.sequence_id] += p.length
        whole = ids[p.doc_id]
        assert p.doc_tokens == len(whole) and next_start[p.doc_id] == p.start
        next_start[p.doc_id] += p.length
        assert p.ids_crc32 == zlib.crc32(whole[p.start : p.start + p.length].tobytes())
    assert next_start == {i: len(x) for i, x in ids.items()} and max(size.values()) <= 4096
    sizes = np.array(list(size.values()))
    assert np.where(sizes & (sizes - 1), 4096 - sizes, 0).sum() < 0.02 * sizes.sum()


def test_packing(spark, texts):
    check_pieces(LLM_QUERIES["op6_packing"](spark, SF).collect(), texts)


def test_quality_rules(spark, texts):
    for r in LLM_QUERIES["op10_quality_rules"](spark, SF).collect():
        found = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
        assert found == brute.base_rules(texts[r.doc_id]) and not (r.kept and r.base_failed)


def test_each_pipeline_stage_on_what_its_predecessor_kept(spark, tmp_path):
    docs = table(spark, SF, "documents")
    names = docs.columns
    labels = dict(duckdb.sql(f"SELECT doc_id, quality FROM '{SF}/labels.parquet'").fetchall())
    items = duckdb.sql(f"SELECT item_id, text FROM '{SF}/benchmark.parquet'").fetchall()
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r.text for r in docs.collect()}
        result = stage(spark, docs, SF)
        if name == "packing":
            check_pieces(result.collect(), before)
            break
        assert result.columns == names
        result.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        after = {r.doc_id: r.text for r in docs.collect()}
        if name == "quality":
            good = [i in after for i, q in labels.items() if q == 1]
            bad = [i in after for i, q in labels.items() if q == 0]
            assert sum(good) > 0.97 * len(good) and sum(bad) < 0.2 * len(bad)
            assert all(after[i] == before[i] for i in after)
        elif name == "line_dedup":
            gone = brute.repeated_lines(sorted(before.items()))
            assert gone and after == {
                i: "\n".join(l for n, l in enumerate(t.split("\n")) if (i, n) not in gone) for i, t in before.items()
            }
            assert all(r.n_chars == len(r.text) for r in docs.collect())
        elif name == "near_duplicates":
            groups = brute.components({i: brute.fingerprint(t) for i, t in before.items()})
            assert after == {i: t for i, t in before.items() if groups[i] == i}
        else:
            assert name == "decontamination"
            counts = {i: brute.contamination(t, items) for i, t in before.items()}
            assert after == {i: t for i, t in before.items() if not (0 < counts[i][1] and 20 * counts[i][1] >= counts[i][0])}
            assert len(after) < len(before)
    assert corpus_pipeline.run(spark, SF).count() > 0
