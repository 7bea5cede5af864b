"""Each stage of the pipeline on rows out of the ordinary, and on columns named like the operators'."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from trailmark.llm.common import table

SF = "/root/testdata/sf0.001"
STAGES = dict(corpus_pipeline.STAGES)
CLASHING = ["selected", "expected_grade", "n_removed", "n_lines", "contamination", "carried", "fp", "component", "version", "found"]


@pytest.fixture(scope="module")
def odd(spark):
    given = table(spark, SF, "documents").where("doc_id < 25")
    long = " ".join(f"word{i % 977} of {i % 613}." for i in range(60_000))
    rows = [
        (None, "a line without an id\nand another", "en", "s", 7), (9_001, None, "en", "s", 0), (9_002, "", None, None, 0),
        (9_003, " \n\t\n", "en", "s", 4), (9_004, long, "en", "s", len(long)), (9_005, "said twice by one id", "en", "s", 20),
        (9_005, "said twice by one id", "en", "s", 20), (9_006, "x", "en", "s", None),
    ]
    frame = given.unionByName(spark.createDataFrame(rows, given.schema))
    return frame.withColumns({c: F.concat(F.lit(f"{c} of "), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))) for c in CLASHING}).cache()


def kept(frame):
    return sorted(((r.doc_id, r.text, r.lang, r.source, *(r[c] for c in CLASHING)) for r in frame.collect()), key=str)


@pytest.mark.parametrize("name", ["quality", "line_dedup", "near_duplicates", "decontamination"])
def test_a_stage_keeps_the_columns_of_its_documents(spark, odd, name):
    result = STAGES[name](spark, odd, SF)
    assert result.dtypes == odd.dtypes
    got, given = kept(result), kept(odd)
    assert all(r[k + 4] == f"{c} of {'none' if r[0] is None else r[0]}" for r in got for k, c in enumerate(CLASHING))
    ids = [r[0] for r in got]
    if name == "line_dedup":
        assert sorted(ids, key=str) == sorted((r[0] for r in given), key=str)
        texts = {r[0]: r[1] for r in got}
        assert texts[9_001] is None and texts[9_002] == "" and texts[9_003] == " \n\t\n" and ids.count(9_005) == 2
        assert all(r.n_chars == len(r.text) for r in result.where("text IS NOT NULL").collect())
    else:
        assert all(r in given for r in got)
    if name == "quality":
        assert not {9_001, 9_002, 9_003} & set(ids)
    if name == "near_duplicates":
        # Texts without words have fingerprint zero and are one group; of the repeated rows one stays.
        assert len({9_001, 9_002, 9_003} & set(ids)) <= 1 and ids.count(9_005) == 1 and {9_004, 9_006} <= set(ids)
    if name == "decontamination":
        assert {None, 9_001, 9_002, 9_003, 9_004} <= set(ids) and ids.count(9_005) == 2


@pytest.mark.parametrize("name", list(STAGES))
def test_a_stage_of_an_empty_table_is_empty(spark, odd, name):
    assert STAGES[name](spark, odd.limit(0), SF).count() == 0


def test_packing_of_odd_rows(spark, odd):
    pieces = STAGES["packing"](spark, odd, SF).collect()
    whole = {}
    for p in pieces:
        whole[p.doc_id] = whole.get(p.doc_id, 0) + p.length
    assert whole[9_001] == whole[9_002] == whole[9_003] == 1 and whole[9_004] > 4096
    assert sum(1 for p in pieces if p.doc_id == 9_005) >= 2 and None in whole
