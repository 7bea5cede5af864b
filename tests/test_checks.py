from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tests.helpers import plan
from tests.test_reports import beacons
from trailmark.operators import checks
from trailmark.operators.checks import (
    accepted_values,
    expression_is_true,
    not_null,
    run_checks,
    unique,
    value_lengths_to_equal,
)
from trailmark.plans.beacon import beacon_checks


def failures(rows, checks):
    return {(r.check, r.column): r.failures for r in run_checks(rows, checks).collect()}


def faults(spark, *rows):
    found = failures(beacons(spark, *rows), beacon_checks())
    assert len(found) == 7
    return {(check, column.split("-")[0]): n for (check, column), n in found.items() if n}


def test_clean_rows_pass(spark):
    assert faults(spark, {}, {"event_time": datetime(2024, 1, 2)}) == {}


@pytest.mark.parametrize(
    ("fault", "expected"),
    [
        ({"event_name": None}, {("not_null", "event_name"): 1}),
        ({"receiver_uid": None}, {("not_null", "receiver_uid"): 1}),
        ({"receiver_uid": "U" * 32}, {("value_lengths_to_equal", "receiver_uid"): 1}),
        ({"receiver_uid": "字" * 33}, {}),
        ({"event_type": "leave"}, {("accepted_values", "event_type"): 1}),
        ({"event_type": None}, {}),
        ({"brand_id": "02"}, {("accepted_values", "brand_id"): 1}),
        ({"brand_id": None}, {("not_null", "brand_id"): 1}),
    ],
)
def test_each_fault_is_found(spark, fault, expected):
    assert faults(spark, {"event_time": datetime(2024, 1, 2)}, fault) == expected


def test_repeated_keys_count_once_each(spark):
    later = {"event_time": datetime(2024, 1, 2)}
    assert faults(spark, {}, {}, {}, later, later) == {("unique", "event_name"): 2}
    missing = {"event_name": None}
    assert ("unique", "event_name") not in faults(spark, missing, missing)


def test_row_condition_and_groups(spark):
    rows = beacons(spark, {"brand_id": "07", "receiver_uid": "short"}, {"receiver_uid": "short"}, {})
    assert failures(rows, [value_lengths_to_equal("receiver_uid", 33, F.col("brand_id") == "07")]) == {
        ("value_lengths_to_equal", "receiver_uid"): 1
    }
    lone = expression_is_true(F.count("*") >= 2, "size", group_by=["brand_id"])
    assert failures(rows, [lone]) == {("expression_is_true", "size"): 1}
    future = expression_is_true(F.col("event_start_at") <= F.lit(date(2023, 1, 1)), "start", where=F.col("brand_id") == "01")
    assert failures(rows, [future]) == {("expression_is_true", "start"): 2}


def test_an_empty_table_passes(spark):
    assert set(failures(beacons(spark, {}).where("false"), beacon_checks()).values()) == {0}


def test_row_checks_share_one_pass(spark, tmp_path):
    path = str(tmp_path / "beacon")
    beacons(spark, {}).write.parquet(path)
    checks = [not_null("event_name"), not_null("brand_id"), accepted_values("event_type", ["enter"])]
    text = plan(run_checks(spark.read.parquet(path), checks))
    assert text.count("FileScan") == 1
    assert plan(run_checks(spark.read.parquet(path), [*checks, unique(F.col("event_name"), "n")])).count("FileScan") == 2


def test_unique_verifies_hashes_that_clash(spark, monkeypatch):
    rows = spark.createDataFrame([("a",), ("b",), ("b",), ("c",), (None,), (None,), ("d",), ("d",), ("d",)], "k string")
    check = checks.unique(F.col("k"), "k", by_hash=True)
    assert check.failures(rows).first()[0] == 2
    for hashes in ([F.lit(5).cast("bigint")] * 2, [F.lit(-1).cast("bigint"), F.length("_key").cast("bigint")]):
        monkeypatch.setattr(checks, "key_hashes", lambda key, hashes=hashes: hashes)
        assert check.failures(rows).first()[0] == 2
    assert check.failures(rows.limit(0)).first()[0] == 0


def test_unique_shuffles_text_of_suspects_only(spark):
    rows = spark.range(20_000).select(F.concat(F.lit("key "), F.col("id").cast("string")).alias("_key"))
    assert checks.suspects(rows).count() == 0
    twice = rows.union(rows.where("_key LIKE '%77'"))
    repeated = checks.suspects(twice)
    # Each of the 200 repeated keys twice, and the few that share a bit with one.
    assert 400 <= repeated.count() < 420
    assert repeated.groupBy("_key").count().where("count > 1").count() == 200
