from datetime import date, datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from trailmark.fixed_values import ACCOUNT_PREFIXES
from trailmark.functions import (
    civil_date,
    classify_prefix,
    epoch_to_civil,
    joined_key,
    kv_lookup,
    micros,
    round_to_long,
    safe_ratio,
    split_field,
    utc_date,
)

PAIRS = "id int, pairs array<struct<index: bigint, value: string>>"


def column(spark, values, kind, expression):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r[0] for r in frame.orderBy("i").select(expression(F.col("x"))).collect()]


def lookups(spark, rows, keys, strict=True):
    frame = spark.createDataFrame(list(enumerate(rows)), PAIRS)
    return [r[0] for r in frame.orderBy("id").select(kv_lookup(F.col("pairs"), keys, strict)).collect()]


def test_kv_lookup(spark):
    rows = [[(178, "a"), (1, "z")], [(1, "z")], [], None, [(178, None)]]
    assert lookups(spark, rows, [178]) == ["a", None, None, None, None]


def test_kv_lookup_falls_back_in_order(spark):
    rows = [[(178, "a"), (182, "b")], [(178, "a")], [(182, None), (178, "a")], []]
    assert lookups(spark, rows, [182, 178]) == ["b", "a", "a", None]


def test_kv_lookup_repeated_key(spark):
    rows = [[(178, "a"), (178, "b")]]
    with pytest.raises(PySparkException, match="index 178 occurs more than once"):
        lookups(spark, rows, [178])
    assert lookups(spark, rows, [178], strict=False) == ["a"]
    assert lookups(spark, [[(5, "x"), (5, "y"), (178, "a")]], [178]) == ["a"]


def test_classify_prefix(spark):
    names = ["lpd_tw_lan_a", "lpdXtwYbio", "lpd_tw_kiosk", "LPD_TW_LAN", "x lpd_tw_lan", None, "lpd_tw_gio"]
    found = column(spark, names, "string", lambda x: classify_prefix(x, ACCOUNT_PREFIXES))
    assert found == ["01", "07", "45", None, None, None, "16"]


def test_split_field(spark):
    assert column(spark, ["a_b_c"], "string", lambda x: split_field(x, "_", 1)) == ["b"]
    assert column(spark, ["a", "a_b"], "string", lambda x: split_field(x, "_", 1, strict=False)) == [None, "b"]
    assert column(spark, ["a.b"], "string", lambda x: split_field(x, ".", 1)) == ["b"]
    with pytest.raises(PySparkException):
        column(spark, ["a"], "string", lambda x: split_field(x, "_", 1))


def test_joined_key_is_null_with_a_null_part(spark):
    assert column(spark, ["a", None], "string", lambda x: joined_key(F.lit("s"), x, F.lit(1))) == ["s-a-1", None]


def test_round_to_long_rounds_halves_away_from_zero(spark):
    values = [2.7, 0.5, 2.5, -2.5, -0.4, None]
    assert column(spark, values, "double", round_to_long) == [3, 1, 3, -3, 0, None]


def test_ratios_are_rounded_plainly(spark):
    below_a_tie = spark.createDataFrame([(2.4999999999, 1.0), (2.5, 1.0), (-2.5, 1.0), (90000000.5, 1.0)], "a double, b double")
    found = [r[0] for r in below_a_tie.select(safe_ratio(F.col("a"), F.col("b"), 0)).collect()]
    assert found == [2.0, 3.0, -3.0, 90000001.0]


def test_safe_ratio(spark):
    frame = spark.createDataFrame([(1, 8), (1, 0), (1, None), (None, 2)], "a bigint, b bigint")
    found = [r[0] for r in frame.select(safe_ratio(F.col("a"), F.col("b"), 2)).collect()]
    assert found == [0.13, None, None, None]


def test_micros(spark):
    assert column(spark, [1500000], "bigint", micros) == [1.5]


@pytest.fixture(params=["UTC", "America/New_York", "Asia/Taipei"])
def zone(spark, request):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", request.param)
    yield request.param
    spark.conf.set("spark.sql.session.timeZone", before)


def test_epoch_to_civil_in_any_session_zone(spark, zone):
    # 15:59:59 and 16:00:00 UTC are before and after midnight at +8.
    seconds = [1704124799, 1704124800, None]
    civil = column(spark, seconds, "bigint", lambda x: epoch_to_civil(x, "s", 8))
    assert civil == [datetime(2024, 1, 1, 23, 59, 59), datetime(2024, 1, 2), None]
    days = column(spark, seconds, "bigint", lambda x: civil_date(epoch_to_civil(x, "s", 8)))
    assert days == [date(2024, 1, 1), date(2024, 1, 2), None]
    millis = column(spark, [1704124800123], "bigint", lambda x: epoch_to_civil(x, "ms", 8))
    assert millis == [datetime(2024, 1, 2, 0, 0, 0, 123000)]


def test_utc_date_in_any_session_zone(spark, zone):
    # 23:30 UTC is already the next day at +8.
    days = column(spark, [1704151800, -1, None], "bigint", lambda x: utc_date(F.timestamp_seconds(x)))
    assert days == [date(2024, 1, 1), date(1969, 12, 31), None]


def test_civil_date_of_text(spark):
    assert column(spark, ["2024-01-05", None], "string", civil_date) == [date(2024, 1, 5), None]
    with pytest.raises(PySparkException):
        column(spark, ["soon"], "string", civil_date)
