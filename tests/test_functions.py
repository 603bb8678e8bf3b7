"""Column functions on the toy rows of FIXTURES.md part B."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from blotter.functions import (
    DESCENT_CODES,
    decode,
    haversine_km,
    hour_of_hhmm,
    parse_currency,
    parse_ts,
    part_of_day,
    split_field,
)
from tests.conftest import formatted_plan


def test_parse_ts_malformed_is_null(spark):
    df = spark.createDataFrame([("03/01/2010 12:00:00 AM",), ("garbage",), (None,)], "d string")
    got = [r[0] for r in df.select(parse_ts("d")).collect()]
    assert got[0] == dt.datetime(2010, 3, 1, 0, 0)
    assert got[1] is None and got[2] is None


def test_parse_ts_pm(spark):
    df = spark.createDataFrame([("12/31/2019 11:45:00 PM",)], "d string")
    row = df.select(F.year(parse_ts("d")), F.month(parse_ts("d")), F.hour(parse_ts("d"))).first()
    assert tuple(row) == (2019, 12, 23)


HHMM = [15, 2015, None, 20150, 459, 500, 1159, 1200, 1659, 1700, 2059, 2100]


def test_hour_of_hhmm_padding_and_truncation(spark):
    df = spark.createDataFrame([(v,) for v in HHMM], "t int")
    lpad = [r[0] for r in df.select(hour_of_hhmm("t")).collect()]
    zfill = [r[0] for r in df.select(hour_of_hhmm("t", pad="zfill")).collect()]
    assert lpad == [0, 20, None, 20, 4, 5, 11, 12, 16, 17, 20, 21]
    # zfill never truncates; for 20150 the first two digits are the same
    assert zfill == lpad


def test_hour_of_hhmm_text_input(spark):
    # Padding happens before reading the hour, as in both original forms:
    # 'xx' -> '00xx' -> hour 0; only a non-numeric first pair is unreadable.
    df = spark.createDataFrame([("0915",), ("xx",), ("7",), ("",), ("abcde",)], "t string")
    assert [r[0] for r in df.select(hour_of_hhmm("t")).collect()] == [9, 0, 0, 0, None]


def test_part_of_day_bucket_edges(spark):
    df = spark.createDataFrame([(v,) for v in HHMM], "t int")
    got = [r[0] for r in df.select(part_of_day(hour_of_hhmm("t"))).collect()]
    assert got == [
        "Night", "Evening", "Night", "Evening", "Night", "Morning",
        "Morning", "Afternoon", "Afternoon", "Evening", "Evening", "Night",
    ]
    nulls = [r[0] for r in df.select(part_of_day(hour_of_hhmm("t"), "null")).collect()]
    assert nulls[2] is None and nulls[0] == "Night"


def test_part_of_day_rejects_unknown_mode():
    with pytest.raises(ValueError):
        part_of_day("h", "ignore")


def test_parse_currency(spark):
    df = spark.createDataFrame([("$30,001",), ("$20,000",), ("n/a",), (None,), ("$1,234,567",)], "s string")
    assert [r[0] for r in df.select(parse_currency("s")).collect()] == [30001, 20000, None, None, 1234567]


def test_decode_passes_unknown_and_null(spark):
    df = spark.createDataFrame([("H",), ("Q",), (None,), ("W",)], "c string")
    got = [r[0] for r in df.select(decode("c", DESCENT_CODES)).collect()]
    assert got == ["Hispanic/Latin/Mexican", "Q", None, "White"]
    assert len(DESCENT_CODES) == 19


def test_split_field_short_line_is_null(spark):
    df = spark.createDataFrame([("a,b,c",), ("a",)], "value string")
    assert [r[0] for r in df.select(split_field("value", ",", 2)).collect()] == ["c", None]


def test_haversine_known_distance(spark):
    df = spark.createDataFrame([(34.05, -118.24, 34.04, -118.25)], "a double, b double, c double, d double")
    d = df.select(haversine_km("a", "b", "c", "d")).first()[0]
    assert abs(d - 1.444068) < 1e-6


def test_haversine_identity_antipodes_null(spark):
    schema = StructType([StructField(n, StringType()) for n in "abcd"])
    rows = [("10.0", "20.0", "10.0", "20.0"), ("0.0", "0.0", "0.0", "180.0"), (None, "1.0", "2.0", "3.0")]
    df = spark.createDataFrame(rows, schema).select(*[F.col(c).cast("double").alias(c) for c in "abcd"])
    got = [r[0] for r in df.select(haversine_km("a", "b", "c", "d")).collect()]
    assert got[0] == 0.0
    assert math.isfinite(got[1]) and abs(got[1] - math.pi * 6371.0) < 1e-6
    assert got[2] is None


def test_functions_stay_native(spark):
    """No Python evaluation node in a plan that uses every function."""
    df = spark.createDataFrame([("1", 2015, "$1", 1.0, 2.0)], "c string, t int, m string, x double, y double")
    out = df.select(
        decode("c", DESCENT_CODES), part_of_day(hour_of_hhmm("t")), parse_currency("m"),
        haversine_km("x", "y", "y", "x"), parse_ts("c"),
    )
    text = formatted_plan(out)
    assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text


def test_zfill_matches_python(spark):
    values = ["-15", "+5", "15", "2015", "20150", "", "-", "abc", "7", "-0930"]

    def expected(v):
        try:
            return int(v.zfill(4)[:2])
        except ValueError:
            return None

    df = spark.createDataFrame([(v,) for v in values], "t string")
    got = [r[0] for r in df.select(hour_of_hhmm("t", pad="zfill")).collect()]
    assert got == [expected(v) for v in values]
