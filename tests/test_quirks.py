
import warnings

from blotter.functions import haversine_km, hour_of_hhmm, part_of_day
from blotter.operators import (
    geo_enrich,
    join_with_strategy,
    prefix_filter,
    rename_strict,
    semi_join_keys,
    top_k_groups,
    year_filter,
)
from blotter.plans.income_descent import clean_income


def test_q1_prefix_on_hhmm_selects_a_time_not_a_year(spark):
    df = spark.createDataFrame([(2015, "01/02/2015 10:00:00 AM"), (1530, "03/04/2015 03:30:00 PM"), (20151, "05/06/2014 08:15:00 PM")], "t int, d string")
    assert sorted(r.t for r in prefix_filter(df, "t", "2015").collect()) == [2015, 20151]
    assert sorted(r.t for r in year_filter(df, "d", 2015, "MM/dd/yyyy hh:mm:ss a").collect()) == [1530, 2015]


def test_q2_q3_top_without_limit_and_nulls_first(spark):
    zips = spark.createDataFrame([("a", 9), ("b", None), (None, None), ("c", 1)], "zip string, income int")
    assert top_k_groups(zips, "zip", "income", None, nulls="last").count() == 4
    chosen = top_k_groups(zips, "zip", "income", 3, ascending=True, nulls="first")
    assert [r.zip for r in chosen.collect()] == [None, "b", "c"]
    facts = spark.createDataFrame([("a",), ("b",), (None,), ("c",)], "zip string")
    # the NULL-ZIP slot matches nothing in the following join
    assert sorted(r.zip for r in semi_join_keys(facts, chosen, "zip").collect()) == ["b", "c"]


def test_q4_station_coordinates_are_named_not_guessed(spark):
    st = spark.createDataFrame([(1, 34.04, -118.25)], "PREC int, X double, Y double")
    named = rename_strict(st, {"PREC": "AREA", "X": "STATION_LAT", "Y": "STATION_LON"})
    inc = spark.createDataFrame([(1, 34.05, -118.24)], "AREA int, LAT double, LON double")
    j = inc.join(named, "AREA")
    right = j.select(haversine_km("LAT", "LON", "STATION_LAT", "STATION_LON")).first()[0]
    swapped = j.select(haversine_km("LAT", "LON", "STATION_LON", "STATION_LAT")).first()[0]
    assert abs(right - 1.444068) < 1e-6 and swapped > 10000


def test_q5_unknown_hour_night_or_dropped(spark):
    df = spark.createDataFrame([(None,), (930,)], "t int")
    assert [r[0] for r in df.select(part_of_day(hour_of_hhmm("t"))).collect()] == ["Night", "Morning"]
    assert [r[0] for r in df.select(part_of_day(hour_of_hhmm("t"), "null")).collect()] == [None, "Morning"]


def test_q6_null_keys_never_match_under_any_strategy(spark):
    left = spark.createDataFrame([(None, "l")], "k int, v string")
    right = spark.createDataFrame([(None, "r")], "k int, w string")
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        for strategy in (None, "broadcast", "merge", "shuffle_hash", "shuffle_replicate_nl"):
            assert join_with_strategy(left, right, "k", "inner", strategy).count() == 0


def test_q7_q8_income_cleaned_before_join(spark):
    raw = spark.createDataFrame([("90001", "$30,001"), ("90002", "n/a"), (None, "$1")], "`Zip Code` string, `Estimated Median Income` string")
    clean = clean_income(raw)
    assert dict(clean.dtypes) == {"zip": "string", "income": "int"}
    assert sorted(map(tuple, clean.collect()), key=repr) == [("90001", 30001), ("90002", None)]


def test_q11_exact_or_rounded_coordinates(spark):
    facts = spark.createDataFrame([(34.05, -118.24), (34.0500000001, -118.24)], "lat double, lon double")
    geo = spark.createDataFrame([(34.05, -118.24, "90001")], "lat double, lon double, zip string")
    exact = [r.zip for r in geo_enrich(facts, geo).orderBy("lat").collect()]
    rounded = geo_enrich(facts, geo, digits=6)
    assert exact == ["90001", None]
    assert [r.zip for r in rounded.collect()] == ["90001", "90001"]
    assert rounded.columns == ["lat", "lon", "zip"]
    assert sorted(r.lat for r in rounded.collect()) == [34.05, 34.0500000001]


def test_q13_one_schema_for_all_files(spark, tmp_path):
    from blotter.sources import read_csv

    (tmp_path / "a.csv").write_text("id,code\n1,101\n")
    (tmp_path / "b.csv").write_text("id,code\n2,A7\n")
    df = read_csv(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")], schema="id bigint, code string")
    assert sorted(map(tuple, df.collect())) == [(1, "101"), (2, "A7")]


def test_j2_using_key_resolves_case_insensitively(spark):
    facts = spark.createDataFrame([("90001", "F")], "ZIPcode string, status string")
    income = spark.createDataFrame([("90001", 30001)], "ZIPcode string, income int")
    out = join_with_strategy(facts, income, "ZIPCode", "left")
    assert out.columns[0] == "ZIPcode" and out.first().income == 30001
