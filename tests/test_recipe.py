"""The README recipe on CSV files laid out like the incident exports.

The files are derived from the test tables (lineitem as incidents); column
names keep the exports' spelling, including the trailing blank of ``AREA ``.
"""

from pyspark.sql import functions as F

from blotter.functions import DESCENT_CODES
from blotter.operators import (
    code_filter,
    distance_by_group,
    prefix_filter,
    rename_strict,
    require_not_null,
    trim_column_names,
    year_filter,
)
from blotter.plans.income_descent import clean_income, victims_by_descent, zip_status_counts
from blotter.plans.part_of_day import part_of_day_counts
from blotter.plans.standins import geo_lookup, income_raw, lat_of, lon_of, place_lon, table
from blotter.plans.top_months import top_months
from blotter.sources import read_csv
from tests.conftest import SF001

FMT = "MM/dd/yyyy hh:mm:ss a"
INCIDENTS = (
    "`DATE OCC` STRING, `TIME OCC` INT, `AREA ` INT, `AREA NAME` STRING, `Premis Cd` INT, "
    "`Weapon Used Cd` INT, `Vict Sex` STRING, `Vict Descent` STRING, LAT DOUBLE, LON DOUBLE"
)
STATIONS = "PREC INT, X DOUBLE, Y DOUBLE"
GEOCODING = "LAT DOUBLE, LON DOUBLE, ZIPcode STRING"
INCOME = "`Zip Code` STRING, `Estimated Median Income` STRING"


def _export(spark, root):
    li = table(spark, SF001, "lineitem")
    area = (F.col("l_suppkey") % 21 + 1).cast("int")
    crimes = li.select(
        F.date_format("l_shipdate", FMT).alias("DATE OCC"),
        ((F.col("l_linenumber") * 3 % 24) * 100 + F.col("l_orderkey") % 60).cast("int").alias("TIME OCC"),
        area.alias("AREA "),
        F.concat(F.lit("Division "), area).alias("AREA NAME"),
        (F.lit(101) + (F.col("l_partkey") % 3) * 100).cast("int").alias("Premis Cd"),
        F.when(F.col("l_linenumber") == 7, None).otherwise(F.col("l_quantity").cast("int")).alias("Weapon Used Cd"),
        F.when(F.col("l_returnflag") == "N", None).otherwise(F.col("l_returnflag")).alias("Vict Sex"),
        F.substring(F.lit("ABCDFGHIJKLOPSUVWXZ"), (F.col("l_orderkey") % 19 + 1).cast("int"), 1).alias("Vict Descent"),
        lat_of("l_suppkey").alias("LAT"),
        place_lon("l_suppkey").alias("LON"),
    )
    crimes.write.option("header", True).csv(f"{root}/crimes")
    spark.range(1, 22).select(F.col("id").cast("int").alias("PREC"), lat_of("id").alias("X"), lon_of("id").alias("Y")) \
        .write.option("header", True).csv(f"{root}/stations")
    geo_lookup(spark, SF001).select(F.col("lat").alias("LAT"), F.col("lon").alias("LON"), F.col("zip").alias("ZIPcode")) \
        .write.option("header", True).csv(f"{root}/geo")
    income_raw(spark, SF001).write.option("header", True).csv(f"{root}/income")


def test_recipe_runs_on_export_layout(spark, tmp_path):
    root = str(tmp_path)
    _export(spark, root)
    crimes = trim_column_names(read_csv(spark, f"{root}/crimes", schema=INCIDENTS))
    total = crimes.count()

    q1 = top_months(crimes, "DATE OCC", fmt=FMT).collect()
    assert q1 and all(r.ranking <= 3 for r in q1)

    q2 = part_of_day_counts(code_filter(crimes, "Premis Cd", "101"), "TIME OCC").collect()
    assert sum(r.n for r in q2) == crimes.filter(F.col("Premis Cd") == 101).count()

    year = int(q1[0].year)
    in_year = year_filter(crimes, "DATE OCC", year, FMT)
    facts = require_not_null(in_year, ["Vict Sex", "Vict Descent"]).select(
        F.col("LAT").alias("lat"), F.col("LON").alias("lon"), F.col("Vict Descent").alias("status"))
    geo = rename_strict(read_csv(spark, f"{root}/geo", schema=GEOCODING), {"LAT": "lat", "LON": "lon", "ZIPcode": "zip"})
    income = clean_income(read_csv(spark, f"{root}/income", schema=INCOME))
    counts = zip_status_counts(facts, geo, income)
    top = victims_by_descent(counts, 3, ascending=False, mapping=DESCENT_CODES).collect()
    bottom = victims_by_descent(counts, 3, ascending=True, mapping=DESCENT_CODES).collect()
    assert top and bottom
    assert {r.status for r in top} <= set(DESCENT_CODES.values())

    stations = rename_strict(read_csv(spark, f"{root}/stations", schema=STATIONS),
                             {"PREC": "AREA", "X": "STATION_LAT", "Y": "STATION_LON"})
    q4 = distance_by_group(prefix_filter(crimes, "Weapon Used Cd", "1"), stations, "AREA", "AREA NAME").collect()
    areas = prefix_filter(crimes, "Weapon Used Cd", "1").select("AREA").distinct().count()
    assert len(q4) == areas and all(r.average_distance > 0 for r in q4)
    assert sum(r.incidents_total for r in q4) == prefix_filter(crimes, "Weapon Used Cd", "1").count()
    assert total > 0
