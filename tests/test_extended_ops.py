"""Tolerance, as-of, interval and heavy-key joins, running totals, quarantine,
typed codes and broadcast estimates, against brute force."""

import math
import os
import random
import subprocess
import sys
import threading

import pytest
from pyspark.sql import functions as F

from blotter.functions.geo import EARTH_RADIUS_KM
from blotter.operators import temporal
from blotter.operators.filters import code_filter
from blotter.operators.heavy import heavy_keys, join_heavy
from blotter.operators.joins import broadcast_fits, estimated_bytes
from blotter.operators.nearby import LIST_POINTS, geo_near
from blotter.operators.sketches import answered, rolled_up, sketched
from blotter.operators.temporal import asof_join, interval_join, running_total
from blotter.sources.quarantine import quarantine, read_csv_ledger
from tests.conftest import ROOT, SF01, final_plan


def km(a, b):
    p, q = math.radians(a[0]), math.radians(b[0])
    h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(b[1] - a[1]) / 2) ** 2
    return 2 * EARTH_RADIUS_KM * math.asin(math.sqrt(min(1.0, h)))


@pytest.mark.parametrize("tolerance", [0.5, 40.0, 900.0])
@pytest.mark.parametrize("where", ["city", "date line", "pole", "globe"])
def test_nearest_within_tolerance(spark, where, tolerance):
    rnd = random.Random(f"{where}{tolerance}")
    spot = {"city": (34.0, -118.2), "date line": (-17.0, 179.999), "pole": (89.9, 10.0), "globe": (0.0, 0.0)}[where]
    reach = math.degrees(tolerance / EARTH_RADIUS_KM)

    def point():
        if where == "globe":
            return rnd.uniform(-90, 90), rnd.uniform(-180, 180)
        lat = max(-90.0, min(90.0, spot[0] + rnd.uniform(-4, 4) * reach))
        lon = rnd.uniform(-180, 180) if where == "pole" else spot[1] + rnd.uniform(-4, 4) * reach
        return lat, (lon + 180) % 360 - 180

    places, seen = [point() for _ in range(120)], [point() for _ in range(150)]
    seen += [places[0], places[1], (min(90.0, places[2][0] + reach * 0.999), places[2][1])]  # exact hits, near the edge
    facts = spark.createDataFrame([(k, *p) for k, p in enumerate(seen)] + [(-1, None, 1.0), (-2, 1.0, None)], "id long, lat double, lon double")
    geo = spark.createDataFrame([(*p, f"z{k}") for k, p in enumerate(places)] + [(None, 0.0, "no")], "lat double, lon double, zip string")
    got = {r.id: (r.zip, r.distance_km) for r in geo_near(facts, geo, tolerance).collect()}
    assert len(got) == len(seen) + 2 and got[-1] == got[-2] == (None, None)
    for k, p in enumerate(seen):
        d, z = min((km(p, q), f"z{n}") for n, q in enumerate(places))
        if d <= tolerance * (1 - 1e-9):
            assert math.isclose(got[k][1], d, rel_tol=1e-9, abs_tol=1e-6)
            # at a pole all longitudes are one point: any place as near will do
            assert got[k][0] == z or math.isclose(km(p, places[int(got[k][0][1:])]), d, rel_tol=1e-9, abs_tol=1e-6)
        elif d > tolerance * (1 + 1e-9):
            assert got[k] == (None, None)


def test_points_on_cell_edges_meet(spark):
    """Two points a millimetre apart on both sides of any rounding edge."""
    facts = spark.range(400).select("id", (F.lit(33.7) + F.col("id") / 1000).alias("lat"), (F.lit(-118.0) + F.col("id") / 1000).alias("lon"))
    geo = facts.select((F.col("lat") - 1e-8).alias("lat"), (F.col("lon") + 1e-8).alias("lon"), F.col("id").cast("string").alias("zip"))
    met = geo_near(facts, geo, 0.001)
    assert met.filter(F.col("zip") == F.col("id").cast("string")).count() == 400
    plan = final_plan(met)
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def joined_rows(plan, on):
    """Rows that came out of the joins on column ``on`` in an executed plan."""
    kind = plan.getClass().getSimpleName()
    if kind == "AdaptiveSparkPlanExec":
        return joined_rows(plan.executedPlan(), on)
    if kind.endswith("QueryStageExec"):
        return joined_rows(plan.plan(), on)
    children = [plan.children().apply(k) for k in range(plan.children().size())]
    own = "Join" in kind and plan.leftKeys().toString().startswith(f"List({on}#")
    return sum(joined_rows(c, on) for c in children) + (plan.metrics().apply("numOutputRows").value() if own else 0)


def test_a_point_meets_lists_of_a_crowded_cell(spark):
    """200 points and 150 lookup points within a metre of each other, some at
    one place: no row per pair comes out of the join, the nearest is exact."""
    rnd = random.Random(11)
    places = [(33.70003 + rnd.uniform(0, 5e-6), -118.0 + rnd.uniform(0, 5e-6)) for _ in range(100)]
    places += places[:50]
    seen = [(33.70003 + rnd.uniform(0, 5e-6), -118.0 + rnd.uniform(0, 5e-6)) for _ in range(200)] + places[:3]
    facts = spark.createDataFrame([(k, *p) for k, p in enumerate(seen)], "id long, lat double, lon double")
    geo = spark.createDataFrame([(*p, f"z{999 - k}") for k, p in enumerate(places)], "lat double, lon double, zip string")
    met = geo_near(facts, geo, 0.01)
    got = {r.id: (r.zip, r.distance_km) for r in met.collect()}
    for k, p in enumerate(seen):
        d = min(km(p, q) for q in places)
        assert math.isclose(got[k][1], d, rel_tol=1e-6, abs_tol=1e-9)
        near = 999 - int(got[k][0][1:])
        assert math.isclose(km(p, places[near]), d, rel_tol=1e-6, abs_tol=1e-9)
        assert near >= 50  # of two zips at one place the smaller
    lists = -(-len(places) // LIST_POINTS)
    assert 0 < joined_rows(met._jdf.queryExecution().executedPlan(), "_band") <= len(seen) * lists


def test_copies_beyond_the_bound_are_not_broadcast(spark):
    """The lookup's estimate is below Spark's threshold, its nine copies are not."""
    geo = spark.range(60_000).select(
        (F.lit(33.7) + F.col("id") / 10_000).alias("lat"), F.lit(-118.0).alias("lon"), F.col("id").cast("string").alias("zip"))
    facts = geo.filter(F.col("zip") < "2").select(F.col("zip").alias("id"), "lat", "lon")
    met = geo_near(facts, geo, 0.001)
    plan = final_plan(met)
    assert "SortMergeJoin [_band" in plan
    assert met.filter(F.col("id") == F.col("zip")).count() == facts.count()


def test_asof_join_against_brute_force(spark):
    rnd = random.Random(5)
    lefts = [(k, rnd.choice([None, 1, 1, 1, 2, 3]), rnd.choice([None, *[rnd.randrange(300)] * 9])) for k in range(400)]
    rights = [(rnd.choice([None, 1, 1, 2, 4]), rnd.choice([None, *[rnd.randrange(300)] * 9]), rnd.randrange(5), "v") for _ in range(300)]
    left = spark.createDataFrame(lefts, "k long, id long, t long")
    right = spark.createDataFrame(rights, "id long, t long, a long, b string")
    for width in (1.0, 17.0, 10_000.0):
        got = {r.k: (r.asof_t, r.a, r.b) for r in asof_join(left, right, "t", ["id"], ["a", "b"], width).collect()}
        assert len(got) == len(lefts)
        for k, i, t in lefts:
            found = [(rt, a, b) for ri, rt, a, b in rights if i is not None and t is not None and ri == i and rt is not None and rt <= t]
            assert got[k] == max(found, default=(None, None, None))


def test_asof_of_a_hot_key_is_spread(spark):
    """One key with all rows: no window holds more than a block of it."""
    left = spark.range(40_000).select(F.lit(1).alias("id"), F.col("id").alias("t"))
    right = spark.range(0, 40_000, 3).select(F.lit(1).alias("id"), F.col("id").alias("t"), F.col("id").alias("v"))
    out = asof_join(left, right, "t", ["id"], ["v"], 500.0)
    assert out.filter(F.col("v") != F.col("t") - F.col("t") % 3).count() == 0
    spread = out.select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
    conf = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        spread = asof_join(left, right, "t", ["id"], ["v"], 500.0).select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", conf)
    assert len(spread) > 4 and max(r["count"] for r in spread) < 20_000


def test_interval_join_against_brute_force(spark):
    rnd = random.Random(6)

    def spans(n):
        rows = []
        for k in range(n):
            a = rnd.choice([None, *[rnd.randrange(500)] * 12])
            rows.append((k, rnd.choice([None, 1, 1, 2, 3]), a, None if a is None else a + rnd.choice([-3, 0, 0, 5, 40, 200])))
        return rows

    lefts, rights = spans(150), spans(150)
    left = spark.createDataFrame(lefts, "l long, id long, a long, b long")
    right = spark.createDataFrame(rights, "r long, id long, c long, d long")
    want = sorted((x, y) for x, i, a, b in lefts for y, j, c, d in rights
                  if i is not None and i == j and a is not None and c is not None and a <= b and c <= d and a <= d and c <= b)
    for width in (1.0, 30.0, 1000.0):
        met = interval_join(left, right, ["id"], ("a", "b"), ("c", "d"), width)
        assert met.columns == ["l", "id", "a", "b", "r", "c", "d"]
        assert sorted((r.l, r.r) for r in met.collect()) == want
    plan = final_plan(interval_join(left, right, ["id"], ("a", "b"), ("c", "c"), 30.0))
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_running_total_of_one_group_and_of_keys(spark, monkeypatch):
    rnd = random.Random(7)
    rows = [(k, rnd.choice([1, 1, 1, 2, None]), rnd.choice([None, *[rnd.randrange(200)] * 9]), rnd.choice([None, rnd.randrange(-5, 50)])) for k in range(500)]
    df = spark.createDataFrame(rows, "k long, g long, t long, v long")
    order = sorted(rows, key=lambda r: (r[2] is not None, r[2] or 0, r[0]))
    monkeypatch.setattr(temporal, "TOGETHER", 3)
    for by in ([], ["g"]):
        want, sums = {}, {}
        for k, g, _, v in order:
            key = g if by else 0
            sums[key] = sums.get(key, 0) + (v or 0)
            want[k] = sums[key]
        got = running_total(df, by, "t", "v", 13.0, ties=["k"])
        assert {r.k: r.running_total for r in got.collect()} == want
    assert running_total(df.limit(0), [], "t", "v", 13.0, ties=["k"]).count() == 0


def test_heavy_key_is_split_and_the_rest_joined_once(spark):
    """A third of the rows on one key, a sixth without: no AQE, tasks within
    twice the mean, result as of the plain join."""
    n, tasks = 60_000, 8
    key = F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 6 == 1, F.lit(None)).otherwise(F.col("id") % 997)
    left = spark.range(n).select(F.col("id").alias("row"), key.cast("long").alias("k"))
    right = spark.range(1200).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    conf = {c: spark.conf.get(c, None) for c in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        heavy = heavy_keys(left, ["k"], tasks)
        assert len(heavy) == 1
        for how in ("left", "inner", "left_anti"):
            met = join_heavy(left, right, "k", how, by=["row"], tasks=tasks)
            plain = left.join(right, "k", how)
            assert sorted(met.columns) == sorted(plain.columns)
            assert met.select(*plain.columns).exceptAll(plain).isEmpty() and met.count() == plain.count()
        per_task = [r["count"] for r in join_heavy(left, right, "k", "left", by=["row"], tasks=tasks).groupBy(
            F.spark_partition_id()).count().collect()]
    finally:
        for c, v in conf.items():
            spark.conf.set(c, v) if v is not None else spark.conf.unset(c)
    assert sum(per_task) == n and max(per_task) <= 2 * n / tasks
    with pytest.raises(ValueError):
        join_heavy(left, right, "k", "full")


def test_quarantine_keeps_every_row_with_its_reason(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("id,amount,day,note\n1,2.5,2020-01-31,x\nx,3,2020-02-30,\n,4,,ok\n5,6,2020-01-01,y,more\n6\n")
    (tmp_path / "in" / "b.csv").write_text("note,day,id,amount\nq,2021-05-05,7,1e400x\n\"a,b\",2021-05-06,8,9\n")
    ledger = read_csv_ledger(spark, str(tmp_path / "in"), "id BIGINT NOT NULL, amount DOUBLE, day DATE, note STRING")
    clean, rejects = quarantine(ledger, str(tmp_path / "out"))
    assert sorted((r.id, r.amount, str(r.day), r.note) for r in clean.collect()) == [(1, 2.5, "2020-01-31", "x"), (8, 9.0, "2021-05-06", "a,b")]
    assert sorted("; ".join(r._reasons) for r in rejects.collect()) == [
        "amount: 1e400x is no double", "fields: malformed record", "fields: malformed record", "id: missing",
        "id: x is no bigint; day: 2020-02-30 is no date"]
    assert {r._raw for r in rejects.filter("_raw is not null").collect()} == {"5,6,2020-01-01,y,more", "6"}
    assert clean.columns == ["id", "amount", "day", "note"]


@pytest.mark.parametrize("code, want", [
    ("10.55", ["10.55"]), ("10.550", ["10.55"]), ("10.555", []), ("10.56", ["10.56"]), (" 10.56 ", ["10.56"]), ("1e1", ["10.00"]),
    ("12345678901234567890", []), ("nan", []), ("Infinity", []), ("1_0", []), ("x", []), ("", []), ("0", ["0.00"]), ("-0.000", ["0.00"])])
def test_code_filter_on_decimals(spark, code, want):
    df = spark.createDataFrame([("10.55",), ("10.56",), ("10.00",), ("0",), (None,)], "t string").select(F.col("t").cast("decimal(10,2)").alias("c"))
    assert [str(r.c) for r in code_filter(df, "c", code).collect()] == want


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_code_filter_on_whole_numbers_has_no_fractions(spark, ansi):
    was = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        df = spark.range(100, 103)
        assert [r.id for code in ("101", 101, " 101", "101.5", "1e2", "x", "99999999999999999999") for r in code_filter(df, "id", code).collect()] == [101] * 3
    finally:
        spark.conf.set("spark.sql.ansi.enabled", was)


def test_estimates_from_several_threads(spark):
    """No redirect of the process's output, no lost estimate."""
    df, out, found = spark.read.parquet(f"{SF01}/customer.parquet"), sys.stdout, []

    def ask():
        for _ in range(8):
            found.append(estimated_bytes(df))

    threads = [threading.Thread(target=ask) for _ in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sys.stdout is out and len(found) == 32 and len(set(found)) == 1 and found[0] < float("inf")
    size = os.path.getsize(f"{SF01}/customer.parquet")
    # files hold fewer bytes than memory: the bound applies to the expanded size
    assert broadcast_fits(df, 100 * size) and not broadcast_fits(df, size)


def test_entry_without_a_library_of_the_training_data_operators():
    """A missing third-party module costs those queries only."""
    code = ("import sys; sys.modules['xxhash'] = None\n"
            "import __spark_entry__ as e\n"
            "print(len(e.queries()), any(k.startswith('op') for k in e.queries()))")
    done = subprocess.run([sys.executable, "-W", "ignore", "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120)
    from blotter.plans import roster
    assert done.stdout.split() == [str(len(roster.QUERIES)), "False"], done.stderr


def test_sketches_roll_up_within_their_error(spark):
    """Rolled up from 200 groups as good as from all rows, NULLs left out; the
    facts are not read again."""
    n = 100_000
    facts = spark.range(n).select(
        (F.col("id") % 200).alias("day"), (F.col("id") % 2).alias("k"), F.when(F.col("id") % 10 != 0, F.col("id") % 40_000).alias("who"),
        F.when(F.col("id") % 7 != 0, F.pmod(F.xxhash64("id"), F.lit(1_000_000)) / 1000).alias("v"))
    daily = sketched(facts, ["day", "k"], "who", "v").cache()
    ranks = (0.01, 0.25, 0.5, 0.9)
    exact = {r.k: r for r in facts.groupBy("k").agg(F.count_distinct("who").alias("who"), F.sort_array(F.collect_list("v")).alias("v")).collect()}
    for r in answered(rolled_up(daily, ["k"]), ranks).collect():
        assert r.n == n // 2 and abs(r.distinct_estimate / exact[r.k].who - 1) < 3 * 1.04 / math.sqrt(1 << 14)
        values = exact[r.k].v
        for rank, value in zip(ranks, r.quantiles):
            assert abs(sum(v <= value for v in values) / len(values) - rank) < 0.025
    whole = answered(rolled_up(daily, [])).first()
    assert whole.n == n and answered(sketched(facts.limit(0), ["day"], "who", "v")).count() == 0
