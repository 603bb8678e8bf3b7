"""Randomized comparisons with plain-Python brute force on small inputs."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from blotter.operators import join_with_strategy, keep_first, top_k_groups

SETTINGS = settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
keys = st.one_of(st.none(), st.sampled_from(["a", "b", "c", "d", "e"]))
measures = st.one_of(st.none(), st.integers(0, 5))


def brute_top_k(rows, k, ascending, nulls):
    per_key = {}
    for key, m in rows:
        if key not in per_key:
            per_key[key] = m
        elif m is not None and (per_key[key] is None or m > per_key[key]):
            per_key[key] = m
    items = list(per_key.items())
    if nulls == "drop":
        items = [(key, m) for key, m in items if m is not None]
    nulls_first = nulls == "first"

    def sort_key(item):
        key, m = item
        m_null = (m is None) != nulls_first  # False sorts first
        key_null = (key is None) != nulls_first
        mv = 0 if m is None else (m if ascending else -m)
        return (m_null, mv, key_null, key or "")

    items.sort(key=sort_key)
    return items if k is None else items[:k]


@SETTINGS
@given(
    st.lists(st.tuples(keys, measures), min_size=1, max_size=25),
    st.one_of(st.none(), st.integers(1, 4)),
    st.booleans(),
    st.sampled_from(["drop", "first", "last"]),
)
def test_top_k_groups_matches_brute_force(spark, rows, k, ascending, nulls):
    df = spark.createDataFrame(rows, "k string, v int")
    got = [tuple(r) for r in top_k_groups(df, "k", "v", k, ascending, nulls).collect()]
    assert got == brute_top_k(rows, k, ascending, nulls)


@SETTINGS
@given(
    st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 3)), st.integers(0, 9)), min_size=0, max_size=30),
    st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 4)), st.integers(0, 9)), min_size=0, max_size=10),
    st.sampled_from(["inner", "left", "left_semi", "left_anti"]),
    st.integers(2, 5),
)
def test_salted_and_deduped_joins_match_brute_force(spark, left, right, how, salt):
    ldf = spark.createDataFrame(left, "k int, lv int")
    rdf = spark.createDataFrame(right, "k int, rv int")
    for dedupe in (None, "rv"):
        rows_r = right
        if dedupe:
            best = {}
            for key, rv in right:
                best[key] = rv if key not in best else min(best[key], rv)
            rows_r = list(best.items())
        expected = []
        for key, lv in left:
            partners = [rv for rk, rv in rows_r if key is not None and rk == key]
            if how == "inner":
                expected += [(key, lv, rv) for rv in partners]
            elif how == "left":
                expected += [(key, lv, rv) for rv in partners] or [(key, lv, None)]
            elif how == "left_semi":
                expected += [(key, lv)] if partners else []
            else:
                expected += [] if partners else [(key, lv)]
        got = join_with_strategy(ldf, rdf, "k", how, "merge", dedupe=dedupe, salt=salt).collect()
        assert sorted(map(tuple, got), key=repr) == sorted(expected, key=repr)


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 3), st.one_of(st.none(), st.integers(0, 9)), st.text("xyz", max_size=2)),
                min_size=1, max_size=20))
def test_keep_first_matches_brute_force(spark, rows):
    df = spark.createDataFrame(rows, "k int, o int, s string")
    expected = {}
    for key, o, s in rows:
        rank = (o is None, o or 0, s)
        if key not in expected or rank < expected[key][0]:
            expected[key] = (rank, (o, s))
    expected = {key: kept for key, (_, kept) in expected.items()}
    got = {r.k: (r.o, r.s) for r in keep_first(df, ["k"], "o").collect()}
    assert got == expected


def brute_rank(rows, k, method):
    out = []
    groups = {}
    for g, v, tie in rows:
        groups.setdefault(g, []).append((g, v, tie))
    for members in groups.values():
        members.sort(key=lambda r: (-r[1], r[2]))
        for i, r in enumerate(members):
            if method == "row_number":
                rank = i + 1
            elif method == "rank":
                rank = 1 + sum(1 for m in members if m[1] > r[1])
            else:
                rank = 1 + len({m[1] for m in members if m[1] > r[1]})
            if rank <= k:
                out.append((*r, rank))
    return sorted(out, key=repr)


@SETTINGS
@given(
    st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 2)), st.integers(0, 4), st.integers(0, 10**6)),
             min_size=1, max_size=30, unique_by=lambda r: r[2]),
    st.integers(1, 4),
    st.sampled_from(["rank", "dense_rank", "row_number"]),
)
def test_top_k_per_group_matches_brute_force(spark, rows, k, method):
    from pyspark.sql import functions as F

    from blotter.operators import top_k_per_group

    df = spark.createDataFrame(rows, "g int, v int, t int")
    # rank / dense_rank see ties on v; row_number needs the unique t to be deterministic
    order = [F.col("v").desc()] + ([F.col("t").asc()] if method == "row_number" else [])
    got = top_k_per_group(df, ["g"], order, k, method).collect()
    assert sorted(map(tuple, got), key=repr) == brute_rank(rows, k, method)
