"""Hard negatives against all pairs, and the tree's bounds."""

import random

import numpy as np
import pytest

from blotter.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<float>, label int, v string, shard int, part int, place int"


def brute(rows, anchors, positives=5, negatives=5, low=80, high=100):
    out = []
    for i in anchors:
        label, v = rows[i]
        scores = sorted((-int(np.dot(v, w)), j, other) for j, (other, w) in rows.items() if j != i)
        for s, j, _ in [x for x in scores if x[2] == label][:positives]:
            hits = [x for x in scores if x[2] != label and low * -s <= 100 * -x[0] <= high * -s][:negatives]
            out += [(i, j, k + 1, x[1], -s, -x[0]) for k, x in enumerate(hits)]
    return sorted(out)


def rows_of(found):
    return sorted((r.anchor_id, r.positive_id, r.rank, r.negative_id, r.positive_score, r.negative_score) for r in found.collect())


def some(n, dims, seed, labels=4, spread=20):
    """Small whole components, so that scores tie."""
    rnd = random.Random(seed)
    return {k: (rnd.randrange(labels), [rnd.randrange(-spread, spread + 1) for _ in range(dims)]) for k in range(n)}


def frame(spark, rows):
    return spark.createDataFrame([(k, lab, [float(x) for x in v]) for k, (lab, v) in rows.items()], "vec_id long, label int, v array<double>")


@pytest.mark.parametrize("n, dims, spread, shard_rows, block", [
    (400, 3, 3, 50, 10), (300, 8, 2, 40, 7), (500, 2, 30, 8192, 4096), (260, 1, 2, 30, 9), (6, 4, 3, 2, 2)])
def test_mined_over_many_shards_and_blocks(spark, n, dims, spread, shard_rows, block):
    rows = some(n, dims, n + dims, spread=spread)
    table = frame(spark, rows)
    found = hn.mined(table, table.filter("vec_id % 20 = 0"), shard_rows=shard_rows, block=block)
    assert rows_of(found) == brute(rows, [k for k in rows if k % 20 == 0])


def test_one_label_holds_most_rows_and_copies(spark):
    """A hot label, and a third of the rows are one vector: all scores tie."""
    rows = {k: (0 if k % 3 else 1, [5, 1, -2] if k % 3 == 1 else [k % 7, k % 5, 1]) for k in range(300)}
    table = frame(spark, rows)
    found = hn.mined(table, table.filter("vec_id % 50 = 0"), shard_rows=40)
    assert rows_of(found) == brute(rows, range(0, 300, 50))


def test_tree_search_equals_a_scan_and_skips_leaves():
    rng = np.random.default_rng(1)
    points = np.floor(rng.normal(size=(3000, 2)) * 200)
    ids, labels = rng.permutation(3000), rng.integers(0, 3, 3000)
    tree = hn.RTree(ids, labels, points, leaf=16, fan=4)
    for level, (low, high) in enumerate(tree.levels):
        assert (low <= high).all()
        if level:  # a node's box holds its children's
            below = tree.levels[level - 1]
            assert np.array_equal(low, np.minimum.reduceat(below[0], np.arange(0, len(below[0]), 4)))
    a = np.array([3.0, -2.0])
    scores = points @ a
    for windows in ([(-np.inf, np.inf)], [(100.0, 500.0), (-50.0, -40.0)]):
        seen = []
        got = tree.search(a, lambda b, e: tree.labels[b:e] != 1, windows, 7, seen)
        for (least, most), rows in zip(windows, got):
            order = sorted((-s, i) for s, i, lab in zip(scores, ids, labels) if lab != 1 and least <= s <= most)[:7]
            assert rows == [(-s, i) for s, i in order]
        assert len(set(seen)) == len(seen) < len(tree.levels[0][0]) / 3


def test_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    extra = ("x", 1, 2, 3)
    rows = [(0, [1.0, 0.5], 1), (1, [1.0, 0.25], 1), (2, [0.9, 0.5], 2), (3, None, 1), (4, [1.0, 1.0], None), (5, [nan, 1.0], 2),
            (6, [inf, 1.0], 2), (7, [None, 1.0], 2), (None, [1.0, 1.0], 2), (8, [], 1), (9, [1.0], 1), (2, [0.9, 0.5], 2), (2, [0.9, 0.5], 3)]
    docs = spark.createDataFrame([(*r, *extra) for r in rows], SCHEMA)
    table = hn.points(docs)
    assert sorted((r.vec_id, r.label, r.v) for r in table.collect()) == [
        (0, 1, [256.0, 128.0]), (1, 1, [256.0, 64.0]), (2, 2, [230.0, 128.0])]
    plain = {0: (1, [256, 128]), 1: (1, [256, 64]), 2: (2, [230, 128])}
    assert rows_of(hn.mined(table, table)) == brute(plain, plain)
    empty = hn.points(docs.limit(0))
    assert hn.mined(empty, empty).count() == 0
    alone = table.filter("vec_id = 0")
    assert hn.mined(alone, alone).count() == 0
