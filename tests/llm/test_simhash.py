"""SimHash groups against all pairs by brute force."""

import random

import numpy as np
import pytest

from blotter.llm import simhash
from blotter.llm.components import components
from tests.conftest import SF001
from tests.llm.common import SCHEMA, TEXTS, edge_docs
from tests.llm.common import components as brute_components
from tests.llm.common import simhash as brute_simhash


def want(docs):
    """(doc_id, fingerprint, component id) of (doc_id, text) rows."""
    prints = [brute_simhash(text) for _, text in docs]
    roots, least = brute_components(prints), {}
    for (doc_id, _), root in zip(docs, roots):
        known = least.setdefault(root, doc_id)
        if doc_id is not None and (known is None or doc_id < known):
            least[root] = doc_id
    return sorted([(i, f"{p:016x}", least[r]) for (i, _), p, r in zip(docs, prints, roots)], key=repr)


def rows(found):
    return sorted([(r.doc_id, f"{r.fp & (2**64 - 1):016x}", r.component_id) for r in found.collect()], key=repr)


def test_query_on_a_whole_table(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    assert sorted(map(tuple, simhash.query(spark, SF001).collect()), key=repr) == want(docs)


def test_edge_rows(spark):
    docs = edge_docs(spark)
    assert rows(simhash.near_duplicates(docs)) == want([(i, t) for i, t, _ in TEXTS])
    empty = spark.createDataFrame([], SCHEMA)
    assert simhash.near_duplicates(empty).count() == 0
    assert simhash.representatives(empty).count() == 0


def test_representatives_keep_one_row_per_group(spark):
    docs = edge_docs(spark)
    kept = simhash.representatives(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    firsts = {c for _, _, c in want([(i, t) for i, t, _ in TEXTS]) if c is not None}
    assert sorted(i for i in ids if i is not None) == sorted(firsts)
    # a row without an id is a member like any other: the empty one goes with the empty texts
    assert ids.count(None) == 1


@pytest.mark.parametrize("cell,tile", [(4096, 1024), (16, 8), (5, 3)])
def test_links_reach_every_pair_whatever_the_cells(spark, monkeypatch, cell, tile):
    monkeypatch.setattr(simhash, "CELL", cell)
    monkeypatch.setattr(simhash, "TILE", tile)
    rng = random.Random(cell)
    centres = [rng.getrandbits(64) for _ in range(6)]
    prints = {c ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 3))) for c in centres for _ in range(40)}
    prints |= {rng.getrandbits(64) for _ in range(40)}
    prints = sorted(prints)
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    found = simhash.links(spark.createDataFrame(signed, "fp long")).collect()
    parent = {p: p for p in prints}

    def root(p):
        while parent[p] != p:
            p = parent[p]
        return p

    for r in found:
        a, b = r.a & (2**64 - 1), r.b & (2**64 - 1)
        assert (a ^ b).bit_count() <= 3
        parent[root(a)] = root(b)
    groups = brute_components(prints)
    for i in range(len(prints)):
        for j in range(i):
            assert (groups[i] == groups[j]) == (root(prints[i]) == root(prints[j]))
    assert len(found) <= 4 * cell * len(prints)


def test_a_large_group_reports_a_forest_not_its_pairs():
    prints = np.array([1 << b for b in range(64)] + [0], np.uint64)
    edges = simhash._forest(prints, 3, np.zeros(len(prints), np.int64))
    assert len(edges) == len(prints) - 1


def test_long_texts_are_hashed_in_bounded_runs(monkeypatch):
    text = " ".join(f"w{i}" for i in range(500))
    whole = simhash.fingerprint_batch([text, "a b c d", ""])
    monkeypatch.setattr(simhash, "CHUNK", 7)
    assert (simhash.fingerprint_batch([text, "a b c d", ""]) == whole).all()
    assert int(whole[0]) == brute_simhash(text) and int(whole[2]) == 0


def test_components_of_chains_stars_and_cycles(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)]
    edges += [(200, 201), (201, 202), (202, 200), (300, 300)]
    random.Random(1).shuffle(edges)
    found = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    for node, least in found.items():
        assert least == (0 if node <= 40 else node // 100 * 100)
    # the smallest member stands for itself
    assert set(found) == {*range(1, 41), *range(101, 130), 201, 202}
