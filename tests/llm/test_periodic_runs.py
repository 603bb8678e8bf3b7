"""Periodic runs against a search over all periods and places."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from blotter.llm import periodic_runs as pr
from tests.conftest import SF001, SF01
from tests.llm.common import SCHEMA, TEXTS, WORD, edge_docs

SETTINGS = settings(max_examples=150, deadline=None, suppress_health_check=list(HealthCheck))


def brute_runs(words):
    """Maximal stretches of every period, the smallest period of each."""
    n, found = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i < n - q:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(6, 4 * q):
                found.setdefault((i, j - i + q), q)
            i = j
    return sorted(((s, length, q) for (s, length), q in found.items()), key=lambda r: (r[0], r[2]))


def want(doc_id, text, plant=True):
    words = WORD.findall(text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    g = h // 10
    if plant and doc_id is not None and h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    found, gone = brute_runs(words), set()
    for s, length, q in found:
        gone.update(range(s + q, s + length))
    best = max(found, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=(None, None, None))
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in found)
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    return (doc_id, len(found), *best, None if best[0] is None else 1000 * best[1] // best[2],
            hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


@pytest.mark.parametrize("sf", [SF001, SF01])
def test_query_on_a_whole_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    short = [r for r in docs if len(r.text or "") < 30_000]
    got = {r.doc_id: tuple(r) for r in pr.query(spark, sf).select(*COLUMNS).collect()}
    assert len(got) == len(docs) and any(r[1] > 1 for r in got.values())
    for r in short:
        assert got[r.doc_id] == want(r.doc_id, r.text)


pattern = st.lists(st.integers(0, 2), min_size=1, max_size=12)
block = st.builds(lambda p, times, extra: (p * times)[:len(p) * times - extra], pattern, st.integers(1, 9), st.integers(0, 3))
text = st.builds(lambda blocks: [w for b in blocks for w in b], st.lists(block, max_size=6))


@SETTINGS
@given(st.lists(text, max_size=4), st.sampled_from([2, 3, 8]))
def test_runs_of_texts_side_by_side(texts, step):
    got = pr.runs([np.array(t, np.int64) for t in texts], step)
    assert [[tuple(map(int, r)) for r in rows] for rows in got] == [brute_runs(t) for t in texts]


def test_long_periods_and_copies_of_one_text():
    """Extensions far beyond the sampled blocks, and equal texts beside each other."""
    rnd = random.Random(3)
    part = [rnd.randrange(50) for _ in range(700)]
    long = part * 5 + [99] + part[:200] * 6 + [rnd.randrange(3) for _ in range(500)]
    texts = [long, long, list(reversed(long)), [7] * 3000, [], [1]]
    got = pr.runs([np.array(t, np.int64) for t in texts])
    assert [[tuple(map(int, r)) for r in rows] for rows in got] == [brute_runs(t) for t in texts]


@pytest.mark.parametrize("step", [2, 3, 4, 8])
def test_the_cover_makes_any_two_places_meet(step):
    v, cover = step * step, set(pr.cover(step).tolist())
    assert len(cover) <= 2 * step
    for i in range(v):
        for d in range(v):
            s = int(pr.shifts(step)[i, d])
            assert (i + s) % v in cover and (i + d + s) % v in cover


def test_extensions_are_longest_common_prefixes():
    rnd = random.Random(4)
    codes = [rnd.randrange(2) for _ in range(150)] * 3 + [-1] + [0] * 200 + [-2]
    lce = pr.Extensions(np.array(codes), 3)
    pairs = [(i, j) for i in range(0, len(codes), 7) for j in range(i + 1, len(codes), 5)]
    got = lce(np.array([i for i, _ in pairs]), np.array([j for _, j in pairs]))
    for (i, j), k in zip(pairs, got.tolist()):
        same = 0
        while j + same < len(codes) and codes[i + same] == codes[j + same]:
            same += 1
        assert k == same
    # only sampled suffixes were sorted
    assert len(lce.array) <= len(lce.codes) * 5 / 9 + 9


def test_edge_rows(spark):
    done = pr.collapse(edge_docs(spark)).collect()
    assert len(done) == len(TEXTS)
    by_text = {}
    for r in done:
        by_text.setdefault((r.doc_id, r.n_words), []).append(r)
    for doc_id, t, _ in TEXTS:
        words = WORD.findall(t or "")
        found = brute_runs(words) if len(words) < 5000 else None
        for r in by_text[doc_id, len(words)]:
            if found is not None and len(by_text[doc_id, len(words)]) == 1:
                assert [tuple(x) for x in r.runs] == found
    nine = next(r for r in done if r.doc_id == 9)
    assert [tuple(x) for x in nine.runs] == [(0, 120, 4)] and nine.collapsed == "line of words here" and nine.n_kept == 4
    assert pr.collapse(spark.createDataFrame([], SCHEMA)).count() == 0
    assert all(r.collapsed == "" and r.runs == [] for r in done if r.n_words == 0)


def test_one_very_long_text(spark):
    words = [f"w{k % 4001}" for k in range(60_000)]
    docs = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(words[:4001 * 4 - 1]))], "doc_id long, text string")
    got = {r.doc_id: [tuple(x) for x in r.runs] for r in pr.collapse(docs).collect()}
    assert got == {1: [(0, 60_000, 4001)], 2: []}
