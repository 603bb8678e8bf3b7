"""Both substring operators against brute force over all windows."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pyarrow.compute
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from blotter.llm import block_anchors, suffix_array
from tests.conftest import SF001, SF01
from tests.llm.common import LONG, PASSAGE, SCHEMA, TEXTS, cut_bytes, cut_words, edge_docs, ordered, spans, text_after

SETTINGS = settings(max_examples=60, deadline=None, suppress_health_check=list(HealthCheck))


def want_bytes(docs):
    docs = ordered(docs)
    out = []
    for (doc_id, text), mask in zip(docs, cut_bytes([t for _, t in docs])):
        data = (text or "").encode()
        kept = bytes(b for b, m in zip(data, mask) if not m)
        out.append((doc_id, len(data), sum(mask), spans(mask), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def want_words(docs):
    docs = ordered(docs)
    out = []
    for (doc_id, _), (words, gone) in zip(docs, cut_words([t for _, t in docs])):
        kept = " ".join(w for w, g in zip(words, gone) if not g)
        out.append((doc_id, len(words), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def got_bytes(found):
    return sorted([(r.rest.doc_id, r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest())
                   for r in found.collect()], key=repr)


def got_words(found):
    return sorted([(r.rest.doc_id, r.n_words, r.n_removed, hashlib.sha256(r.kept.encode()).hexdigest())
                   for r in found.collect()], key=repr)


def table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    return docs, [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


def test_bytes_query_on_a_whole_table(spark):
    _, docs = table(spark, SF01)
    assert sorted(map(tuple, suffix_array.query(spark, SF01).collect()), key=repr) == want_bytes(docs)


def test_bytes_over_many_shards_and_buckets(spark, monkeypatch):
    monkeypatch.setattr(suffix_array, "BUCKET_TEXT", 60_000)
    frame, docs = table(spark, SF001)
    assert got_bytes(suffix_array.removals(frame.repartition(5), shard_bytes=20_000)) == want_bytes(docs)


def test_words_over_many_shards_and_buckets(spark, monkeypatch):
    monkeypatch.setattr(block_anchors, "BUCKET_TEXT", 60_000)
    frame, docs = table(spark, SF001)
    assert got_words(block_anchors.removals(frame.repartition(5), shard_bytes=20_000)) == want_words(docs)


@pytest.mark.parametrize("shard_bytes", [1 << 22, 2000])
def test_edge_rows(spark, shard_bytes):
    docs, plain = edge_docs(spark), [(i, t) for i, t, _ in TEXTS]
    assert got_bytes(suffix_array.removals(docs, shard_bytes=shard_bytes)) == want_bytes(plain)
    assert got_words(block_anchors.removals(docs, shard_bytes=shard_bytes)) == want_words(plain)


def test_empty_tables_and_columns(spark):
    empty = spark.createDataFrame([], SCHEMA)
    for module in (suffix_array, block_anchors):
        assert module.removals(empty).count() == 0
        assert module.dedup(empty).columns == empty.columns and module.dedup(empty).count() == 0
    docs = edge_docs(spark)
    cut = suffix_array.dedup(docs)
    assert cut.columns == docs.columns
    plain = ordered([(i, t) for i, t, _ in TEXTS])
    texts = [text_after(t or "", m) for (_, t), m in zip(plain, cut_bytes([t for _, t in plain]))]
    assert sorted(r.text for r in cut.collect()) == sorted(texts)


def test_a_passage_of_every_document_stays_once(spark):
    rng = random.Random(4)
    rows = [(k, " ".join(f"{rng.getrandbits(40):x}" for _ in range(30)) + " " + PASSAGE + " "
             + " ".join(f"{rng.getrandbits(40):x}" for _ in range(30)), "s") for k in range(300)]
    docs = edge_docs(spark, rows)
    for cut in (suffix_array.removals(docs, shard_bytes=30_000).withColumnRenamed("n_bytes", "n"),
                block_anchors.removals(docs, shard_bytes=30_000).withColumnRenamed("n_words", "n")):
        found = {r.rest.doc_id: r for r in cut.collect()}
        assert found[0].n_removed == 0
        assert all(found[k].n_removed >= (len(PASSAGE) if k and found[k].n > 200 else 60) for k in range(1, 300))
    assert got_bytes(suffix_array.removals(docs, shard_bytes=30_000)) == want_bytes([(i, t) for i, t, _ in rows])


def test_one_shard_of_copies_of_a_long_text(spark):
    rows = [(k, LONG[:60_000], "s") for k in range(4)]
    found = {r.rest.doc_id: r for r in suffix_array.removals(edge_docs(spark, rows)).collect()}
    assert found[0].n_removed == 0 or found[0].n_removed < found[0].n_bytes
    assert all(found[k].n_removed == found[k].n_bytes for k in (1, 2, 3))


def _edged(n):
    """Documents with one passage and unique text around it."""
    rng = random.Random(12)
    return [(k, " ".join(f"{rng.getrandbits(40):x}" for _ in range(12)) + " " + PASSAGE[:200] + " "
             + " ".join(f"{rng.getrandbits(40):x}" for _ in range(12))) for k in range(n)]


def test_windows_across_the_edges_of_a_common_passage_spread_over_buckets():
    docs, shards, buckets = _edged(9000), 6, 16
    parts = [pa.table({"doc_id": [i for i, _ in docs[k::shards]], "text": [t for _, t in docs[k::shards]]}) for k in range(shards)]
    anchors = pa.concat_tables([suffix_array._anchors(p, k, 100, buckets) for k, p in enumerate(parts)])

    def by(table, column, key):
        return table.filter(pa.compute.equal(table[column], key))

    shared = pa.concat_tables([suffix_array._shared(by(anchors, "bucket", b), suffix_array.CROWD) for b in range(buckets)])
    sent = pa.concat_tables([suffix_array._within(p, by(shared, "shard", k), k, 100, buckets) for k, p in enumerate(parts)])
    sizes = [sum(len(x) for c in ("data", "digests") for x in by(sent, "bucket", b)[c].to_pylist() if x) for b in range(buckets)]
    assert max(sizes) < 2 * sum(sizes) / buckets


def test_crowded_anchors_give_the_same_rows(spark, monkeypatch):
    docs = _edged(200)
    # some neighbourhoods of the passage occur again, in other shards too
    docs += [(1000 + k, "x" * k + docs[k][1][60:-40]) for k in range(0, 200, 3)]
    monkeypatch.setattr(suffix_array, "BUCKET_TEXT", 15_000)
    for crowd in (0, 20):
        monkeypatch.setattr(suffix_array, "CROWD", crowd)
        assert got_bytes(suffix_array.removals(edge_docs(spark, [(*d, "s") for d in docs]), shard_bytes=10_000)) == want_bytes(docs)


def _left(sizes):
    return np.concatenate([np.arange(n, 0, -1) for n in sizes]) if sizes else np.zeros(0, np.int64)


@SETTINGS
@given(st.lists(st.text("ab", min_size=1, max_size=60), min_size=1, max_size=5), st.integers(1, 20))
def test_suffix_array_sorts_and_prefixes_are_common(texts, length):
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    left = _left([len(t) for t in texts])
    suffixes = [bytes(data[i:i + left[i]]) for i in range(len(data))]
    array = suffix_array.suffix_array(data, left, length).tolist()
    whole = [i for i in range(len(data)) if left[i] >= length]
    assert array == sorted(whole, key=lambda i: (suffixes[i][:length], i))
    values = suffix_array.common_prefixes(data, left, np.array(array, np.int64))
    for k in range(1, len(array)):
        a, b = suffixes[array[k - 1]], suffixes[array[k]]
        common = next((n for n, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        assert values[k] == common
    seen, again = set(), set()
    for i in whole:
        if suffixes[i][:length] in seen:
            again.add(i)
        seen.add(suffixes[i][:length])
    assert set(suffix_array.repeats(data, left, length).tolist()) == again


@SETTINGS
@given(st.lists(st.text("ab", max_size=80), min_size=1, max_size=4), st.integers(1, 24))
def test_runs_cover_every_window_and_anchors_follow_content(texts, length):
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    ends = np.cumsum([len(t) for t in texts])
    start, count, anchor, hashes = suffix_array.runs(data, ends, length)
    covered = suffix_array._spread(start, count).tolist()
    begin, want = 0, []
    for t in texts:
        want += range(begin, begin + max(0, len(t) - length + 1))
        begin += len(t)
    assert covered == want
    at = np.repeat(np.arange(len(start)), count)
    by_content = {}
    for window, run in zip(covered, at):
        seen = (int(anchor[run]) - window, int(hashes[run]))
        assert by_content.setdefault(bytes(data[window:window + length]), seen) == seen


def test_merging_shards_marks_what_a_lower_shard_has():
    rng = np.random.default_rng(2)
    text = rng.integers(0, 3, 4000).astype(np.uint8)
    window = np.arange(3900)
    owner = np.sort(rng.integers(0, 7, 3900))
    marked = suffix_array.merge_shards(text, window, owner, 6)
    first = {}
    for w, o in zip(window.tolist(), owner.tolist()):
        first.setdefault(bytes(text[w:w + 6]), o)
    # within one shard equal windows are not marked against each other
    want = [first[bytes(text[w:w + 6])] < o for w, o in zip(window.tolist(), owner.tolist())]
    assert marked.tolist() == want


def test_merging_shards_survives_equal_digests_of_different_windows(monkeypatch):
    hashes = suffix_array.gram_hashes
    monkeypatch.setattr(suffix_array, "gram_hashes", lambda data, k: hashes(data, k) & np.uint64(63))
    test_merging_shards_marks_what_a_lower_shard_has()


@SETTINGS
@given(st.lists(st.integers(0, 2**40), max_size=50))
def test_packed_keys_come_back(keys):
    keys = np.unique(np.array(keys, np.uint64))
    assert block_anchors._unpack(block_anchors._pack(keys)).tolist() == keys.tolist()


def test_words_that_a_polynomial_hash_confuses_are_told_apart(spark):
    """Thue-Morse words and their complements collide under any polynomial
    modulo a power of two."""
    for n in (1024, 2048):
        word = "".join("ab"[bin(i).count("1") & 1] for i in range(n))
        other = "".join("ba"[bin(i).count("1") & 1] for i in range(n))
        frame = " ".join(f"w{i}" for i in range(12))
        docs = spark.createDataFrame([(1, f"{frame} {word} {frame}"), (2, f"{frame} {other} {frame}")], "doc_id long, text string")
        assert {r.rest.doc_id: r.n_removed for r in block_anchors.removals(docs).collect()} == {1: 0, 2: 0}
