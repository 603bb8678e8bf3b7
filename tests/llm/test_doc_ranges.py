"""Ranges by bytes: order, sizes, skewed and missing ids, cuts kept in a table."""

import pytest
from pyspark.sql import functions as F

from blotter.llm import block_anchors, doc_ranges, edit_fingerprint, suffix_array, token_store
from tests.conftest import SF01
from tests.llm.common import cut_bytes, cut_words

BYTES = 100_000


@pytest.fixture(scope="module")
def tables(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "text").cache()
    long = spark.range(20).select((F.col("id") + 400).alias("doc_id"), F.repeat(F.concat(F.lit("word "), F.col("id").cast("string"), F.lit(" ")), 22_000).alias("text"))
    return {
        "plain": docs,
        "a third without id": docs.withColumn("doc_id", F.when(F.col("doc_id") % 3 != 0, F.col("doc_id"))),
        "long texts side by side": docs.filter("doc_id < 400 or doc_id >= 420").unionByName(long),
        "one id": docs.withColumn("doc_id", F.lit(5).cast("long")),
        "copies under one id": docs.withColumn("doc_id", F.lit(5).cast("long")).withColumn(
            "text", F.concat(F.lit("the same beginning of every text " * 3), F.col("text"))),
    }


@pytest.mark.parametrize("held", [1 << 16, 5])
@pytest.mark.parametrize("name", ["plain", "a third without id", "long texts side by side", "one id", "copies under one id"])
def test_ranges_are_ordered_and_even(spark, tables, name, held):
    rows, n = doc_ranges.with_ranges(tables[name], BYTES, held=held)
    got = [(r.doc_id, r.text, r[doc_ranges.RANGE]) for r in rows.collect()]
    assert sorted({r for _, _, r in got}) == list(range(n)) and n > 8
    in_order = sorted(got, key=lambda r: (r[0] is None, r[0] or 0, doc_ranges.order_key(r[1])))
    assert [r for _, _, r in in_order] == sorted(r for _, _, r in got)
    sizes = [0] * n
    for _, text, r in got:
        sizes[r] += len(text.encode())
    assert max(sizes) <= max(2 * sum(sizes) / n, max(len(t.encode()) for _, t, _ in got) + BYTES)
    if name != "long texts side by side":
        assert max(sizes) <= 2 * sum(sizes) / n


def ordered(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, doc_ranges.order_key(r[1])))


@pytest.mark.parametrize("name", ["a third without id", "one id"])
def test_removals_on_skewed_ids_equal_brute_force(spark, tables, name):
    docs = [(r.doc_id, r.text or "") for r in tables[name].collect()]
    docs = ordered(docs)
    want = sorted(((i, sum(mask)) for (i, _), mask in zip(docs, cut_bytes([t for _, t in docs]))), key=repr)
    found = suffix_array.removals(tables[name], shard_bytes=BYTES).select("rest.doc_id", "n_removed")
    assert sorted(map(tuple, found.collect()), key=repr) == want
    want = sorted(((i, sum(gone)) for (i, _), (_, gone) in zip(docs, cut_words([t for _, t in docs]))), key=repr)
    found = block_anchors.removals(tables[name], shard_bytes=BYTES).select("rest.doc_id", "n_removed")
    assert sorted(map(tuple, found.collect()), key=repr) == want


def test_fingerprints_follow_the_order(spark, tables, monkeypatch):
    """The next document across ranges cut inside an id."""
    monkeypatch.setattr(edit_fingerprint, "RANGE_TEXT", BYTES)
    table = tables["a third without id"]
    docs = ordered([(r.doc_id, r.text or "") for r in table.collect()])
    got = sorted(((r.doc_id, r.edited_sha256) for r in edit_fingerprint.fingerprints(table).collect()), key=repr)
    import hashlib

    want = sorted(((i, hashlib.sha256(edit_fingerprint.edited(t, docs[(k + 1) % len(docs)][1]).encode()).hexdigest())
                   for k, (i, t) in enumerate(docs)), key=repr)
    assert got == want


def test_token_files_are_read_back_in_many_tasks(spark, tables, tmp_path, monkeypatch):
    monkeypatch.setattr(token_store, "FILE_TEXT_BYTES", BYTES)
    import public_tokenizers

    manifest = token_store.write_tokens(tables["a third without id"], public_tokenizers.path(token_store.VOCABULARY), str(tmp_path / "t"))
    files = manifest.count()
    rows = token_store.read_tokens(manifest, str(tmp_path / "t"))
    parts = rows.select(F.spark_partition_id().alias("p"), "start", F.octet_length("ids").alias("n")).collect()
    assert files > 20 and len({r.p for r in parts}) > 3
    at = 0
    for r in sorted(parts, key=lambda r: r.start):
        assert r.start == at
        at += r.n // 4
    few = token_store.with_starts(spark.read.parquet(str(tmp_path / "t" / "manifest")), together=3)
    assert sorted(map(tuple, few.select("part", "start").collect())) == sorted(map(tuple, manifest.select("part", "start").collect()))
