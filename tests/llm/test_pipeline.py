"""The pipeline, stage by stage, against brute force on its own input."""

import hashlib

import corpus_pipeline
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from blotter.llm import bpe, mixing, quality_rules
from tests.conftest import SF001
from tests.llm.common import SCHEMA, TEXTS, WORD, cut_bytes, edge_docs, ordered, text_after
from tests.llm.test_native_ops import measures
from tests.llm.test_simhash import want as simhash_groups

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def brute_quality(text):
    words, chars, symbols, dups, repeats = measures(text)
    lines = sum(bool(WORD.search(x)) for x in (text or "").split("\n"))
    return not (words < 50 or 100 * repeats > 50 * words or 100 * symbols > 8 * chars
                or (100 * dups > 50 * lines and lines >= 4) or chars > 25 * words)


def brute_stages(docs):
    """Rows (id, text, source) after the first three stages."""
    kept = [r for r in docs if brute_quality(r[1])]
    firsts = {c for _, _, c in simhash_groups([(i, t) for i, t, _ in kept])}
    one = {}
    for row in ordered(kept):
        if row[0] is None or (row[0] in firsts and row[0] not in one):
            one[row[0] if row[0] is not None else object()] = row
    kept = ordered(one.values())
    return [(i, text_after(t or "", m), s) for (i, t, s), m in zip(kept, cut_bytes([t for _, t, _ in kept]))]


def check(spark, docs, plain, sf):
    for name, stage in corpus_pipeline.STAGES[:3]:
        docs = stage(spark, docs, sf)
        assert set(COLUMNS) <= set(docs.columns)
    docs = docs.cache()
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    assert sorted(rows, key=repr) == sorted(brute_stages(plain), key=repr)
    assert all(r.n_chars == len(r.text) for r in docs.collect())
    mixed = corpus_pipeline.mix_sources(spark, docs, sf).cache()
    plan = {(r.doc_id, r.source, r.size): r.copies for r in mixing.copies(mixing.sized(docs)).collect()}
    want = [r for r in rows for _ in range(plan[r[0], r[2], len(WORD.findall(r[1]))])]
    got = [(r.doc_id, r.text, r.source) for r in mixed.collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={},
                                mergeable_ranks=bpe.load_ranks(public_tokenizers.path(bpe.VOCABULARY)))
    tokens = []
    for doc_id, text, _ in got:
        ids = library.encode_ordinary(text)
        tokens.append((doc_id, ids, len(ids), hashlib.sha256(text.encode()).hexdigest()))
    last = corpus_pipeline.tokenize(spark, mixed, sf).collect()
    assert sorted(((r.doc_id, list(r.ids), r.n_tokens, r.decoded_sha256) for r in last), key=repr) == sorted(tokens, key=repr)
    return tokens


def test_stages_on_a_whole_table(spark):
    table = spark.read.parquet(f"{SF001}/documents.parquet")
    tokens = check(spark, table, [(r.doc_id, r.text, r.source) for r in table.collect()], SF001)
    ran = corpus_pipeline.run(spark, SF001)
    assert sorted((r.doc_id, r.n_tokens) for r in ran.collect()) == sorted((t[0], t[2]) for t in tokens)


def test_stages_on_edge_rows(spark):
    check(spark, edge_docs(spark), TEXTS, SF001)


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stages_on_an_empty_table(spark, name, stage):
    empty = spark.createDataFrame([], SCHEMA)
    out = stage(spark, empty, SF001)
    assert out.count() == 0
    if stage is not corpus_pipeline.tokenize:
        assert out.columns == empty.columns


def test_clean_documents_stay(spark):
    table, labels = (spark.read.parquet(f"{SF001}/{t}.parquet") for t in ("documents", "labels"))
    good = quality_rules.measured(table.join(labels.filter("quality = 1"), "doc_id")).filter(
        "n_words >= 50 and 100 * n_repeat_words <= 50 * n_words").select("doc_id")
    kept = corpus_pipeline.quality(spark, table, SF001)
    assert good.join(kept, "doc_id", "left_anti").count() == 0
    assert kept.filter(F.col("text").isNull()).count() == 0
