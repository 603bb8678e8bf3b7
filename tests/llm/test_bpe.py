"""Byte-level BPE against the tiktoken library."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from blotter.llm import bpe
from tests.conftest import SF001
from tests.llm.common import LONG, SCHEMA, edge_docs

PATH, PATTERN = public_tokenizers.path(bpe.VOCABULARY), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=bpe.load_ranks(PATH), special_tokens={})


def expected(library, text):
    ids = np.array(library.encode_ordinary(text or ""), "<u4").tobytes()
    return len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()


def test_random_strings(library):
    coder, random_ = bpe.encoder(PATH, PATTERN), random.Random(3)
    alphabets = ["ab", "aeioust ", "the and ing", "éèüñßаовкин", "日本語の漢字かな", "0123456789,.-'s",
                 bytes(range(256)).decode("latin1"), " \n\t 　x", "😀👩‍🔬é"]
    for _ in range(4000):
        text = "".join(random_.choice(random_.choice(alphabets)) for _ in range(random_.randint(0, 40)))
        assert np.frombuffer(coder.encode(text), "<u4").tolist() == library.encode_ordinary(text)


def test_transducer_forgets_and_still_agrees(library, monkeypatch):
    monkeypatch.setattr(bpe, "MAX_STATES", 50)
    monkeypatch.setattr(bpe, "MEMO_WORDS", 20)
    coder = bpe.Encoder(PATH, PATTERN)
    for text in (LONG[:20_000], "a" * 3000, "ndedndst " * 50):
        assert np.frombuffer(coder.encode(text), "<u4").tolist() == library.encode_ordinary(text)


def test_lookahead_is_bounded(library):
    """Tokens of a long pre-token come out while it is read."""
    machine = bpe.Transducer(bpe.load_ranks(PATH))
    data, state, out = ("abcde" * 400).encode(), 0, 0
    most = max(map(len, machine.ranks))
    for i, byte in enumerate(data):
        state, emitted = machine._move(state, byte)
        out += sum(len(machine.bytes_of[t]) for t in np.frombuffer(emitted, "<u4").tolist())
        assert i + 1 - out <= 2 * most


@pytest.mark.parametrize("text", ["", "plain", "é", "日本語", "a😀b", "é"])
def test_utf8_machine_at_every_cut(text):
    data = text.encode()
    for a in range(len(data) + 1):
        for b in range(a, len(data) + 1):
            machine = bpe.Utf8Machine()
            assert "".join((machine.feed(data[:a]), machine.feed(data[a:b]), machine.feed(data[b:]), machine.finish())) == text


@pytest.mark.parametrize("data", [b"\xff", b"\xe0\x80", b"ab\xc3", b"\xf0\x9f\x98", b"\xed\xa0\x80", b"\xc3\x28"])
def test_utf8_machine_replaces_what_is_not_utf8(data):
    machine = bpe.Utf8Machine()
    assert "".join([machine.feed(data[i:i + 1]) for i in range(len(data))]) + machine.finish() == data.decode("utf-8", "replace")


def test_query_on_a_whole_table(spark, library):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    rows = bpe.query(spark, SF001).collect()
    assert len(rows) == len(docs)
    for r in rows:
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == expected(library, docs[r.doc_id])


def test_edge_rows(spark, library):
    docs = edge_docs(spark)
    got = bpe.round_trip(docs).select("doc_id", *bpe.digests())
    want = [(r.doc_id, *expected(library, r.text)) for r in docs.collect()]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
    apart = bpe.decode(bpe.encode(docs, PATH, PATTERN), PATH).select("doc_id", *bpe.digests())
    assert sorted(map(tuple, apart.collect()), key=repr) == sorted(want, key=repr)
    assert bpe.round_trip(spark.createDataFrame([], SCHEMA)).count() == 0


def test_ids_as_lists(spark, library):
    docs = edge_docs(spark).filter("doc_id < 10")
    got = {r.doc_id: list(r.ids) for r in bpe.round_trip(docs, lists=True).collect()}
    assert got == {r.doc_id: library.encode_ordinary(r.text or "") for r in docs.collect()}


def test_tables_stay_within_their_bounds(library, monkeypatch):
    """Many distinct words under small bounds: nothing grows past them and the
    ids stay the library's."""
    monkeypatch.setattr(bpe, "MEMO_WORDS", 50)
    monkeypatch.setattr(bpe, "MAX_STATES", 200)
    coder = bpe.Encoder(PATH, PATTERN)
    machine = coder.memo.transducer
    for k in range(300):
        text = " ".join(f"wörd{(k * 7919 + j * 104729) % 99991}x{j}" for j in range(20)) + LONG[40 * k:40 * k + 200]
        for _ in range(2):
            assert np.frombuffer(coder.encode(text), "<u4").tolist() == library.encode_ordinary(text)
        # one pre-token may add as many as it has bytes before the bound is looked at again
        assert len(coder.memo) <= 50 and len(coder.memo.older) <= 50
        assert len(machine.configurations) <= 200 + 64 and len(machine.moves) <= 600 + 64
        assert len(machine.side_by_side) + len(machine.open_after) <= 600 + 64 * 64


def test_caches_are_dropped_when_memory_is_given_back():
    from blotter.llm import shipping

    first = bpe.encoder(PATH, PATTERN)
    assert bpe.encoder(PATH, PATTERN) is first
    shipping.give_back_memory()
    assert bpe.load_ranks.cache_info().currsize == 0 and bpe.encoder(PATH, PATTERN) is not first
