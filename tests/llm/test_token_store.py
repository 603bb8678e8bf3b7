"""Token files: the library's ids, whole and by random access."""

import io
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from blotter.llm import token_store as ts
from tests.conftest import SF001
from tests.llm.common import LONG, SCHEMA, TEXTS, edge_docs, ordered

PATH = public_tokenizers.path(ts.VOCABULARY)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids + [ts.END_ID]


TRICKY = ["", "it's the end.", "a.b,c. d, e.,", "ÉCOLE Straße İstanbul ΣΟΦΟΣ", "été ≮ x", "ﬁne ½ ① x²",
          "tabs\there nbsp em​zero", "<|endoftext|> and <|startoftext|>,", "日本語 😀", "don't, can't. 'tis",
          "\x1cunit\x1fsep\x85next", "trailing... ,,, .", "Ŧħé ŋëẃ ẞ ǅ",
          "<|ENDOFTEXT|>", "<|EndOfText|> again", "<|STARTOFTEXT|>x a<|endoftext|>.", "É<|endoftext|>É <|ENDOFTEXT|>., <|endoftext|>,"]


@pytest.mark.parametrize("text", TRICKY + [LONG])
def test_chunks_are_the_library(library, text):
    coder = ts.ChunkTokenizer(PATH)
    for _ in range(2):
        assert np.frombuffer(coder.encode(text), "<u4").tolist() == ids_of(library, text)[:-1]


def test_memory_bound_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(ts, "MEMO_CHUNKS", 3)
    coder = ts.ChunkTokenizer(PATH)
    for text in [*TRICKY, LONG[:5000], *TRICKY]:
        assert np.frombuffer(coder.encode(text), "<u4").tolist() == ids_of(library, text)[:-1]


def test_frames_and_seek_table():
    docs = [(k, np.arange(n, dtype="<u4").tobytes()) for k, n in enumerate([1, 0, 5000, 3, 40_000, 2, 0, 7])]
    out = io.BytesIO()
    writer = ts.Writer(out, frame_bytes=4096)
    for doc_id, ids in docs:
        writer.add(doc_id, ids)
    writer.close()
    raw = out.getvalue()

    class Counted(io.BytesIO):
        read_bytes = 0

        def read(self, n=-1):
            got = super().read(n)
            self.read_bytes += len(got)
            return got

    stream = Counted(raw)
    reader = ts.Reader(stream)
    assert reader.doc_ids == [k for k, _ in docs]
    before = stream.read_bytes
    assert reader.document(3) == docs[3][1]
    assert stream.read_bytes - before < len(raw) / 3  # one frame, not the file
    for k in (4, 0, 7, 2, 6, 1, 5):
        assert reader.document(k) == docs[k][1]
    broken = bytearray(raw)
    broken[int(reader.offsets[2]) + 20] ^= 255
    with pytest.raises(Exception):
        for k in range(len(docs)):
            ts.Reader(io.BytesIO(bytes(broken))).document(k)


def test_files_are_plain_zstandard():
    import zstandard

    out = io.BytesIO()
    writer = ts.Writer(out, frame_bytes=64)
    writer.add(1, b"\1\0\0\0" * 100)
    writer.add(2, b"\2\0\0\0" * 3)
    writer.close()
    stream = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(out.getvalue()), read_across_frames=True)
    assert stream.read() == b"\1\0\0\0" * 100 + b"\2\0\0\0" * 3


def want(library, docs):
    start, out = 0, []
    for doc_id, text in ordered(docs):
        ids = ids_of(library, text)
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return sorted(out, key=repr)


def test_query_on_a_whole_table(spark, library):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    assert sorted(map(tuple, ts.query(spark, SF001).collect()), key=repr) == want(library, docs)


def test_edge_rows_over_several_files(spark, library, tmp_path, monkeypatch):
    monkeypatch.setattr(ts, "FILE_TEXT_BYTES", 3000)
    docs = edge_docs(spark)
    manifest = ts.write_tokens(docs, PATH, str(tmp_path / "t"))
    assert manifest.count() > 1
    got = ts.read_tokens(manifest, str(tmp_path / "t")).collect()
    rows = sorted(((r.doc_id, r.start, len(r.ids) // 4, zlib.crc32(r.ids)) for r in got), key=repr)
    assert rows == want(library, [(i, t) for i, t, _ in TEXTS])
    some = ts.read_tokens(manifest, str(tmp_path / "t"), wanted=[4, 6]).collect()
    assert sorted(r.doc_id for r in some) == [4, 6]


def test_empty_table(spark, tmp_path):
    manifest = ts.write_tokens(spark.createDataFrame([], SCHEMA), PATH, str(tmp_path / "t"))
    assert ts.read_tokens(manifest, str(tmp_path / "t")).count() == 0


def test_other_names_of_an_object_store_are_known():
    """Paths are opened as Spark names them; no store is asked here."""
    for scheme in ("s3", "s3a", "s3n"):
        system, base = ts._open(f"{scheme}://bucket-name/tokens?region=us-east-1")
        assert system.type_name == "s3" and base == "bucket-name/tokens"
