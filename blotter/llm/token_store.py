"""Token ids in files of independent zstandard frames with a seek table.

A file holds the documents of one range of ids in ascending order:

    frame 0 .. frame n-1     zstandard frames, each some whole documents' ids
                             as little-endian unsigned 32-bit integers (a very
                             long document fills several)
    skippable frame          zstandard-compressed index: per document its id
                             and the position after its last id
    skippable frame          seek table: per frame its compressed and plain
                             size and the low 32 bits of the XXH64 of the
                             plain bytes; then frame count, flags, magic

The layout of the seek table is the public zstandard seekable format.  A
reader takes the tail, finds the frames that hold the requested positions and
decompresses only those, checking each against its checksum.

A task writes its file under a name of its own and reports it; files of lost
or repeated attempts are never reported and never read.

Defined cases: a NULL text is empty and holds the end id only; repeated rows
are stored each; rows without an id come last; no documents, no files.
"""

from __future__ import annotations

import gc
import re
import struct
import uuid
from array import array
from collections.abc import Iterator
from functools import lru_cache
from os.path import commonprefix
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from blotter.llm.doc_ranges import RANGE, in_order, with_ranges
from blotter.llm.native_text import documents
from blotter.llm.shipping import held_until_needed, on_workers
from blotter.llm.suffix_array import _spread
from blotter.session import scratch_path

VOCABULARY = "word_bpe_49k.json"
END_ID = 2
FRAME_BYTES = 256 << 10
FILE_TEXT_BYTES = 8 << 20
LEVEL = 1
MEMO_CHUNKS = 700_000
#: Texts encoded together (a file's texts are bounded by their bytes); files
#: added up together.
TOGETHER = 4096
#: Files that one task reads back.
FILES_PER_TASK = 4
#: First character after the composed Latin letters.
LATIN = "\u0250"

#: Fixed values of the seekable format.
SKIPPABLE_INDEX, SKIPPABLE_TABLE, SEEKABLE = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1
FLAGS_WITH_CHECKSUMS = 0x80
_SKIP = struct.Struct("<II")
_ENTRY = struct.Struct("<III")
_FOOTER = struct.Struct("<IBI")


# --- tokenizing -----------------------------------------------------------


class ChunkTokenizer:
    """Whole texts through the tokenizers library, chunk by chunk.

    The vocabulary drops white space and no token spans it, so a text's ids
    are the ids of its chunks between ASCII white space.  Within a chunk, full
    stops and commas at its end after an ASCII letter or digit are tokens of
    their own, and Latin letters count as lower case, so the library sees
    each such core once.  Plain words go to the library's merges directly.
    The library looks for its added tokens in the raw text, letters' case
    included: a chunk that holds one in any case goes to it as it is.

    Texts are split and their distinct chunks numbered in Arrow; Python only
    sees each distinct chunk of a batch, and numpy puts the ids together.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.merges = self.library.model.tokenize
        self.added = sorted({t.content.lower() for t in self.library.get_added_tokens_decoder().values()})
        # how they all begin, up to the first letter: tells most chunks apart at once
        begin = commonprefix(self.added)
        self.mark = begin[:next((k for k, c in enumerate(begin) if c.isalpha()), len(begin))]
        self.spelled: dict[str, str] = {}
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _word(self, word: str) -> bytes:
        """Ids of a plain word, straight from the library's merges."""
        if not word.isascii():
            for letter in set(word).difference(self.spelled):
                self.spelled[letter] = self.library.pre_tokenizer.pre_tokenize_str(letter)[0][0]
            word = "".join(map(self.spelled.__getitem__, word))
        return array("I", [token.id for token in self.merges(word)]).tobytes()

    def _piece(self, piece: str) -> bytes:
        """Ids of a chunk without its tail.  Lower-case composed Latin letters
        pass the library's normalizer and splitter as they are."""
        ids = self.known.get(piece)
        if ids is None:
            plain = piece.isalpha() and (piece.isascii() or (
                max(piece) < LATIN and piece == piece.lower() and is_normalized("NFC", piece)))
            ids = self.known[piece] = self._word(piece) if plain else array("I", self.library.encode(piece, add_special_tokens=False).ids).tobytes()
        return ids

    def _learn(self, chunks: list[str]) -> list[bytes]:
        """Ids of chunks that are not known yet."""
        known, older, out = self.known, self.older, []
        for chunk in chunks:
            ids = older.get(chunk)
            if ids is None:
                tail = ""
                if self.mark in chunk and any(token in chunk.lower() for token in self.added):
                    ids = array("I", self.library.encode(chunk, add_special_tokens=False).ids).tobytes()
                elif chunk.isascii():
                    core = chunk.rstrip(".,")
                    tail = chunk[len(core):] if core and core[-1].isalnum() else ""
                    ids = self._piece((core if tail else chunk).lower())
                else:
                    core = chunk.rstrip(".,")
                    tail = chunk[len(core):] if core and core[-1].isascii() and core[-1].isalnum() else ""
                    core = core if tail else chunk
                    ids = self._piece(core.lower() if max(core) < LATIN else core)
                if tail:
                    ids += self._piece(tail)
            known[chunk] = ids
            out.append(ids)
        return out

    def encode_all(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and the place after each text's last."""
        lists = pc.ascii_split_whitespace(texts)
        coded = lists.flatten().dictionary_encode()
        chunks = coded.dictionary.to_pylist()
        if len(self.known) > MEMO_CHUNKS:
            self.older, self.known = self.known, {}
        found = list(map(self.known.get, chunks))
        new = [k for k, ids in enumerate(found) if ids is None]
        for k, ids in zip(new, self._learn([chunks[k] for k in new])):
            found[k] = ids
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        starts, index = np.cumsum(sizes) - sizes, coded.indices.to_numpy()
        counts = sizes[index]
        ids = np.frombuffer(b"".join(found), "<u4")[_spread(starts[index], counts)]
        after = np.concatenate(([0], np.cumsum(counts)))
        offsets = lists.offsets.to_numpy()
        return ids, after[offsets[1:] - offsets[0]]

    def encode(self, text: str) -> bytes:
        return self.encode_all(pa.array([text], pa.string()))[0].tobytes()


@lru_cache(maxsize=2)
def tokenizer(path: str) -> ChunkTokenizer:
    """One per worker process; it makes no cycles, so the collector of cycles
    is told to look more seldom."""
    gc.set_threshold(200_000, 50, 100)
    return ChunkTokenizer(path)


held_until_needed(tokenizer.cache_clear)


# --- files ----------------------------------------------------------------


class Writer:
    """Frames of ids into one open output stream."""

    def __init__(self, stream, frame_bytes: int = FRAME_BYTES):
        self.stream, self.frame_bytes = stream, frame_bytes
        self.compressor = zstandard.ZstdCompressor(level=LEVEL)
        self.held, self.size, self.entries = [], 0, []
        self.ids, self.ends, self.total = [], [], 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.total += len(ids) // 4
        self.ids.append(doc_id)
        self.ends.append(self.total)
        for at in range(0, len(ids), self.frame_bytes):
            part = ids[at:at + self.frame_bytes]
            self.held.append(part)
            self.size += len(part)
            if self.size >= self.frame_bytes:
                self._frame()

    def _frame(self) -> None:
        plain = b"".join(self.held)
        packed = self.compressor.compress(plain)
        self.stream.write(packed)
        self.entries.append(_ENTRY.pack(len(packed), len(plain), xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF))
        self.held, self.size = [], 0

    def close(self) -> None:
        if self.size:
            self._frame()
        known = np.array([i is not None for i in self.ids], "u1")
        plain = b"".join((struct.pack("<Q", len(self.ids)), known.tobytes(),
                          np.array([i or 0 for i in self.ids], "<i8").tobytes(), np.array(self.ends, "<i8").tobytes()))
        index = self.compressor.compress(plain)
        self.stream.write(_SKIP.pack(SKIPPABLE_INDEX, len(index)) + index)
        table = b"".join(self.entries) + _FOOTER.pack(len(self.entries), FLAGS_WITH_CHECKSUMS, SEEKABLE)
        self.stream.write(_SKIP.pack(SKIPPABLE_TABLE, len(table)) + table)


class Reader:
    """Random access to one file; ``stream`` can seek."""

    def __init__(self, stream):
        self.stream = stream
        self.unpack = zstandard.ZstdDecompressor()
        end = stream.seek(0, 2)
        stream.seek(end - _FOOTER.size)
        frames, flags, magic = _FOOTER.unpack(stream.read(_FOOTER.size))
        if magic != SEEKABLE or flags != FLAGS_WITH_CHECKSUMS:
            raise ValueError("not a token file: seek table missing")
        begin = end - _FOOTER.size - frames * _ENTRY.size
        stream.seek(begin)
        table = np.frombuffer(stream.read(frames * _ENTRY.size), "<u4").reshape(frames, 3).astype("i8")
        self.table = table
        self.offsets = np.concatenate(([0], np.cumsum(table[:, 0])))
        self.starts = np.concatenate(([0], np.cumsum(table[:, 1])))
        stream.seek(int(self.offsets[-1]))
        magic, size = _SKIP.unpack(stream.read(_SKIP.size))
        if magic != SKIPPABLE_INDEX:
            raise ValueError("not a token file: index missing")
        plain = self.unpack.decompress(stream.read(size))
        n = struct.unpack_from("<Q", plain)[0]
        known = np.frombuffer(plain, "u1", n, 8)
        ids = np.frombuffer(plain, "<i8", n, 8 + n)
        self.doc_ids = [int(i) if k else None for i, k in zip(ids, known)]
        self.ends = np.frombuffer(plain, "<i8", n, 8 + 9 * n)
        self.cached = (-1, b"")

    def frame(self, k: int) -> bytes:
        if self.cached[0] != k:
            self.stream.seek(int(self.offsets[k]))
            plain = self.unpack.decompress(self.stream.read(int(self.table[k, 0])))
            if xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF != self.table[k, 2]:
                raise ValueError(f"frame {k}: checksum differs")
            self.cached = (k, plain)
        return self.cached[1]

    def document(self, at: int) -> bytes:
        """Ids of the document in place ``at`` of the file."""
        low = int(self.ends[at - 1]) * 4 if at else 0
        high = int(self.ends[at]) * 4
        out, k = [], int(np.searchsorted(self.starts, low, "right")) - 1
        while low < high:
            stop = min(high, int(self.starts[k + 1]))
            begin = int(self.starts[k])
            out.append(self.frame(k)[low - begin:stop - begin])
            low, k = stop, k + 1
        return b"".join(out)


def _open(uri: str):
    """File system and folder of a path as Spark names it.  Arrow opens local
    folders, ``hdfs:``, ``gs:`` and ``s3:``; Spark's other names of S3 are the same."""
    return pafs.FileSystem.from_uri(re.sub(r"^s3[an]:", "s3:", uri))


def write_tokens(docs: DataFrame, path: str, out: str, end_id: int = END_ID) -> DataFrame:
    """Encode ``docs`` and write one file per range below ``out``.

    Returns the stored manifest: ``part, file, n_docs, n_ids, start``.
    """
    on_workers(docs.sparkSession)
    rows, _ = with_ranges(docs, FILE_TEXT_BYTES)

    def write(key, table):
        part, coder = key[0].as_py(), tokenizer(path)
        table = in_order(table)
        system, base = _open(out)
        system.create_dir(base, recursive=True)
        file = f"part-{part:06d}-{uuid.uuid4().hex}.zst"
        with system.open_output_stream(f"{base}/{file}", compression=None) as stream:
            writer = Writer(stream)
            end = end_id.to_bytes(4, "little")
            for batch in table.select(["doc_id", "text"]).to_batches(max_chunksize=TOGETHER):
                ids, after = coder.encode_all(batch["text"])
                begin = 0
                for doc_id, stop in zip(batch["doc_id"].to_pylist(), after.tolist()):
                    writer.add(doc_id, ids[begin:stop].tobytes() + end)
                    begin = stop
            writer.close()
        return pa.table({"part": pa.array([part], pa.int32()), "file": [file],
                         "n_docs": pa.array([table.num_rows], pa.int64()), "n_ids": pa.array([writer.total], pa.int64())})

    written = rows.groupBy(RANGE).applyInArrow(write, "part int, file string, n_docs long, n_ids long")
    # one row per file; stored, so that nothing is written again when it is read again
    written.write.parquet(f"{out}/manifest")
    return with_starts(docs.sparkSession.read.parquet(f"{out}/manifest"))


def with_starts(manifest: DataFrame, together: int = TOGETHER) -> DataFrame:
    """``start``: the ids in all files before.  Files are added up in blocks of
    ``together`` first, so that no task holds more than a block, or one row of
    each block."""
    blocked = manifest.withColumn("block", F.floor(F.col("part") / together))
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    begins = blocked.groupBy("block").agg(F.sum("n_ids").alias("n")).select(
        "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("begin"))
    inside = Window.partitionBy("block").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return blocked.join(begins, "block").withColumn(
        "start", F.col("begin") + F.coalesce(F.sum("n_ids").over(inside), F.lit(0))).drop("block", "begin")


def read_tokens(manifest: DataFrame, out: str, wanted=None, tasks: int | None = None) -> DataFrame:
    """``doc_id, start, ids`` of all documents, or of the ids in ``wanted``, in
    as many ``tasks`` (by default one for ``FILES_PER_TASK`` files)."""
    on_workers(manifest.sparkSession)
    wanted = None if wanted is None else set(wanted)
    if tasks is None:
        tasks = max(1, -(-(manifest.agg(F.max("part")).first()[0] or 0) // FILES_PER_TASK))

    def read(batches) -> Iterator[pa.RecordBatch]:
        system, base = _open(out)
        for batch in batches:
            for row in batch.to_pylist():
                with system.open_input_file(f"{base}/{row['file']}") as stream:
                    reader, held, size = Reader(stream), [], 0
                    for at, doc_id in enumerate(reader.doc_ids):
                        if wanted is not None and doc_id not in wanted:
                            continue
                        ids = reader.document(at)
                        held.append((doc_id, row["start"] + int(reader.ends[at]) - len(ids) // 4, ids))
                        size += len(ids)
                        if size >= 4 << 20:
                            yield _rows(held)
                            held, size = [], 0
                    if held:
                        yield _rows(held)

    # an explicit number: small as the manifest is, its tasks are not put together
    return manifest.select("file", "start", "part").repartition(tasks, "part").mapInArrow(
        read, "doc_id long, start long, ids binary")


def _rows(held: list[tuple]) -> pa.RecordBatch:
    ids, starts, data = zip(*held)
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, pa.int64()), pa.array(starts, pa.int64()), pa.array(data, pa.binary())], ["doc_id", "start", "ids"])



def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    out = scratch_path(spark, "tokens")
    manifest = write_tokens(documents(spark, sf_dir), public_tokenizers.path(VOCABULARY), out)
    return read_tokens(manifest, out).select(
        "doc_id", "start", F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"))
