r"""Substring dedup on words with fixed-block anchors.

Every word covered by a window of ``WINDOW`` consecutive words of one document
whose words also start earlier in the corpus is removed.  Words are runs of
``[^\x20\x09-\x0D]``; shards are ranges of ascending document ids, so of two
shards the lower one is earlier.

1. *Index and probe.*  The reference blocks are the non-overlapping runs of
   ``(WINDOW + 1) // 2`` words counted from each document's first word: every
   window holds a whole one.  The probes are all rolling windows of a block's
   length.  Shards exchange both as sorted hashes, cut to the bits that the
   corpus size needs and coded as differences; a bucket returns to each shard
   the blocks that some shard indexes and more than one shard probes.
2. *Extension.*  Around each hit, shared or within the shard, all windows
   containing it are compared as whole windows (128-bit BLAKE2 of their words,
   joined by one space); within a shard all but the first of equal windows are
   repeats, and the first ones around shared hits go to the digest's bucket,
   where the lowest shard's is the original.  Neighbouring repeated windows make
   up the maximal exact repeats.

Blocks and probes only choose what is compared: a word's hash is the XXH64 of its
bytes, and a chance collision costs a needless comparison.

A passage that many documents share is sent once per shard.

Defined cases: NULL text has no words; texts shorter than a window are kept
whole; repeated rows of one id count in order of their text, of equal rows
the first stays; rows without an id come last; kept words are joined by one
space.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from blotter.llm.doc_ranges import RANGE, with_ranges
from blotter.llm.native_text import documents
from blotter.llm.shipping import on_workers
from blotter.llm.suffix_array import Shard, _intervals, _table, joint_hashes
from blotter.llm.words import WordSpans

WINDOW = 20
SHARD_BYTES, BUCKET_TEXT = 4 << 20, 16 << 20
#: False hits are about one probe in 2 ** SPARE_BITS.
SPARE_BITS = 9

SEED = 8

_ANCHORS = "bucket int, shard int, kind int, n int, keys binary"
_SHARED = "shard int, hits binary"
_SENT = "bucket int, shard int, local binary, digests binary, places binary"
_FOUND = "shard int, local binary, places binary"


class Words:
    """The words of a shard: byte spans, hashes, and each text's share."""

    def __init__(self, table: pa.Table):
        self.part = Shard(table)
        self.spans = WordSpans(self.part.bytes, self.part.starts, self.part.ends)
        self.starts, self.sizes = self.spans.starts, self.spans.sizes
        self.first, self.last = self.spans.first, self.spans.last

    def hashes(self) -> np.ndarray:
        """The XXH64 of each word's bytes; equal words are hashed once."""
        codes, words = self.spans.coded()
        found = np.fromiter((xxhash.xxh64_intdigest(w, SEED) for w in words.to_pylist()), np.uint64, len(words))
        return found[codes]

    def digests(self, window: int, chosen: np.ndarray) -> np.ndarray:
        """128-bit BLAKE2 of the words, joined by one space, of the chosen
        windows (by their first word), as two integers each."""
        text, before = self.spans.text_of(np.arange(len(self.starts)))
        spans = zip(before[chosen].tolist(), (before[chosen + window] - 1).tolist())
        found = b"".join([hashlib.blake2b(text[a:b], digest_size=16).digest() for a, b in spans])
        return np.frombuffer(found, np.uint64).reshape(-1, 2)

    def room(self) -> np.ndarray:
        """Words from each word to the end of its text."""
        return np.repeat(self.last, self.last - self.first) - np.arange(len(self.starts))

    def place(self) -> np.ndarray:
        """Each word's place in its text."""
        return np.arange(len(self.starts)) - np.repeat(self.first, self.last - self.first)


def block_length(window: int) -> int:
    """Longest block of which every window holds a whole aligned one."""
    return (window + 1) // 2


def _pack(keys: np.ndarray) -> bytes:
    """Sorted distinct keys as differences, byte plane by byte plane."""
    steps = np.diff(keys, prepend=np.uint64(0)).astype("<u8")
    return np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T).tobytes()


def _unpack(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(blob, np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u8").ravel().astype(np.uint64))


def _keys(hashes: np.ndarray, bits: int) -> np.ndarray:
    return hashes >> np.uint64(64 - bits)


def _anchors(table: pa.Table, shard: int, window: int, buckets: int, bits: int) -> pa.Table:
    words, block = Words(table), block_length(window)
    grams = joint_hashes(words.hashes(), block)
    fits = words.room()[:len(grams)] >= block
    probes = _keys(grams[fits], bits)
    aligned = fits & (words.place()[:len(grams)] % block == 0)
    rows = []
    width = -(-(1 << bits) // buckets)
    for kind, keys in ((0, _keys(grams[aligned], bits)), (1, probes)):
        keys = np.unique(keys)
        cuts = np.searchsorted(keys, np.arange(buckets + 1, dtype=np.uint64) * np.uint64(width))
        for b in np.flatnonzero(np.diff(cuts)):
            part = keys[cuts[b]:cuts[b + 1]]
            rows.append((int(b), shard, kind, len(part), _pack(part)))
    return _table(rows, _ANCHORS)


def _shared(table: pa.Table) -> pa.Table:
    """Keys that a shard indexes and several shards probe, to all of those."""
    index, probes = [], []
    for row in table.select(["shard", "kind", "keys"]).to_pylist():
        (probes if row["kind"] else index).append((row["shard"], _unpack(row["keys"])))
    if not index or len(probes) < 2:
        return _table([], _SHARED)
    blocks = np.unique(np.concatenate([keys for _, keys in index]))
    out, kept = [], []
    for k, (_, keys) in enumerate(probes):  # only probes that meet a block are held
        at = np.searchsorted(blocks, keys)
        at[at == len(blocks)] = 0
        kept.append(at[blocks[at] == keys])
    times = np.bincount(np.concatenate(kept), minlength=len(blocks))
    for (shard, _), at in zip(probes, kept):
        found = blocks[at[times[at] > 1]]
        if len(found):
            out.append((shard, _pack(found)))
    return _table(out, _SHARED)


def _around(hit: np.ndarray, window: int, block: int, windows: int) -> np.ndarray:
    """Whether each window contains a hit block."""
    ahead = np.concatenate(([0], np.cumsum(hit)))
    stop = np.minimum(np.arange(windows) + window - block + 1, len(hit))
    return ahead[stop] > ahead[np.arange(windows)]


def _within(table: pa.Table, shared: pa.Table, shard: int, window: int, buckets: int, bits: int) -> pa.Table:
    words, block = Words(table), block_length(window)
    windows = max(0, len(words.starts) - window + 1)
    room = words.room()
    if not windows:
        return _table([], _SENT)
    hashes = words.hashes()
    grams = _keys(joint_hashes(hashes, block), bits)
    fits = room[:len(grams)] >= block
    lists = [_unpack(b) for b in shared["hits"].to_pylist()]
    elsewhere = fits & np.isin(grams, np.concatenate(lists)) if lists else np.zeros(len(grams), bool)
    # within the shard: blocks that also start at another place
    blocks = np.unique(grams[fits & (words.place()[:len(grams)] % block == 0)])
    again = np.zeros(len(grams), bool)
    own = np.flatnonzero(fits & np.isin(grams, blocks))
    _, back, times = np.unique(grams[own], return_inverse=True, return_counts=True)
    again[own[times[back] > 1]] = True
    whole = room[:windows] >= window
    asked = np.flatnonzero(whole & _around(elsewhere | again, window, block, windows))
    outside = _around(elsewhere, window, block, windows)[asked]
    digest = words.digests(window, asked)
    # equal windows side by side, in text order
    order = np.lexsort((digest[:, 1], digest[:, 0]))
    same = np.zeros(len(order), bool)
    same[1:] = (digest[order][1:] == digest[order][:-1]).all(axis=1)
    local = _intervals(np.sort(asked[order[same]]))
    rows = [(shard % buckets, shard, local.astype(np.int32).tobytes(), None, None)] if len(local) else []
    firsts = order[~same & outside[order]]  # still sorted by digest
    width = -(-(1 << 32) // buckets)
    cuts = np.searchsorted(digest[firsts, 0] >> np.uint64(32), np.arange(buckets + 1, dtype=np.uint64) * np.uint64(width))
    for b in np.flatnonzero(np.diff(cuts)):
        part = firsts[cuts[b]:cuts[b + 1]]
        rows.append((int(b), shard, None, digest[part].tobytes(), asked[part].astype(np.int32).tobytes()))
    return _table(rows, _SENT)


def _merged(table: pa.Table) -> pa.Table:
    """Places whose window a lower shard has, per shard."""
    rows = table.to_pylist()
    out = [(r["shard"], r["local"], None) for r in rows if r["local"] is not None]
    sent = sorted((r for r in rows if r["digests"] is not None), key=lambda r: r["shard"])
    if len(sent) > 1:
        digest = np.concatenate([np.frombuffer(r["digests"], np.uint64).reshape(-1, 2) for r in sent])
        place = np.concatenate([np.frombuffer(r["places"], np.int32) for r in sent])
        owner = np.repeat(np.arange(len(sent)), [len(r["places"]) // 4 for r in sent])
        order = np.lexsort((digest[:, 1], digest[:, 0]))  # equal ones in shard order
        digest = digest[order]
        later = np.zeros(len(order), bool)
        later[1:] = (digest[1:] == digest[:-1]).all(axis=1)
        found = order[later]
        owner, place = owner[found], place[found]
        for k in np.unique(owner):
            out.append((sent[k]["shard"], None, np.sort(place[owner == k]).tobytes()))
    return _table(out, _FOUND)


def _covered(words: Words, found: pa.Table, window: int) -> np.ndarray:
    """Words covered by repeated windows."""
    edge = np.zeros(len(words.starts) + 1, np.int32)
    for row in found.to_pylist():
        if row["local"] is not None:
            rows = np.frombuffer(row["local"], np.int32).reshape(-1, 2)
            np.add.at(edge, rows[:, 0], 1)
            np.add.at(edge, rows[:, 1] + window - 1, -1)
        if row["places"] is not None:
            places = np.frombuffer(row["places"], np.int32)
            np.add.at(edge, places, 1)
            np.add.at(edge, places + window, -1)
    return np.cumsum(edge[:-1]) > 0


def removals(docs: DataFrame, window: int = WINDOW, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Per row of ``docs``: its other columns as ``rest``, ``n_words``,
    ``n_removed`` and ``kept``, the kept words joined by one space."""
    on_workers(docs.sparkSession)
    rows, shards = with_ranges(docs, shard_bytes, keep=True)
    buckets = max(1, shards * shard_bytes // BUCKET_TEXT)
    # enough bits for the words there may be at most
    bits = min(56, max(24, (shards * shard_bytes // 2).bit_length() + SPARE_BITS))

    def anchors(key, table):
        return _anchors(table, key[0].as_py(), window, buckets, bits)

    def shared(table):
        return _shared(table)

    def within(key, table, hits):
        return _within(table, hits, key[0].as_py(), window, buckets, bits) if table.num_rows else _table([], _SENT)

    def merged(table):
        return _merged(table)

    def kept(table, found):
        words = Words(table)
        gone = _covered(words, found, window)
        text, before = words.spans.text_of(np.flatnonzero(~gone))
        stays = np.concatenate(([0], np.cumsum(~gone)))
        low, high = stays[words.first], stays[words.last]
        texts = [text[a:max(a, b - 1)].decode("utf-8", "replace") for a, b in zip(before[low].tolist(), before[high].tolist())]
        n = words.last - words.first
        return pa.table({"rest": words.part.table["rest"], "n_words": pa.array(n, pa.int64()),
                         "n_removed": pa.array(n - (high - low), pa.int64()), "kept": pa.array(texts, pa.string())})

    rest = rows.schema["rest"].dataType
    common = rows.groupBy(RANGE).applyInArrow(anchors, _ANCHORS).groupBy("bucket").applyInArrow(shared, _SHARED)
    sent = rows.groupBy(RANGE).cogroup(common.groupBy("shard")).applyInArrow(within, _SENT)
    found = sent.groupBy("bucket").applyInArrow(merged, _FOUND)
    return rows.groupBy(RANGE).cogroup(found.groupBy("shard")).applyInArrow(
        kept, StructType([StructField("rest", rest), StructField("n_words", LongType()), StructField("n_removed", LongType()),
                          StructField("kept", StringType())]))


def dedup(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` with the kept words as ``text``."""
    done = removals(docs, window)
    return done.select(*[F.col("kept").alias(c) if c == "text" else F.col(f"rest.`{c}`").alias(c) for c in docs.columns])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = removals(documents(spark, sf_dir).select("doc_id", "text"))
    return done.select("rest.doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


SQL = r"""
WITH w AS (
  SELECT row_number() OVER (ORDER BY doc_id) AS rid, doc_id,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
win AS (
  SELECT rid, i, array_to_string(ws[i:i + 19], ' ') AS g
  FROM (SELECT rid, ws, unnest(range(1, len(ws) - 18)) AS i FROM w WHERE len(ws) >= 20)),
rep AS (
  SELECT rid, i FROM (SELECT rid, i, row_number() OVER (PARTITION BY g ORDER BY rid, i) AS k FROM win) WHERE k > 1),
gone AS (SELECT DISTINCT rid, unnest(range(i, i + 20)) AS p FROM rep),
word AS (SELECT rid, unnest(range(1, len(ws) + 1)) AS p, unnest(ws) AS word FROM w),
kept AS (
  SELECT rid, string_agg(word, ' ' ORDER BY p) AS t, count(*) AS n
  FROM word ANTI JOIN gone USING (rid, p) GROUP BY rid)
SELECT doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (rid)
"""
