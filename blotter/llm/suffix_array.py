"""Exact substring dedup with per-shard suffix arrays.

Texts are UTF-8 bytes; every byte covered by a string of ``LENGTH`` bytes that
also starts earlier in the corpus is removed.  Shards are ranges of ascending
document ids, so of two shards the lower one is earlier.

1. *Anchors* (lossless pruning).  The least hash of all ``k``-grams in a
   window of ``LENGTH`` bytes depends on the window's content alone, so equal
   windows have the same anchor.  Shards exchange the distinct anchor hashes;
   text whose anchors occur once in the corpus cannot repeat and goes no
   further.  Windows with the same anchor are runs of neighbours.
2. *Suffix array per shard.*  What is left of a shard is sorted by suffix with
   Larsson-Sadakane refinement: by eight bytes, then only groups that are
   still tied, by the rank of the suffix where the known prefix ends, doubling
   until ``LENGTH`` bytes are sorted.
3. *Kasai common prefixes* of neighbours (permuted form: a value follows from
   the position before unless the neighbours part) cut the array into groups
   of equal windows; all but a group's first are repeats within the shard.
4. *Cross-shard merge.*  First occurrences whose anchors other shards have too
   are sent, as text of their runs, to the anchor's bucket.  There the
   shards' windows, sorted by a 64-bit digest (the suffix arrays are not used
   again), are merged pairwise, lower shards first, by binary search of each
   digest of the higher in the lower; hits are confirmed byte by byte, against
   every window of that digest, and are repeats.

A string that many documents share is sent once per shard, whatever its count.
The windows across its edges differ from document to document but share its
anchors.  Shards therefore also exchange how many runs an anchor has; windows of
a *crowded* anchor go alone, as 128-bit BLAKE2 digests, to the bucket of the
digest: different windows spread, equal ones still meet.

Defined cases: NULL text is empty; texts shorter than ``LENGTH`` are kept
whole; repeated rows of one id count in order of their text, of equal rows
the first stays; rows without an id come last; ``dedup`` keeps a character
unless all its bytes are removed, so its texts are valid.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from blotter.llm.doc_ranges import RANGE, in_order, with_ranges
from blotter.llm.native_text import documents
from blotter.llm.shipping import give_back_memory, on_workers

LENGTH = 100
SHARD_BYTES = 4 << 20
#: Text per exchange bucket.
BUCKET_TEXT = 16 << 20
#: Runs of an anchor from which its windows are dealt by their own digests;
#: a shard reports counts from ``NOTED`` on, smaller ones count as one run.
CROWD, NOTED = 4096, 8
#: Positions hashed at a time, so that the arrays stay in cache.
BLOCK = 1 << 16

_TABLE = np.random.default_rng(10).integers(1, 1 << 63, 256, np.uint64)
_ODD = np.random.default_rng(11).integers(1, 1 << 62, 16, np.uint64) * np.uint64(2) + np.uint64(1)


# --- the shard's text -------------------------------------------------------


class Shard:
    """The texts of a range, in order, as one buffer of bytes."""

    def __init__(self, table: pa.Table):
        self.table = in_order(table)
        texts = self.table["text"].combine_chunks()
        if isinstance(texts, pa.ChunkedArray):
            texts = pa.concat_arrays(texts.chunks) if texts.num_chunks else pa.array([], pa.string())
        data = texts.cast(pa.large_string())
        offsets = np.frombuffer(data.buffers()[1], np.int64, len(data) + 1, data.offset * 8) if len(data) else np.zeros(1, np.int64)
        raw = data.buffers()[2] if len(data) else None
        buffer = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
        self.ends = offsets[1:] - offsets[0]
        self.starts = offsets[:-1] - offsets[0]
        self.bytes = buffer[offsets[0]:offsets[-1]]
        if len(self.bytes) >= 1 << 31:  # only rows equal in id and text can come to this
            raise ValueError(f"{len(self.table)} rows of one range hold {len(self.bytes)} bytes")


def gram_hashes(data: np.ndarray, k: int) -> np.ndarray:
    """64-bit hashes of the ``k`` bytes from each position."""
    return joint_hashes(_TABLE[data], k)


def joint_hashes(h: np.ndarray, k: int, odd: np.ndarray = _ODD) -> np.ndarray:
    """64-bit hashes of ``k`` values from each position, by doubling."""
    have, out, done, level = 1, None, 0, 0
    while True:
        if k & have:
            out = h if out is None else out[:max(0, len(h) - done)] * odd[8 + level] + h[done:]
            done += have
        if done == k:
            break
        h = h[:-have] * odd[level] + h[have:] if len(h) > have else h[:0]
        have, level = 2 * have, level + 1
    out = (out ^ (out >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return out ^ (out >> np.uint64(29))


def _slid_min(x: np.ndarray, w: int) -> np.ndarray:
    have = 1
    while 2 * have <= w:
        x = np.minimum(x[:-have], x[have:])
        have *= 2
    return np.minimum(x[:len(x) - (w - have)], x[w - have:]) if w > have else x


def gram_length(length: int) -> int:
    """The largest power of two up to a third of the window."""
    return 1 << max(0, (max(3, length) // 3).bit_length() - 1)


def runs(data: np.ndarray, ends: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Runs of neighbouring windows with one anchor: first window, number of
    windows, anchor position and anchor hash.  Windows end within a text."""
    n, k = len(data), gram_length(length)
    none = np.zeros(0, np.int64)
    if n < length:
        return none, none, none, none.astype(np.uint64)
    w, low = length - k + 1, np.uint64(0xFFFFFFFF)
    anchors, hashes = np.empty(n - length + 1, np.int64), np.empty(n - k + 1, np.uint64)
    for at in range(0, n - length + 1, BLOCK):
        stop = min(n - length + 1, at + BLOCK)
        h = gram_hashes(data[at:stop + length - 1], k)
        hashes[at:at + len(h)] = h
        # the least by the high bits, the leftmost among equals: the position
        # rides in the low bits, as many in every shard, so that shards agree
        keyed = (h & ~low) | (np.arange(at, at + len(h), dtype=np.uint64))
        anchors[at:stop] = _slid_min(keyed, w) & low
    valid = np.ones(n - length + 1, bool)
    for end in ends[:-1]:  # windows that would cross into the next text
        valid[max(0, end - length + 1):end] = False
    starts = np.flatnonzero(valid)
    if not len(starts):
        return none, none, none, none.astype(np.uint64)
    a = anchors[starts]
    first = np.flatnonzero(np.concatenate(([True], (a[1:] != a[:-1]) | (starts[1:] != starts[:-1] + 1))))
    count = np.diff(np.concatenate((first, [len(starts)])))
    return starts[first], count, a[first], hashes[a[first]]


# --- suffix array of a shard ------------------------------------------------


def suffix_array(text: np.ndarray, left: np.ndarray, length: int) -> np.ndarray:
    """Positions with at least ``length`` bytes ``left`` in suffix order, by
    their first ``length`` bytes; equal ones in text order.

    Larsson-Sadakane: a suffix's rank is the place of its group's first; tied
    groups are refined by the ranks ``h`` further on, alone ones are done.
    """
    h = min(8, length)
    key = text.astype(np.uint64)
    have = 1
    while 2 * have <= h:
        key = (key[:-have] << np.uint64(8 * have)) | key[have:] if len(key) > have else key[:0]
        have *= 2
    h = have
    known = np.flatnonzero(left >= h)
    key = key[known]
    order = np.argsort(key)
    array, key = known[order], key[order]
    rank = np.zeros(len(text), np.int64)
    slots = np.arange(len(array))
    while True:
        first = np.concatenate(([True], key[1:] != key[:-1])) if len(key) else np.zeros(0, bool)
        begin = np.maximum.accumulate(np.where(first, slots, 0)) if len(key) else slots
        rank[array[slots]] = begin
        if h >= length:
            break
        alone = first & np.concatenate((first[1:], [True])) if len(key) else first
        step = min(h, length - h)
        slots = slots[~alone]
        if not len(slots):
            break
        here = array[slots]
        onward = here + step
        reaches = left[here] >= h + step
        second = np.where(reaches, rank[np.minimum(onward, len(rank) - 1)] + 1, 0)
        key = (rank[here] << 32) | second
        order = np.argsort(key)
        array[slots], key = here[order], key[order]
        h += step
    whole = array[left[array] >= length]
    return np.sort((rank[whole] << 32) | whole) & 0xFFFFFFFF


def common_prefixes(text: np.ndarray, left: np.ndarray, array: np.ndarray) -> np.ndarray:
    """Common prefix of each suffix of ``array`` with the one before it.

    Kasai's order: taken by text position, the value is one less than at the
    position before where both neighbours are one further on; only the other
    positions are compared, eight bytes at a time.
    """
    m = len(array)
    out = np.zeros(m, np.int64)
    if m < 2:
        return out
    before = np.full(len(text) + 1, -2, np.int64)
    before[array[1:]] = array[:-1]
    before[array[0]] = -2
    at = np.sort(array)
    beside = before[at]
    follows = np.zeros(m, bool)
    follows[1:] = ((at[1:] == at[:-1] + 1) & (beside[1:] == beside[:-1] + 1) & (beside[:-1] >= 0)
                   & (left[at[1:]] == left[at[:-1]] - 1)
                   & (left[np.maximum(beside[1:], 0)] == left[np.maximum(beside[:-1], 0)] - 1))
    follows[1:] &= text[at[:-1]] == text[np.maximum(beside[:-1], 0)]
    heads = np.flatnonzero(~follows & (beside >= 0))
    found = np.zeros(m, np.int64)
    i, j = at[heads], beside[heads]
    most = np.minimum(left[i], left[j])
    padded = np.concatenate((text, np.zeros(8, np.uint8)))
    wide = np.lib.stride_tricks.sliding_window_view(padded, 8)
    going, size = np.arange(len(heads)), np.zeros(len(heads), np.int64)
    while len(going):
        a, b = i[going] + size[going], j[going] + size[going]
        differ = wide[np.minimum(a, len(text))] != wide[np.minimum(b, len(text))]
        same = np.where(differ.any(axis=1), differ.argmax(axis=1), 8)
        size[going] += same
        going = going[(same == 8) & (size[going] < most[going])]
    found[heads] = np.minimum(size, most)
    last = np.maximum.accumulate(np.where(follows, 0, np.arange(m)))
    value = np.maximum(found[last] - (at - at[last]), 0)
    place = np.empty(len(text), np.int64)
    place[at] = value
    out[1:] = place[array[1:]]
    return out


def repeats(text: np.ndarray, left: np.ndarray, length: int) -> np.ndarray:
    """Positions whose ``length`` bytes also start earlier in ``text``."""
    array = suffix_array(text, left, length)
    if len(array) < 2:
        return array[:0]
    joined = common_prefixes(text, left, array) >= length
    # equal windows stand in text order, so the first of a group is earliest
    return array[joined]


def _spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """All of ``start .. start + count - 1``."""
    if not len(starts):
        return np.zeros(0, np.int64)
    total = int(counts.sum())
    ahead = np.cumsum(counts) - counts
    return np.arange(total) - np.repeat(ahead - starts, counts)


def _intervals(positions: np.ndarray) -> np.ndarray:
    """Sorted positions as (begin, end) rows."""
    if not len(positions):
        return np.zeros((0, 2), np.int64)
    cut = np.flatnonzero(np.diff(positions) != 1)
    begin = positions[np.concatenate(([0], cut + 1))]
    end = positions[np.concatenate((cut, [len(positions) - 1]))] + 1
    return np.stack((begin, end), axis=1)


# --- steps on the cluster -----------------------------------------------------

_ANCHORS = "bucket int, shard int, hashes binary, noted binary"
_SHARED = "shard int, hashes binary, crowded binary"
_SENT = "bucket int, shard int, local binary, hashes binary, shape binary, data binary, digests binary, places binary"
_FOUND = "shard int, found binary"


def _bucket_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return (hashes >> np.uint64(40)).astype(np.int64) % buckets


def _anchors(table: pa.Table, shard: int, length: int, buckets: int) -> pa.Table:
    part = Shard(table)
    hashes, times = np.unique(runs(part.bytes, part.ends, length)[3], return_counts=True)
    bucket = _bucket_of(hashes, buckets)
    order = np.argsort(bucket, kind="stable")
    cuts = np.concatenate(([0], np.flatnonzero(np.diff(bucket[order])) + 1, [len(order)])) if len(order) else [0]
    rows = []
    for a, b in zip(cuts[:-1], cuts[1:]):
        pick = order[a:b]
        noted = np.flatnonzero(times[pick] >= NOTED)
        counts = np.stack((noted, times[pick[noted]]), axis=1).astype(np.int32)
        rows.append((int(bucket[pick[0]]), shard, hashes[pick].tobytes(), counts.tobytes()))
    return _table(rows, _ANCHORS)


def _shared(table: pa.Table, crowd: int) -> pa.Table:
    """Per shard the hashes of the bucket that another shard has too, and
    those of them with more than ``crowd`` runs in all shards."""
    shards = table["shard"].to_pylist()
    lists = [np.frombuffer(b, np.uint64) for b in table["hashes"].to_pylist()]
    every = np.concatenate(lists)
    owner = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
    times = np.ones(len(every), np.int64)
    begin = 0
    for x, b in zip(lists, table["noted"].to_pylist()):
        place, count = np.frombuffer(b, np.int32).reshape(-1, 2).T
        times[begin + place] = count
        begin += len(x)
    order = np.argsort(every)
    every, owner, times = every[order], owner[order], times[order]
    heads = np.flatnonzero(np.concatenate(([True], every[1:] != every[:-1]))) if len(every) else np.zeros(0, np.int64)
    hot = every[heads[np.add.reduceat(times, heads) > crowd]] if len(every) else every
    twin = np.zeros(len(every), bool)
    same = every[1:] == every[:-1]
    twin[1:] |= same
    twin[:-1] |= same
    every, owner = every[twin], owner[twin]
    order = np.argsort(owner, kind="stable")
    every, owner = every[order], owner[order]
    cuts = np.searchsorted(owner, np.arange(len(lists) + 1))
    mine = [every[a:b] for a, b in zip(cuts[:-1], cuts[1:])]
    return _table([(shard, x.tobytes(), x[np.isin(x, hot)].tobytes()) for shard, x in zip(shards, mine) if len(x)], _SHARED)


def _within(table: pa.Table, shared: pa.Table, shard: int, length: int, buckets: int) -> pa.Table:
    """Repeats within the shard, and the runs that other shards must see; of
    crowded anchors the windows' digests."""
    part = Shard(table)
    data = part.bytes
    start, count, anchor, hashes = runs(data, part.ends, length)
    lists = [np.frombuffer(b, np.uint64) for b in shared["hashes"].to_pylist()]
    elsewhere = np.isin(hashes, np.concatenate(lists)) if lists else np.zeros(len(hashes), bool)
    _, back, times = np.unique(hashes, return_inverse=True, return_counts=True)
    asked = elsewhere | (times[back] > 1) if len(hashes) else elsewhere
    # the text the asked windows cover, joined; `left` counts to its breaks
    edge = np.zeros(len(data) + 1, np.int32)
    np.add.at(edge, start[asked], 1)
    np.add.at(edge, start[asked] + count[asked] + length - 1, -1)
    covered = np.flatnonzero(np.cumsum(edge[:-1]) > 0)
    again = np.zeros(len(data), bool)
    if len(covered):
        breaks = np.zeros(len(covered), bool)
        breaks[0] = True
        breaks[1:] = covered[1:] != covered[:-1] + 1
        edges = np.searchsorted(covered, part.starts)
        edges = edges[edges < len(covered)]
        breaks[edges] = True
        begins = np.flatnonzero(breaks)
        ends = np.concatenate((begins[1:], [len(covered)]))
        left = np.repeat(ends, ends - begins) - np.arange(len(covered))
        again[covered[repeats(data[covered], left, length)]] = True
    # of the runs that other shards have: the windows that are first here
    windows = _spread(start[elsewhere], count[elsewhere])
    run = np.repeat(np.flatnonzero(elsewhere), count[elsewhere])
    kept = ~again[windows]
    windows, run = windows[kept], run[kept]
    local = _intervals(np.flatnonzero(again))
    rows = [(shard % buckets, shard, local.astype(np.int32).tobytes(), *[None] * 5)] if len(local) else []
    crowded = np.concatenate([np.frombuffer(b, np.uint64) for b in shared["crowded"].to_pylist()]) if lists else hashes[:0]
    alone = np.isin(hashes, crowded)[run]
    if alone.any():
        rows.extend(_digests(data, windows[alone], shard, length, buckets))
        windows, run = windows[~alone], run[~alone]
    if len(windows):
        head = np.flatnonzero(np.concatenate(([True], (run[1:] != run[:-1]) | (windows[1:] != windows[:-1] + 1))))
        size = np.diff(np.concatenate((head, [len(windows)])))
        first, of = windows[head], run[head]
        bucket = _bucket_of(hashes[of], buckets)
        order = np.argsort(bucket, kind="stable")
        cuts = np.concatenate(([0], np.flatnonzero(np.diff(bucket[order])) + 1, [len(order)]))
        for a, b in zip(cuts[:-1], cuts[1:]):
            pick = order[a:b]
            shape = np.stack((first[pick], size[pick], anchor[of[pick]] - first[pick]), axis=1).astype(np.int32)
            text = data[_spread(first[pick], size[pick] + length - 1)]
            rows.append((int(bucket[pick[0]]), shard, None, hashes[of[pick]].tobytes(), shape.tobytes(), text.tobytes(), None, None))
    return _table(rows, _SENT)


def _digests(data: np.ndarray, windows: np.ndarray, shard: int, length: int, buckets: int) -> list[tuple]:
    """Rows of the windows' digests, each in the bucket of the digest."""
    text = data.tobytes()
    found = b"".join([hashlib.blake2b(text[w:w + length], digest_size=16).digest() for w in windows.tolist()])
    digest = np.frombuffer(found, np.uint64).reshape(-1, 2)
    bucket = _bucket_of(digest[:, 0], buckets)
    order = np.argsort(bucket, kind="stable")
    cuts = np.concatenate(([0], np.flatnonzero(np.diff(bucket[order])) + 1, [len(order)]))
    return [(int(bucket[order[a]]), shard, *[None] * 4, digest[order[a:b]].tobytes(), windows[order[a:b]].astype(np.int32).tobytes())
            for a, b in zip(cuts[:-1], cuts[1:])]


def _merged(table: pa.Table, length: int) -> pa.Table:
    """Repeats across shards among the runs sent to a bucket, and the repeats
    within shards that travel along."""
    out = [(r["shard"], r["local"]) for r in table.select(["shard", "local"]).to_pylist() if r["local"] is not None]
    single = [r for r in table.select(["shard", "digests", "places"]).to_pylist() if r["digests"] is not None]
    if single:
        digest = np.concatenate([np.frombuffer(r["digests"], np.uint64).reshape(-1, 2) for r in single])
        place = np.concatenate([np.frombuffer(r["places"], np.int32) for r in single]).astype(np.int64)
        shard = np.repeat([r["shard"] for r in single], [len(r["places"]) // 4 for r in single])
        single = None
        # a shard sends a window once, so all but the lowest shard's are repeats
        order = np.lexsort((shard, digest[:, 1], digest[:, 0]))
        again = order[1:][(digest[order[1:]] == digest[order[:-1]]).all(axis=1)]
        for s in np.unique(shard[again]):
            out.append((int(s), _intervals(np.sort(place[again[shard[again] == s]])).astype(np.int32).tobytes()))
    sent = sorted((r for r in table.select(["shard", "hashes", "shape", "data"]).to_pylist() if r["data"] is not None), key=lambda r: r["shard"])
    if sent:
        shape = [np.frombuffer(r["shape"], np.int32).reshape(-1, 3).astype(np.int64) for r in sent]
        shard = np.repeat([r["shard"] for r in sent], [len(s) for s in shape])
        shape = np.concatenate(shape)
        anchor = np.concatenate([np.frombuffer(r["hashes"], np.uint64) for r in sent])
        text = b"".join([r["data"] for r in sent])
        sent = None
        for s, found in _cross(anchor, shard, shape, text, length).items():
            out.append((s, found.astype(np.int32).tobytes()))
    return _table(out, _FOUND)


def _cross(anchor, shard, shape, text: bytes, length: int) -> dict[int, np.ndarray]:
    """Intervals of repeated windows per shard; runs come in shard order."""
    start, count, offset = shape.T
    size = count + length - 1
    at = np.cumsum(size) - size
    found: dict[int, list] = {}
    # runs equal as a whole need no look at their windows
    seen: set = set()
    fresh = np.zeros(len(count), bool)
    for k, (a, b, o) in enumerate(zip(at.tolist(), (at + size).tolist(), offset.tolist())):
        key = (o, text[a:b])
        if key in seen:
            found.setdefault(int(shard[k]), []).append((start[k], start[k] + count[k]))
        else:
            seen.add(key)
            fresh[k] = True
    seen.clear()
    fresh = np.flatnonzero(fresh)
    _, back, times = np.unique(anchor[fresh], return_inverse=True, return_counts=True)
    fresh = fresh[times[back] > 1]
    # the rest window by window, some anchors at a time
    fresh = fresh[np.argsort(anchor[fresh], kind="stable")]
    total = np.cumsum(size[fresh])
    lot = total // (8 << 20)
    changes = np.concatenate(([True], anchor[fresh][1:] != anchor[fresh][:-1])) if len(fresh) else np.zeros(0, bool)
    lot = lot[np.maximum.accumulate(np.where(changes, np.arange(len(fresh)), 0))] if len(fresh) else lot
    data = np.frombuffer(text, np.uint8)
    for which in np.unique(lot):
        some = fresh[lot == which]
        some = some[np.argsort(shard[some], kind="stable")]
        joined = data[_spread(at[some], size[some])]
        begin = np.cumsum(size[some]) - size[some]
        window = _spread(begin, count[some])
        position = _spread(start[some], count[some])
        owner = np.repeat(shard[some], count[some])
        repeated = merge_shards(joined, window, owner, length)
        for s in np.unique(owner[repeated]):
            mine = np.sort(position[repeated & (owner == s)])
            found.setdefault(int(s), []).extend(map(tuple, _intervals(mine)))
    return {s: np.array(rows, np.int64).reshape(-1, 2) for s, rows in found.items()}


def merge_shards(text: np.ndarray, window: np.ndarray, owner: np.ndarray, length: int) -> np.ndarray:
    """Which windows occur in a lower shard.  ``owner`` ascends.

    Each shard's windows are sorted by digest; neighbouring sorted runs are
    merged pairwise, the higher searched in the lower.
    """
    digest = gram_hashes(text, length)[window]
    repeated = np.zeros(len(window), bool)
    cuts = np.concatenate(([0], np.flatnonzero(np.diff(owner)) + 1, [len(owner)]))
    arrays = []
    for a, b in zip(cuts[:-1], cuts[1:]):
        order = a + np.argsort(digest[a:b])
        arrays.append((digest[order], order))
    span = np.arange(length)
    while len(arrays) > 1:
        merged = []
        for k in range(0, len(arrays) - 1, 2):
            (low, low_ids), (high, high_ids) = arrays[k], arrays[k + 1]
            at = np.searchsorted(low, high)
            hit = at < len(low)
            hit[hit] = low[at[hit]] == high[hit]
            for part in np.array_split(np.flatnonzero(hit), 1 + hit.sum() // 50_000):
                a, b = window[low_ids[at[part]]], window[high_ids[part]]
                for h in part[(text[a[:, None] + span] != text[b[:, None] + span]).any(axis=1)]:
                    # another window has the digest: look at the others of it
                    rest = low_ids[at[h] + 1:np.searchsorted(low, high[h], "right")]
                    mine = text[window[high_ids[h]] + span]
                    hit[h] = any((text[window[i] + span] == mine).all() for i in rest)
            repeated[high_ids[hit]] = True
            new = ~hit
            merged.append((np.insert(low, at[new], high[new]), np.insert(low_ids, at[new], high_ids[new])))
        if len(arrays) % 2:
            merged.append(arrays[-1])
        arrays = merged
    return repeated


def _removed(part: Shard, found: pa.Table, length: int) -> np.ndarray:
    """Bytes of the shard covered by repeated windows."""
    edge = np.zeros(len(part.bytes) + 1, np.int32)
    for blob in found["found"].to_pylist():
        rows = np.frombuffer(blob, np.int32).reshape(-1, 2)
        np.add.at(edge, rows[:, 0], 1)
        np.add.at(edge, rows[:, 1] + length - 1, -1)
    return np.cumsum(edge[:-1]) > 0


_SPARK_TO_ARROW = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "string": pa.string()}


def _table(rows: list[tuple], schema: str) -> pa.Table:
    fields = [f.split() for f in schema.split(", ")]
    columns = list(zip(*rows)) if rows else [()] * len(fields)
    return pa.table({name: pa.array(column, _SPARK_TO_ARROW[kind]) for (name, kind), column in zip(fields, columns)})


def _text_kept(data: bytes, gone: np.ndarray) -> str:
    """The text without characters all of whose bytes are removed."""
    if not gone.any():
        return data.decode("utf-8", "replace")
    raw = np.frombuffer(data, np.uint8)
    lead = np.flatnonzero((raw & 0xC0) != 0x80)
    whole = np.minimum.reduceat(gone, lead)
    drop = np.repeat(whole, np.diff(np.concatenate((lead, [len(raw)]))))
    return raw[~drop].tobytes().decode("utf-8", "replace")


def removals(docs: DataFrame, length: int = LENGTH, shard_bytes: int = SHARD_BYTES, as_text: bool = False) -> DataFrame:
    """Per row of ``docs``: its other columns as ``rest``, ``n_bytes``,
    ``n_removed``, ``n_spans`` and ``kept``: bytes, or text ``as_text``."""
    on_workers(docs.sparkSession)
    rows, shards = with_ranges(docs, shard_bytes, keep=True)
    buckets = max(1, shards * shard_bytes // BUCKET_TEXT)
    crowd = CROWD

    def anchors(key, table):
        return _anchors(table, key[0].as_py(), length, buckets)

    def shared(table):
        return _shared(table, crowd)

    def within(key, table, hashes):
        if not table.num_rows:
            return _table([], _SENT)
        found = _within(table, hashes, key[0].as_py(), length, buckets)
        give_back_memory()
        return found

    def merged(table):
        found = _merged(table, length)
        give_back_memory()
        return found

    rest = rows.schema["rest"].dataType

    def kept(table, found):
        part = Shard(table)
        gone = _removed(part, found, length)
        first = gone & ~np.concatenate(([False], gone[:-1]))
        inner = part.starts[(part.starts > 0) & (part.starts < len(gone))]
        first[inner] = gone[inner]
        ahead, spans = np.concatenate(([0], np.cumsum(gone))), np.concatenate(([0], np.cumsum(first)))
        result = []
        for a, b in zip(part.starts.tolist(), part.ends.tolist()):
            cut, data = gone[a:b], part.bytes[a:b]
            result.append(_text_kept(data.tobytes(), cut) if as_text else data[~cut].tobytes())
        return pa.table({
            "rest": part.table["rest"], "n_bytes": pa.array(part.ends - part.starts, pa.int64()),
            "n_removed": pa.array(ahead[part.ends] - ahead[part.starts], pa.int64()),
            "n_spans": pa.array(spans[part.ends] - spans[part.starts], pa.int64()),
            "kept": pa.array(result, pa.string() if as_text else pa.binary())})

    common = rows.groupBy(RANGE).applyInArrow(anchors, _ANCHORS).groupBy("bucket").applyInArrow(shared, _SHARED)
    sent = rows.groupBy(RANGE).cogroup(common.groupBy("shard")).applyInArrow(within, _SENT)
    found = sent.groupBy("bucket").applyInArrow(merged, _FOUND)
    return rows.groupBy(RANGE).cogroup(found.groupBy("shard")).applyInArrow(
        kept, StructType([StructField("rest", rest)] + [StructField(n, LongType()) for n in ("n_bytes", "n_removed", "n_spans")]
                         + [StructField("kept", StringType() if as_text else BinaryType())]))


def dedup(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``docs`` with repeated bytes cut from ``text``."""
    done = removals(docs, length, as_text=True)
    return done.select(*[F.col("kept").alias(c) if c == "text" else F.col(f"rest.`{c}`").alias(c) for c in docs.columns])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = removals(documents(spark, sf_dir).select("doc_id", "text"))
    return done.select("rest.doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
