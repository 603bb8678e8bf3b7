r"""Periodic runs of words by difference-cover longest common extensions.

A run of a text is a stretch of consecutive words with smallest period ``q``
(words ``q`` apart are the same) and at least ``max(LEAST, TIMES * q)`` words
that no neighbouring word extends.

*Harmonic grid.*  A run of period ``q`` holds at least ``(TIMES - 1) * q``
neighbouring places whose word comes again ``q`` further on, so one of the
places ``0, 3q, 6q, ...`` is among them.  For every period the grid's places
are compared with those ``q`` further on: ``n / 3q`` comparisons, in all in
proportion to ``n log n``.  Places that agree are extended both ways by
longest common extensions, which gives the maximal stretch of that period.

*Difference cover.*  Places whose number modulo ``STEP ** 2`` lies in the cover
``{0 .. STEP-1} + {STEP-1, 2*STEP-1, ...}`` are sampled; for any two places there is a
shift below ``STEP ** 2`` that makes both sampled.  Only sampled suffixes are sorted
(Larsson-Sadakane refinement of tied groups: word by word up to a block, then by
the ranks a block, two blocks, ... further on), common prefixes of neighbours
go into a sparse table, and an extension compares the few words up to the shift
and then asks the table for a range minimum.  Extensions to the left do the
same on the reversed words.  Texts all of whose extensions end within those few
words need no sorted suffixes, and none are sorted for them.

A stretch found for a multiple of its smallest period has the same ends (by
Fine and Wilf), so of stretches with the same ends the smallest period stays.

Each text is worked on whole; texts of about ``BATCH_BYTES`` are worked on
side by side, set apart by a number of their own.  A worker's memory grows with
the longest text.

Defined cases: a NULL or blank text has no words and no runs; repeated rows are
each judged; rows without an id too; an empty table gives no rows; other columns
do not matter.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blotter.llm.native_text import documents
from blotter.llm.shipping import on_workers
from blotter.llm.words import WordSpans, joined, lots

LEAST, TIMES = 6, 4
STEP = 8
#: Bytes of the texts worked on side by side, and pairs extended at a time.
BATCH_BYTES, LOT = 2 << 20, 1 << 17


def cover(step: int = STEP) -> np.ndarray:
    """Residues modulo ``step ** 2`` whose differences give every residue."""
    return np.unique(np.concatenate((np.arange(step), np.arange(1, step + 1) * step - 1)))


def _shifts(step: int) -> np.ndarray:
    """``[i, d]``: the least shift that makes places ``i`` and ``i + d`` sampled."""
    v = step * step
    sampled = np.zeros(2 * v, bool)
    sampled[cover(step)] = sampled[v + cover(step)] = True
    place, apart, shift = np.ogrid[:v, :v, :v]
    both = sampled[(place + shift) % v] & sampled[(place + apart + shift) % v]
    return both.argmax(axis=2)


_SHIFTS: dict[int, np.ndarray] = {}


def shifts(step: int) -> np.ndarray:
    if step not in _SHIFTS:
        _SHIFTS[step] = _shifts(step)
    return _SHIFTS[step]


class Extensions:
    """Longest common extensions to the right in ``codes``.

    A code below zero stands once only, so no extension goes past it.
    """

    def __init__(self, codes: np.ndarray, step: int = STEP):
        self.step, self.block = step, step * step
        # places behind the end differ from all others
        least = min(0, int(codes.min(initial=0)))
        self.codes = np.concatenate((codes, least - 1 - np.arange(2 * self.block))).astype(np.int64)
        self.array = None

    def few(self, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Words compared until a difference or the shift, and whether the
        shift was reached without one."""
        shift = shifts(self.step)[i % self.block, (j - i) % self.block]
        same = np.zeros(len(i), np.int64)
        going = np.flatnonzero(shift > 0)
        k = 0
        while len(going):
            going = going[self.codes[i[going] + k] == self.codes[j[going] + k]]
            k += 1
            same[going] = k
            going = going[shift[going] > k]
        return same, same == shift

    def _sort(self) -> None:
        codes, block = self.codes, self.block
        inside = np.zeros(block, bool)
        inside[cover(self.step)] = True
        places = np.flatnonzero(inside[np.arange(len(codes) - block) % block])
        m = len(places)
        number = np.zeros(len(codes), np.int64)
        number[places] = np.arange(m)
        order, rank = np.arange(m), np.zeros(m, np.int64)
        slots = np.arange(m)  # places in the order that are still tied
        levels = []
        length = 0
        while len(slots):
            here = order[slots]
            if length < block:
                second = codes[places[here] + length]
                second = second - second.min()
                length += 1
            else:
                onward = np.minimum(places[here] + length, places[-1])
                second = rank[number[onward]]
                length *= 2
            key = np.lexsort((second, rank[here]))
            order[slots] = here = here[key]
            group, second = rank[here], second[key]
            first = np.ones(len(slots), bool)
            first[1:] = (group[1:] != group[:-1]) | (second[1:] != second[:-1])
            rank[here] = np.maximum.accumulate(np.where(first, slots, 0))
            if length >= block:
                levels.append((length, rank.copy()))
            alone = first & np.append(first[1:], True)
            slots = slots[~alone]
        self.places, self.array, self.number = places, order, number
        self.rank = np.empty(m, np.int64)
        self.rank[order] = np.arange(m)
        self.table = self._sparse(self._prefixes(levels))

    def _prefixes(self, levels: list[tuple[int, np.ndarray]]) -> np.ndarray:
        """Common prefix of each sampled suffix with the one before it: whole
        tied lengths from the longest down, then word by word."""
        i, j = self.places[self.array[:-1]].copy(), self.places[self.array[1:]].copy()
        size = np.zeros(len(i), np.int64)
        last = self.places[-1]
        for length, rank in reversed(levels):
            inside = (i <= last) & (j <= last)
            same = inside & (rank[self.number[np.minimum(i, last)]] == rank[self.number[np.minimum(j, last)]])
            step = np.where(same, length, 0)
            i, j, size = i + step, j + step, size + step
        going = np.arange(len(i))
        while len(going):
            going = going[self.codes[i[going]] == self.codes[j[going]]]
            i[going] += 1
            j[going] += 1
            size[going] += 1
        return np.concatenate(([0], size))

    @staticmethod
    def _sparse(values: np.ndarray) -> list[np.ndarray]:
        """Minima of 1, 2, 4, ... neighbours."""
        table, have = [values.astype(np.int32)], 1
        while 2 * have <= len(values):
            table.append(np.minimum(table[-1][:-have], table[-1][have:]))
            have *= 2
        return table

    def __call__(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Common words from places ``i`` and ``j`` on, ``i < j``."""
        same, onward = self.few(i, j)
        ask = np.flatnonzero(onward)
        if len(ask):
            if self.array is None:
                self._sort()
            a = self.rank[self.number[i[ask] + same[ask]]]
            b = self.rank[self.number[j[ask] + same[ask]]]
            low, high = np.minimum(a, b) + 1, np.maximum(a, b)
            level = np.frexp((high - low + 1).astype(np.float64))[1] - 1
            least = np.empty(len(ask), np.int64)
            for k in np.unique(level):
                pick = level == k
                row = self.table[k]
                least[pick] = np.minimum(row[low[pick]], row[high[pick] - (1 << int(k)) + 1])
            same[ask] += least
        return same


def _grid(codes: np.ndarray, sizes: np.ndarray, of: np.ndarray):
    """Pairs ``(place, period)`` of the harmonic grids that agree, in lots.

    Texts stand longest first, each followed by a code of its own."""
    ends = np.cumsum(sizes + 1)
    most = int(sizes[0]) // TIMES if len(sizes) else 0
    # texts long enough for a period stand at the beginning
    enough = np.searchsorted(-sizes, -np.maximum(LEAST, TIMES * np.arange(1, most + 1)), "right")
    held, total = [], 0
    for period in range(1, most + 1):
        many = enough[period - 1]
        if not many:
            break
        end = int(ends[many - 1])
        grid = (TIMES - 1) * period
        here = codes[:end - period:grid]
        place = np.flatnonzero(here == codes[period:end:grid][:len(here)]) * grid
        if len(place):
            place = place[of[place] == of[place + period]]
            held.append((place, np.full(len(place), period)))
            total += len(place)
            if total >= LOT:
                yield tuple(map(np.concatenate, zip(*held)))
                held, total = [], 0
    if total:
        yield tuple(map(np.concatenate, zip(*held)))


def _stretches(codes: np.ndarray, sizes: np.ndarray, step: int) -> np.ndarray:
    """Rows (start, length, period) of the maximal stretches in ``codes``."""
    of = np.repeat(np.arange(len(sizes)), sizes + 1)
    n = len(codes)
    right, left = Extensions(codes, step), Extensions(codes[::-1], step)
    found = [np.zeros((0, 3), np.int64)]
    for place, period in _grid(codes, sizes, of):
        # the few words up to the shift first: most pairs end there
        ahead, reached = right.few(place, place + period)
        behind, back = left.few(n - 1 - place - period, n - 1 - place)  # counts the place itself
        stays = reached | back | (ahead + behind - 1 >= np.maximum(LEAST, TIMES * period) - period)
        place, period = place[stays], period[stays]
        ahead = right(place, place + period)
        behind = left(n - 1 - place - period, n - 1 - place) - 1
        length = behind + ahead + period
        whole = length >= np.maximum(LEAST, TIMES * period)
        found.append(np.stack((place - behind, length, period), axis=1)[whole])
    rows = np.unique(np.concatenate(found), axis=0)
    # of one stretch the smallest period: rows are in order of (start, length, period)
    keep = np.ones(len(rows), bool)
    keep[1:] = (rows[1:, :2] != rows[:-1, :2]).any(axis=1)
    return rows[keep]


def runs(texts: list[np.ndarray], step: int = STEP) -> list[np.ndarray]:
    """Per text (numbers of words) its runs as rows (start, length, period),
    by start, then period."""
    sizes = np.array([len(t) for t in texts], np.int64)
    order = np.argsort(-sizes, kind="stable")
    out = [np.zeros((0, 3), np.int64) for _ in texts]
    if not len(texts) or not sizes.max(initial=0):
        return out
    parts = []
    for k, which in enumerate(order.tolist()):
        parts += [texts[which], np.array([-1 - k], np.int64)]
    rows = _stretches(np.concatenate(parts).astype(np.int64), sizes[order], step)
    begins = np.cumsum(sizes[order] + 1) - sizes[order] - 1
    of = np.searchsorted(begins, rows[:, 0], "right") - 1
    for k in np.unique(of):
        mine = rows[of == k]
        mine[:, 0] -= begins[k]
        out[order[k]] = mine[np.lexsort((mine[:, 2], mine[:, 0]))]
    return out


def kept_words(n: int, found: np.ndarray) -> np.ndarray:
    """Whether each of ``n`` words stays when of every run only its first
    period is kept."""
    edge = np.zeros(n + 1, np.int64)
    start, length, period = found.T
    np.add.at(edge, start + period, 1)
    np.add.at(edge, start + length, -1)
    return np.cumsum(edge[:-1]) == 0


_RUN = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def _collapsed(ids: pa.Array, texts: pa.Array, edit: Callable | None, step: int) -> pa.RecordBatch:
    spans = WordSpans(*joined(texts))
    codes, _ = spans.coded()
    keys = ids.to_pylist() if edit else [None] * len(ids)
    # which original word stands at each place
    places = [np.arange(a, b) for a, b in zip(spans.first.tolist(), spans.last.tolist())]
    if edit:
        places = [p[edit(key, len(p))] if len(p) else p for key, p in zip(keys, places)]
    found = runs([codes[p] for p in places], step)
    kept, n_kept = [], []
    for p, mine in zip(places, found):
        stays = p[kept_words(len(p), mine)]
        text, _ = spans.text_of(stays)
        kept.append(text[:-1].decode("utf-8", "replace"))
        n_kept.append(len(stays))
    sizes = np.array([len(f) for f in found])
    rows = np.concatenate(found) if len(found) else np.zeros((0, 3), np.int64)
    flat = pa.StructArray.from_arrays([pa.array(rows[:, k]) for k in range(3)], ["start", "length", "period"])
    lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32()), flat)
    return pa.RecordBatch.from_arrays(
        [ids, pa.array([len(p) for p in places], pa.int64()), lists.cast(_RUN), pa.array(n_kept, pa.int64()), pa.array(kept, pa.string())],
        ["doc_id", "n_words", "runs", "n_kept", "collapsed"])


def collapse(docs: DataFrame, edit: Callable | None = None, step: int = STEP) -> DataFrame:
    """``doc_id, n_words, runs`` (start, length, period), ``n_kept`` and
    ``collapsed``: the text with only the first period of each run.

    ``edit(doc_id, n)`` may name for each place of a text of ``n > 0`` words the
    word that is to stand there.
    """
    on_workers(docs.sparkSession)
    id_type = dict(docs.dtypes)["doc_id"]

    def run(batches):
        for batch in batches:
            texts = batch["text"]
            for a, b in lots(texts, BATCH_BYTES):
                yield _collapsed(batch["doc_id"].slice(a, b - a), texts.slice(a, b - a), edit, step)

    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        run, f"doc_id {id_type}, n_words long, runs array<struct<start:long,length:long,period:long>>, n_kept long, collapsed string")


def planted(doc_id, n: int) -> np.ndarray:
    """Every tenth document, by the checksum of its id, ends periodically."""
    places = np.arange(n)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g = h // 10
    if h % 10 == 0:
        a = g % n
        period = 1 + (n - a) // (3 + g % 8)
        places[a:] = a + (places[a:] - a) % period
    return places


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = collapse(documents(spark, sf_dir), planted)
    # greatest length / period: doubles order such fractions exactly (both below 2 ** 26)
    ranked = F.transform("runs", lambda r: F.struct(
        (-(r["length"] / r["period"])).alias("order"), r["start"].alias("start"), r["period"].alias("period"), r["length"].alias("length")))
    best = F.array_min(ranked)
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    return done.withColumns({"best": best, "listed": listed}).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"), F.col("best.length").alias("length"), F.col("best.period").alias("period"),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2("listed", 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"), "n_words", "n_kept")
