"""Document fingerprints by randomised edit embedding.

A text is walked by a random walk that all texts share: at step ``j`` the walk
writes down the character under it and then stays or moves on by a coin that
depends only on ``j`` and that character.  Two texts that differ by few edits
fall into step again soon after each edit, so their written strings agree in
most places: edit distance has become Hamming distance.

The walk is taken over segments, so that all segments of a batch of texts walk
side by side in numpy.  A segment begins where the hash of the ``GRAM``
characters is the least within ``NEAR`` characters on both sides, so segments
after an edit of any length are those of before; pieces longer than
``2 * SEGMENT`` (periodic texts) are cut every ``SEGMENT`` characters.  Each
segment is known by the characters it begins with and how often a segment
began so before.  Walks go on to the end of their segment.

A fingerprint is ``SLOTS`` bytes; each samples one place of the written
strings as a hash of the ``SPAN`` characters written there: the segment whose
name has the least hash for the slot, and in it any step of the walk alike.
Both seldom change as texts or walks get longer.  Likeness is the share of
equal bytes.

``near_links`` and ``near_classes`` find near duplicates: sampled bits of the
fingerprint form bands, all fingerprints equal in a band are compared, and a
link stands if the likeness of the two confirms it.

Defined cases: a NULL text is empty; empty texts have the fingerprint of
zeros; equal texts have equal fingerprints; repeated rows are each their own
document (the next document of a row may be its own copy); rows without an id
come after all others; a single document is its own next.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blotter.llm.components import components
from blotter.llm.doc_ranges import HELD, RANGE, in_order, key_columns, with_ranges
from blotter.llm.native_text import documents
from blotter.llm.shipping import on_workers
from blotter.session import checkpoint_base

SEGMENT, SLOTS, SPAN = 256, 64, 3
NEAR, GRAM = SEGMENT // 4, 8
SEED = 2
#: Characters walked side by side, and text per range.
BATCH_CHARS, RANGE_TEXT = 2 << 20, 4 << 20
#: Bands, bits sampled for each and the places they are from; fingerprints of
#: one band value compared in a task.
BANDS, BAND_BITS, BAND_PLACES = 16, 24, 4
CELL = 4096
LIKENESS = 0.8

#: Twice as many steps as characters are usual; the last ``_LONGEST`` of the
#: table always move on, so that every walk reaches the end.
_LONGEST = 2 * SEGMENT
_STEPS = 4 * _LONGEST
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    """Well spread 64-bit values of 64-bit integers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def coins(seed: int = SEED) -> np.ndarray:
    """``coins[j, c]``: whether the walk moves on from character class ``c``
    at step ``j``; class 0 is the end and is never left."""
    table = np.random.default_rng(seed).integers(0, 2, (_STEPS, 256), np.uint8)
    table[-_LONGEST:] = 1
    table[:, 0] = 0
    return table


def classes(text: str) -> np.ndarray:
    """Code points hashed to the classes 1..255."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    return (((points + np.uint64(1)) * _MIX >> np.uint64(40)) % np.uint64(255)).astype(np.uint8) + np.uint8(1)


def _grams(chars: np.ndarray) -> np.ndarray:
    """Hashes of the ``GRAM`` characters from each position."""
    key, have = chars.astype(np.uint64), 1
    while have < GRAM:
        key = (key[:-have] << np.uint64(8 * have)) | key[have:]
        have *= 2
    return _mixed(key * _MIX)


def segments(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The segments of the joined ``texts``: begins, names, and each text's
    first one (and their number).  An empty text is one segment."""
    sizes = np.array([len(t) for t in texts], np.int64)
    stop = np.cumsum(sizes)
    start = stop - sizes
    joined = np.concatenate(texts)
    begins, names = [start], [np.zeros(len(texts), np.uint64)]
    if len(joined) >= 2 * NEAR + GRAM:
        grams = _grams(joined)
        x = (grams >> np.uint64(32)).astype(np.uint32)
        around, have = x, 1
        while have < NEAR:  # least of the NEAR hashes from each position
            around, have = np.minimum(around[:-have], around[have:]), 2 * have
        n = len(around) - NEAR - 1
        least = NEAR + np.flatnonzero((x[NEAR:NEAR + n] < around[:n]) & (x[NEAR:NEAR + n] <= around[NEAR + 1:]))
        of = np.searchsorted(stop, least, "right")
        # what decides about a begin lies within its text
        least = least[(least - NEAR >= start[of]) & (least + NEAR + GRAM <= stop[of])]
        begins.append(least)
        names.append(grams[least])
    begin, name = np.concatenate(begins), np.concatenate(names)
    order = np.argsort(begin, kind="stable")
    begin, name = begin[order], name[order]
    of = np.repeat(0, len(begin))
    of[np.flatnonzero(order < len(texts))] = 1
    of = np.cumsum(of) - 1
    size = np.minimum(np.append(begin[1:], len(joined)), stop[of]) - begin
    # long ones in pieces, the last one up to twice as long
    pieces = np.where(size >= 2 * SEGMENT, size // SEGMENT, 1)
    piece = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    begin, of = np.repeat(begin, pieces) + SEGMENT * piece, np.repeat(of, pieces)
    name = _mixed(np.repeat(name, pieces) + piece.astype(np.uint64) * _MIX)
    # the name counts how often it came before in its text
    same = np.lexsort((begin, name, of))
    new = np.ones(len(same), bool)
    new[1:] = (name[same][1:] != name[same][:-1]) | (of[same][1:] != of[same][:-1])
    place = np.arange(len(same))
    times = np.empty_like(place)
    times[same] = place - np.maximum.accumulate(np.where(new, place, 0))
    name = _mixed(name + times.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    return begin, name, np.searchsorted(of, np.arange(len(texts) + 1))


class Fingerprinter:
    def __init__(self, seed: int = SEED):
        self.coins = coins(seed)
        self.seed = np.uint64(seed)
        # places[s, n]: the step that slot s samples of a walk of n steps
        self.places = np.concatenate((np.zeros((SLOTS, 1), np.int64), self._least(_STEPS)), axis=1)

    def _least(self, n: int) -> np.ndarray:
        """Per slot and count ``1..n`` the number below the count that has the
        least hash: any is as likely, and it seldom changes with the count."""
        keys = (np.arange(SLOTS, dtype=np.uint64)[:, None] << np.uint64(40)) + np.arange(n, dtype=np.uint64)[None, :]
        order = _mixed(keys * _MIX + self.seed)
        least = np.minimum.accumulate(order, axis=1)
        new = np.concatenate((np.ones((SLOTS, 1), bool), order[:, 1:] < least[:, :-1]), axis=1)
        return np.maximum.accumulate(np.where(new, np.arange(n), 0), axis=1)

    def sampled(self, names: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Per text and slot the segment of least hash."""
        low = np.uint64(0xFFFFFFFF)
        salts = _mixed(np.arange(1, SLOTS + 1, dtype=np.uint64) * _MIX + self.seed)
        at = np.arange(len(names), dtype=np.uint64)
        found = np.empty((len(first) - 1, SLOTS), np.int64)
        for slot in range(SLOTS):
            order = _mixed(names ^ salts[slot])
            found[:, slot] = np.minimum.reduceat((order & ~low) | at, first[:-1]) & low
        return found

    def written(self, joined: np.ndarray, begin: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Walk the segments of ``lengths`` from ``begin``: the written
        characters by step and row, each segment's row, rows' numbers of steps."""
        order = np.argsort(-lengths, kind="stable")  # long rows first: short ones stop early
        row_of = np.empty_like(order)
        row_of[order] = np.arange(len(order))
        width = _LONGEST + 1
        grid = np.zeros((len(lengths), width), np.uint8)
        ends = np.cumsum(lengths)
        inside = np.arange(ends[-1]) - np.repeat(ends - lengths, lengths)
        grid.ravel()[inside + np.repeat(row_of * width, lengths)] = joined[inside + np.repeat(begin, lengths)]
        flat, at = grid.ravel(), np.arange(len(lengths), dtype=np.int64) * width
        out = np.zeros((_STEPS + SPAN, len(lengths)), np.uint8)
        steps = np.zeros(len(lengths), np.int64)
        k = np.count_nonzero(lengths)
        for j in range(_STEPS):
            here = flat.take(at[:k])
            if j % 16 == 0:  # the rows behind the last one still walking have ended
                walking = np.flatnonzero(here)
                if not len(walking):
                    break
                k = walking[-1] + 1
                here = here[:k]
            out[j, :k] = here
            at[:k] += self.coins[j].take(here)
            steps[:k] += here != 0
        return out, row_of, steps

    def fingerprints(self, texts: list[np.ndarray]) -> np.ndarray:
        """One row of ``SLOTS`` bytes per text."""
        begin, names, first = segments(texts)
        joined = np.concatenate(texts)
        lengths = np.append(begin[1:], len(joined)) - begin
        # a text walks the segments its slots sample, however many it has
        walked, at = np.unique(self.sampled(names, first), return_inverse=True)
        out, row_of, steps = self.written(joined, begin[walked], lengths[walked])
        rows = row_of[at.reshape(len(texts), SLOTS)]
        place = self.places[np.arange(SLOTS)[None, :], steps[rows]]
        value = np.zeros(rows.shape, np.uint64)
        for k in range(SPAN):
            value = (value << np.uint64(8)) | out[place + k, rows]
        value = (_mixed(value + self.seed) >> np.uint64(56)).astype(np.uint8)
        value[np.array([len(t) == 0 for t in texts])] = 0
        return value


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a == b).mean(axis=1)


def edited(text: str, following: str) -> str:
    """The last half replaced by the beginning of the following text."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def _in_chunks(texts: list[str]):
    """Index ranges of about ``BATCH_CHARS`` characters."""
    begin = total = 0
    for i, text in enumerate(texts):
        total += len(text)
        if total >= BATCH_CHARS:
            yield begin, i + 1
            begin, total = i + 1, 0
    if begin < len(texts):
        yield begin, len(texts)


def _with_guests(rows: DataFrame, ranges: int) -> DataFrame:
    """Ranges of ``doc_id, text``, each with the document that follows its
    last one as a guest: the first of the next range, or for the last range
    the first of all."""
    keyed = rows.select("*", F.struct(*key_columns()).alias("key"))
    firsts = keyed.groupBy(RANGE).agg(F.min("key").alias("key")).select(
        RANGE, "key", F.pmod(F.col(RANGE) - 1, F.lit(ranges)).alias("host"))
    if ranges <= HELD:
        firsts = F.broadcast(firsts)  # one row per range, at most HELD
    met = keyed.join(firsts, [RANGE, "key"], "left")
    seat = F.struct(F.col(RANGE).alias("seat"), F.lit(False).alias("guest"))
    seats = F.when(F.col("host").isNull(), F.array(seat)).otherwise(
        F.array(seat, F.struct(F.col("host").alias("seat"), F.lit(True).alias("guest"))))
    return met.select("doc_id", "text", F.explode(seats).alias("s")).select(
        "doc_id", "text", F.col("s.seat").alias(RANGE), F.col("s.guest").alias("guest"))


def fingerprints(docs: DataFrame) -> DataFrame:
    """Per document: its fingerprint, that of its edited text, that of the
    next document, and the likenesses."""
    on_workers(docs.sparkSession)
    id_type = dict(docs.dtypes)["doc_id"]
    rows, ranges = with_ranges(docs, RANGE_TEXT)

    def run(key, table):
        guests = table.filter(table["guest"])
        own = in_order(table.filter(pc.invert(table["guest"])).select(["doc_id", "text"]))
        after = in_order(guests.select(["doc_id", "text"]))
        texts = own["text"].to_pylist() + after["text"].to_pylist()[:1]
        maker, n, done = Fingerprinter(), own.num_rows, []
        for low, high in _in_chunks(texts[:n]):
            part = texts[low:high + 1]
            changed = [edited(t, part[i + 1]) for i, t in enumerate(part[:-1])]
            coded = [classes(t) for t in part]
            prints = maker.fingerprints(coded)
            halves = [np.concatenate((c[:len(c) - len(c) // 2], f[:len(c) // 2])) for c, f in zip(coded, coded[1:])]
            altered = maker.fingerprints(halves)
            done.append(pa.table({
                "n_chars": [len(t) for t in part[:-1]],
                "edited_sha256": [hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in changed],
                "fingerprint": [p.tobytes().hex() for p in prints[:-1]],
                "edited_fingerprint": [p.tobytes().hex() for p in altered],
                "near_edited": likeness(prints[:-1], altered), "near_next": likeness(prints[:-1], prints[1:])}))
        out = pa.concat_tables(done)
        return out.add_column(0, pa.field("doc_id", own.schema.field("doc_id").type), own["doc_id"])

    return _with_guests(rows, ranges).groupBy(RANGE).applyInArrow(
        run, f"doc_id {id_type}, n_chars long, edited_sha256 string, fingerprint string, "
             "edited_fingerprint string, near_edited double, near_next double")


@lru_cache(maxsize=1)
def band_bits() -> np.ndarray:
    """Per band the numbers of its sampled bits among the fingerprint's: bits
    of one place agree together, so each sampled place gives several."""
    rng = np.random.default_rng(SEED + 1)
    rows = []
    for _ in range(BANDS):
        places = rng.choice(SLOTS, BAND_PLACES, replace=False)
        rows.append(np.concatenate([8 * p + rng.choice(8, BAND_BITS // BAND_PLACES, replace=False) for p in places]))
    return np.array(rows)


def band_keys(prints: np.ndarray) -> np.ndarray:
    """``BANDS`` keys of ``BAND_BITS`` sampled bits for each row of bytes."""
    bits = np.unpackbits(prints, axis=1)
    return (bits[:, band_bits()].astype(np.int64) << np.arange(BAND_BITS)).sum(axis=2).astype(np.int32)


def forest(prints: np.ndarray, owner: np.ndarray, least: float) -> np.ndarray:
    """Pairs (place, place) of a spanning forest of the rows with at least that
    share of equal bytes.  Rows already joined are not compared again; with two
    owners, rows of one owner are compared where they meet alone."""
    need = int(np.ceil(least * prints.shape[1] - 1e-9))
    label, edges, halves = np.arange(len(prints)), [], bool((owner != owner[0]).any())
    for i in range(len(prints) - 1):
        apart = label[i + 1:] != label[i]
        if halves:
            apart &= owner[i + 1:] != owner[i]
        others = i + 1 + np.flatnonzero(apart)
        near = others[(prints[others] == prints[i]).sum(axis=1) >= need]
        if len(near):
            groups, at = np.unique(label[near], return_index=True)
            edges.extend((i, k) for k in near[at].tolist())
            label[np.isin(label, groups)] = label[i]
    return np.array(edges, np.int64).reshape(-1, 2)


def _bytes_of(column: pa.Array) -> np.ndarray:
    """Rows of ``SLOTS`` bytes of hex fingerprints."""
    return np.frombuffer(bytes.fromhex("".join(column.to_pylist())), np.uint8).reshape(-1, SLOTS)


def fingerprint_links(kinds: DataFrame, least: float = LIKENESS) -> DataFrame:
    """``a, b``: forests of links between the distinct ``fingerprint``.

    Fingerprints that agree in a band are compared all with all, so no link
    between members of a band is lost.  A band value with more than ``CELL`` of
    them is spread over cells; every pair of cells is compared in one task.
    """
    on_workers(kinds.sparkSession)

    def bands(batches):
        for batch in batches:
            if batch.num_rows:
                keys = band_keys(_bytes_of(batch["fingerprint"]))
                yield pa.RecordBatch.from_arrays([
                    batch["fingerprint"].take(pa.array(np.repeat(np.arange(len(keys)), BANDS))),
                    pa.array(np.tile(np.arange(BANDS, dtype=np.int32), len(keys))), pa.array(keys.ravel())], ["fingerprint", "band", "bits"])

    banded = kinds.select("fingerprint").mapInArrow(bands, "fingerprint string, band int, bits int")
    counts = banded.groupBy("band", "bits").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").withColumn(
        "cells", F.ceil(F.col("n") / CELL).cast("int"))
    own = F.pmod(F.xxhash64("fingerprint"), F.col("cells")).cast("int")
    meets = F.transform(F.sequence(F.lit(0), F.col("cells") - 1), lambda other: F.struct(
        F.least(own, other).alias("i"), F.greatest(own, other).alias("j"), own.alias("own")))
    celled = banded.join(counts, ["band", "bits"]).select("fingerprint", "band", "bits", F.explode(meets).alias("c")).select(
        "fingerprint", "band", "bits", "c.i", "c.j", "c.own")
    keys = ("band", "bits", "i", "j")

    def run(batches):
        # rows arrive sorted by cell; a cell's rows are complete when the next begins
        kept = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            kept = table if kept is None else pa.concat_tables([kept, table])
            found, kept = _whole_cells(kept, keys, least, last=False)
            if found is not None:
                yield found
        if kept is not None:
            found, _ = _whole_cells(kept, keys, least, last=True)
            if found is not None:
                yield found

    return celled.withColumn("bucket", F.xxhash64(*keys)).repartition("bucket").sortWithinPartitions(*keys).drop("bucket").mapInArrow(
        run, "a string, b string").distinct()


def _whole_cells(table: pa.Table, keys: tuple, least: float, last: bool):
    """Links of the complete cells, and the rows of the last, open one."""
    n = table.num_rows
    change = np.zeros(n, bool)
    for c in keys:
        column = table[c].to_numpy()
        change[1:] |= column[1:] != column[:-1]
    cuts = np.concatenate(([0], np.flatnonzero(change), [n])) if n else np.array([0])
    ends = len(cuts) - 1 if last else len(cuts) - 2
    a, b = [], []
    for low, high in zip(cuts[:-1][:ends], cuts[1:][:ends]):
        if high - low > 1:
            part = table.slice(low, high - low)
            names = part["fingerprint"].combine_chunks()
            for i, j in forest(_bytes_of(names), part["own"].to_numpy(), least):
                a.append(names[int(i)].as_py())
                b.append(names[int(j)].as_py())
    found = pa.RecordBatch.from_arrays([pa.array(a, pa.string()), pa.array(b, pa.string())], ["a", "b"]) if a else None
    return found, None if last or n == 0 else table.slice(int(cuts[-2]))


def _likeness_column(a, b) -> F.Column:
    pairs = F.sequence(F.lit(0), F.lit(SLOTS - 1))
    same = F.filter(pairs, lambda i: F.substr(a, 2 * i + 1, F.lit(2)) == F.substr(b, 2 * i + 1, F.lit(2)))
    return F.size(same) / F.lit(SLOTS)


def near_links(prints: DataFrame, least: float = LIKENESS) -> DataFrame:
    """``doc_id, near_id, likeness``: a forest of links between documents of
    different fingerprints (each by its first document), and every further
    document of a fingerprint linked to the first of it."""
    kinds = prints.groupBy("fingerprint").agg(F.min("doc_id").alias("first")).filter(F.col("first").isNotNull())
    equal = prints.join(kinds, "fingerprint").filter(F.col("doc_id") > F.col("first")).select(
        "doc_id", F.col("first").alias("near_id"), F.lit(1.0).alias("likeness")).distinct()
    found = fingerprint_links(kinds, least)
    left, right = (kinds.select(F.col("fingerprint").alias(c), F.col("first").alias(f"first_{c}")) for c in "ab")
    named = found.join(left, "a").join(right, "b").select(
        F.greatest("first_a", "first_b").alias("doc_id"), F.least("first_a", "first_b").alias("near_id"),
        _likeness_column(F.col("a"), F.col("b")).alias("likeness"))
    return named.unionByName(equal)


def near_classes(prints: DataFrame, least: float = LIKENESS) -> DataFrame:
    """``prints`` with ``class_id``: the smallest id that links reach (a
    document's own, or NULL, if it has none or reaches none)."""
    checkpoint_base(prints.sparkSession)
    kinds = prints.groupBy("fingerprint").agg(F.min("doc_id").alias("first")).checkpoint()
    parts = components(fingerprint_links(kinds, least)).select(F.col("node").alias("fingerprint"), "component")
    member = kinds.join(parts, "fingerprint", "left").withColumn("component", F.coalesce("component", "fingerprint"))
    firsts = member.groupBy("component").agg(F.min("first").alias("class_id"))
    return prints.join(member.join(firsts, "component").select("fingerprint", "class_id"), "fingerprint")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(documents(spark, sf_dir))
