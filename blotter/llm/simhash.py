"""SimHash near-duplicates by tiled exact comparison.

A text's words are cut into shingles; each shingle is hashed with XXH64 and a
fingerprint bit is set where more than half of the hashes, repeats included,
have it set.  Fingerprints differing in at most ``RADIUS`` bits are linked.

Finding the links is exact.  Distinct fingerprints are dealt four times, by
each 16-bit quarter: with at most three bits different two fingerprints agree
in at least one quarter (``RADIUS + 1`` blocks in general).  Fingerprints that
share a block value are sorted by population count and compared tile against
tile, exclusive-or and bit count in numpy; tile pairs whose population counts
lie further apart than the radius are skipped.  A block value with many
fingerprints is spread over cells, so that no task compares more than about
two cells' worth at once, every pair of cells being compared once.

A task reports a spanning forest of its links, not the links, and components
are found from the forests.

Defined cases: a NULL or blank text has no shingle and the fingerprint zero,
linked like any other; fewer words than a shingle give one shingle of all;
repeated rows share a component; rows without an id get fingerprints and the
component of the smallest id they reach (their own, NULL, if they reach none).
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from blotter.llm.components import components
from blotter.llm.native_text import documents, unused, whole
from blotter.llm.shipping import give_back_memory, on_workers
from blotter.session import checkpoint_base

SHINGLE, RADIUS, SEED = 3, 3, 42
TILE = 1024
#: Fingerprints of one block value per cell.
CELL = 4096
#: Hashes turned into bits at a time.
CHUNK = 1 << 17

_WORDS = re.compile(rb"[^\x20\x09-\x0D]+").findall
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


# --- fingerprints -----------------------------------------------------------


def shingle_hashes(text: str, shingle: int = SHINGLE):
    """Runs of at most ``CHUNK`` hashes of the text's shingles, in order."""
    words = _WORDS(text.encode("utf-8", "surrogatepass").translate(_LOWER))
    if not words:
        return
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= shingle:
        yield [digest(joined, SEED)]
        return
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    for at in range(0, len(words) - shingle + 1, CHUNK):
        stop = min(at + CHUNK, len(words) - shingle + 1)
        spans = zip(starts[at:stop].tolist(), ends[at + shingle - 1:stop + shingle - 1].tolist())
        yield [digest(joined[i:j], SEED) for i, j in spans]


def _bit_counts(hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Set bits per position (64, most significant first) and run of hashes."""
    bits = np.unpackbits(hashes.astype(">u8").view(np.uint8)).reshape(-1, 64)
    return np.add.reduceat(bits, starts, axis=0, dtype=np.int64)


def fingerprint_batch(texts: list[str], shingle: int = SHINGLE) -> np.ndarray:
    """Fingerprints of whole texts; only a bounded run of hashes is held as bits."""
    counts = np.zeros((len(texts), 64), np.int64)
    totals = np.zeros(len(texts), np.int64)
    held, rows, starts, size = [], [], [], 0

    def flush():
        nonlocal held, rows, starts, size
        if size:
            found = _bit_counts(np.fromiter(held, np.uint64, size), np.array(starts))
            np.add.at(counts, np.array(rows), found)
        held, rows, starts, size = [], [], [], 0

    for row, text in enumerate(texts):
        for part in shingle_hashes(text, shingle):
            totals[row] += len(part)
            rows.append(row)
            starts.append(size)
            held.extend(part)
            size += len(part)
            if size >= CHUNK:
                flush()
    flush()
    return np.packbits(2 * counts > totals[:, None], axis=1).view(">u8").ravel().astype(np.uint64)


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, fp, text_hash``: the 64-bit fingerprint as a signed long, and
    the XXH64 of the text (NULL as empty)."""
    on_workers(docs.sparkSession)
    id_type = dict(docs.dtypes)["doc_id"]
    text = whole(F.col("text"))

    def run(batches):
        give_back_memory()
        for batch in batches:
            texts = [t or "" for t in batch["text"].to_pylist()]
            if texts:
                found = fingerprint_batch(texts, shingle).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"], pa.array(found), batch["text_hash"]], ["doc_id", "fp", "text_hash"])

    return docs.select("doc_id", text.alias("text"), F.xxhash64(text).alias("text_hash")).mapInArrow(
        run, f"doc_id {id_type}, fp long, text_hash long")


# --- links ------------------------------------------------------------------


def _forest(prints: np.ndarray, radius: int, owner: np.ndarray) -> np.ndarray:
    """Edges (larger, smaller) of a spanning forest of the links.

    ``owner`` says which of the cell's two halves a fingerprint is from; a
    pair from one half only is compared where that half meets itself.
    """
    if len(prints) < 2:
        return np.zeros((0, 2), np.uint64)
    ones = np.bitwise_count(prints).astype(np.int16)
    order = np.argsort(ones, kind="stable")
    prints, ones, owner = prints[order], ones[order], owner[order]
    halves = bool((owner != owner[0]).any())
    label = np.arange(len(prints))
    edges = []
    for a in range(0, len(prints), TILE):
        rows = prints[a:a + TILE]
        top = ones[min(a + TILE, len(prints)) - 1]
        for b in range(a, len(prints), TILE):
            if ones[b] - top > radius:
                break  # this tile and all later ones have too many bits set
            near = np.bitwise_count(rows[:, None] ^ prints[None, b:b + TILE]) <= radius
            if halves:
                near &= owner[a:a + TILE, None] != owner[None, b:b + TILE]
            if a == b:
                near = np.triu(near, 1)
            for i in np.flatnonzero(near.any(axis=1)):
                columns = b + np.flatnonzero(near[i])
                others, at = np.unique(label[columns], return_index=True)
                apart = others != label[a + i]
                if apart.any():
                    edges.extend((a + i, columns[k]) for k in at[apart])
                    label[np.isin(label, others[apart])] = label[a + i]
    return prints[np.array(edges, np.int64).reshape(-1, 2)]


def links(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``a, b``: forests of links between the distinct fingerprints ``fp``."""
    on_workers(prints.sparkSession)
    blocks = radius + 1
    edges = [64 * k // blocks for k in range(blocks + 1)]
    keys = F.array(*[
        F.struct(F.lit(k).alias("block"), F.shiftrightunsigned(F.shiftleft("fp", edges[k]), 64 - edges[k + 1] + edges[k]).alias("value"))
        for k in range(blocks)])
    dealt = prints.select("fp", F.explode(keys).alias("k")).select("fp", "k.block", "k.value")
    counts = dealt.groupBy("block", "value").agg(F.count(F.lit(1)).alias("n"))
    crowded = counts.filter(F.col("n") > CELL).withColumn("cells", F.ceil(F.col("n") / CELL).cast("int"))
    # block values held by more than CELL fingerprints; joined, not assumed small
    sized = dealt.join(crowded.drop("n"), ["block", "value"], "left")
    n = F.coalesce(F.col("cells"), F.lit(1))
    own = F.pmod(F.xxhash64("fp"), n).cast("int")
    meets = F.transform(F.sequence(F.lit(0), n - 1), lambda other: F.struct(
        F.least(own, other).alias("i"), F.greatest(own, other).alias("j"), own.alias("own")))
    celled = sized.select("fp", "block", "value", F.explode(meets).alias("c")).select(
        "fp", "block", "value", "c.i", "c.j", "c.own")
    bucketed = celled.withColumn("bucket", F.xxhash64("block", "value", "i", "j"))

    def run(batches):
        # rows arrive sorted by cell; a cell's rows are complete when the next begins
        kept = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            kept = table if kept is None else pa.concat_tables([kept, table])
            found, kept = _cells(kept, radius, last=False)
            if len(found):
                yield _edge_batch(found)
        if kept is not None:
            found, _ = _cells(kept, radius, last=True)
            if len(found):
                yield _edge_batch(found)

    return bucketed.repartition("bucket").sortWithinPartitions("block", "value", "i", "j").select(
        "fp", "block", "value", "i", "j", "own").mapInArrow(run, "a long, b long")


def _edge_batch(found: np.ndarray) -> pa.RecordBatch:
    signed = found.astype(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(signed[:, 0]), pa.array(signed[:, 1])], ["a", "b"])


def _cells(table: pa.Table, radius: int, last: bool) -> tuple[np.ndarray, pa.Table | None]:
    """Forests of the complete cells, and the rows of the last, open one."""
    columns = {c: table[c].to_numpy() for c in table.column_names}
    n = table.num_rows
    if n == 0:
        return np.zeros((0, 2), np.uint64), None
    change = np.zeros(n, bool)
    for c in ("block", "value", "i", "j"):
        change[1:] |= columns[c][1:] != columns[c][:-1]
    cuts = np.concatenate(([0], np.nonzero(change)[0], [n]))
    prints, own = columns["fp"].astype(np.uint64), columns["own"]
    ends = len(cuts) - 1 if last else len(cuts) - 2
    sizes = np.diff(cuts)[:ends]
    out = [_forest(prints[cuts[k]:cuts[k + 1]], radius, own[cuts[k]:cuts[k + 1]]) for k in np.nonzero(sizes > 1)[0]]
    found = np.concatenate(out) if out else np.zeros((0, 2), np.uint64)
    return found, None if last else table.slice(int(cuts[-2]))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """``doc_id, fp, text_hash, component, component_id`` per row: the
    component's least fingerprint and the smallest id reachable."""
    checkpoint_base(docs.sparkSession)
    prints = fingerprints(docs, shingle).checkpoint()  # texts are read once
    distinct = prints.groupBy("fp").agg(F.min("doc_id").alias("first"))
    found = links(distinct.select("fp"), radius).distinct().checkpoint()
    parts = components(found).withColumnRenamed("node", "fp")
    # the component's smallest id comes from its fingerprints' smallest ids
    member = distinct.join(parts, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    least = member.groupBy("component").agg(F.min("first").alias("component_id"))
    named = member.join(least, "component").select("fp", "component", "component_id")
    return prints.join(named, "fp")


def representatives(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """``docs`` reduced to one row of each component: of its smallest id (a
    missing one only if there is no other), and of several rows with that id the
    one whose text has the least XXH64; of rows equal in both any one."""
    spark = docs.sparkSession
    checkpoint_base(spark)
    found = near_duplicates(docs, shingle, radius)
    rows_of = found.groupBy("component", "doc_id", "text_hash").agg(F.count(F.lit(1)).alias("n"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("text_hash").alias("h"), "n"))
    id_, hash_, n, own = unused(docs, "__id", "__hash", "__n", "__own_hash")
    chosen = rows_of.groupBy("component").agg(first.alias("one")).select(
        F.col("one.id").alias(id_), F.col("one.h").alias(hash_), F.col("one.n").alias(n)).checkpoint()
    hashed = docs.withColumn(own, F.xxhash64(whole(F.col("text"))))

    def kept(some: DataFrame) -> DataFrame:
        return hashed.join(some.drop(n), F.col("doc_id").eqNullSafe(F.col(id_)) & (F.col(own) == F.col(hash_)), "left_semi")

    one = kept(chosen.filter(F.col(n) == 1)).drop(own)
    several = chosen.filter(F.col(n) > 1)
    if several.isEmpty():
        return one
    # rows equal in id and text: one of them, reduced in each task before the shuffle
    row = F.first(F.struct(*[F.col(f"`{c}`") for c in docs.columns])).alias("row")
    return one.unionByName(kept(several).groupBy("doc_id", own).agg(row).select("row.*"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir)).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
