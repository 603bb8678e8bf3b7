"""Documents dealt into ranges in order of their ids, each small enough for one task.

Documents are ordered by id, missing ids last, and those of one id by the first
``PREFIX`` characters of the text, then by the XXH64 of the text, then by the
text.  Of two ranges the lower one holds the earlier documents, so order across
the corpus needs no sort in one task.

Ranges are cut by bytes, not by rows: narrow keys are sorted over the cluster and
a range ends where the next document would take it past ``range_bytes``, also
inside an id.  So a range has at most ``range_bytes`` or one document, and two
neighbours together have more than that; how ids or long texts are spread does
not matter.  Only rows equal in id and text stay together.

Up to ``HELD`` cuts are held by the driver.  Of more it holds every n-th, and the
others are a table that is joined by the cell between held cuts (which sends the
texts once more over the network): their number has no bound.
"""

from __future__ import annotations

from bisect import bisect_right

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blotter.llm.shipping import on_workers
from blotter.session import scratch_path

RANGE = "__range"
RANGE_BYTES = 4 << 20
#: What a row weighs beside its text, characters of a text that its order looks
#: at first, and cuts that the driver holds.
ROW_BYTES, PREFIX, HELD = 64, 64, 1 << 16
#: Ranges that are cut from one sorted partition, and such partitions at most.
CUT_TOGETHER, CUT_PARTITIONS = 16, 1 << 14
#: Ids that a double holds exactly.
EXACT = 1 << 53

Key = tuple[bool, int, str, int]


def key_columns() -> list[Column]:
    """What decides about the order of ``doc_id, text``: ``none, id, prefix, h``."""
    return [F.col("doc_id").isNull().alias("none"), F.coalesce(F.col("doc_id").cast("bigint"), F.lit(0)).alias("id"),
            F.substring("text", 1, PREFIX).alias("prefix"), F.xxhash64("text").alias("h")]


def _cut(range_bytes: int):
    """Sorted keys to the ranges of this partition: place, first key, the id of
    the last one, and bytes."""
    def run(batches):
        from pyspark import TaskContext

        part, place, held, first, last = TaskContext.get().partitionId(), 0, 0, None, None
        rows = []
        for batch in batches:
            for key in zip(*(batch[c].to_pylist() for c in ("none", "id", "prefix", "h", "size"))):
                key, size = key[:4], key[4]
                if first is None:
                    first = key
                elif held + size > range_bytes and key != last:
                    rows.append((part, place, *first, *last[:2], held))
                    place, held, first = place + 1, 0, key
                held, last = held + size, key
            if len(rows) >= 4096:
                yield _cut_batch(rows)
                rows = []
        if first is not None:
            rows.append((part, place, *first, *last[:2], held))
        if rows:
            yield _cut_batch(rows)

    return run


_CUT = [("part", pa.int32()), ("place", pa.int32()), ("none", pa.bool_()), ("id", pa.int64()), ("prefix", pa.string()),
        ("h", pa.int64()), ("last_none", pa.bool_()), ("last_id", pa.int64()), ("bytes", pa.int64())]


def _cut_batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(column, kind) for column, (_, kind) in zip(zip(*rows), _CUT)], [name for name, _ in _CUT])


def cuts(rows: DataFrame, total: int, range_bytes: int) -> DataFrame:
    """The ranges of ``doc_id, text`` as a stored table, one row per range."""
    spark = rows.sparkSession
    on_workers(spark)
    parts = min(CUT_PARTITIONS, max(1, -(-total // (CUT_TOGETHER * range_bytes))))
    keys = rows.select(*key_columns(), (F.octet_length("text") + ROW_BYTES).cast("long").alias("size"))
    order = ["none", "id", "prefix", "h"]
    found = keys.repartitionByRange(parts, *order).sortWithinPartitions(*order).mapInArrow(
        _cut(range_bytes), "part int, place int, none boolean, id long, prefix string, h long, "
                          "last_none boolean, last_id long, bytes long")
    path = scratch_path(spark, "range-cuts")
    found.write.parquet(path)
    return spark.read.parquet(path)


def _key(row) -> Key:
    return row["none"], row["id"], row["prefix"], row["h"]


def _joined(found: list, range_bytes: int) -> tuple[list[Key], bool]:
    """First keys of the ranges, neighbours that fit together (at the ends of
    partitions) made one, and whether every one begins a new id."""
    out, held, fresh, last = [], 0, True, None
    for row in found:
        if out and held + row["bytes"] <= range_bytes:
            held += row["bytes"]
        else:
            out.append(_key(row))
            held, fresh = row["bytes"], fresh and last != (row["none"], row["id"])
        last = row["last_none"], row["last_id"]
    return out, fresh


def _place(rows: DataFrame, held: list[Key], name: str, fresh: bool) -> DataFrame:
    """``rows`` with the number of the last of the sorted ``held`` cuts that is
    not after the row.  ``fresh``: every cut begins a new id."""
    if len(held) < 2:
        return rows.withColumn(name, F.lit(0))
    if fresh and all(abs(id) < EXACT for _, id, _, _ in held):
        # NULL ids stand behind all others, and so does a cut that begins them
        splits = [float(id) for none, id, _, _ in held[1:] if not none]
        behind = F.lit(len(held) - 1)
        if not splits:
            return rows.withColumn(name, F.when(F.col("doc_id").isNull(), behind).otherwise(0).cast("int"))
        keyed = rows.withColumn("__key", F.coalesce(F.col("doc_id").cast("double"), F.lit(float("inf"))))
        placed = Bucketizer(splits=[float("-inf"), *splits, float("inf")], inputCol="__key", outputCol="__at", handleInvalid="error").transform(keyed)
        return placed.withColumn(name, F.when(F.col("doc_id").isNull(), behind).otherwise(F.col("__at")).cast("int")).drop("__key", "__at")
    shared = rows.sparkSession.sparkContext.broadcast(held)  # at most HELD

    @F.pandas_udf("int")
    def at(none: pd.Series, id: pd.Series, prefix: pd.Series, h: pd.Series) -> pd.Series:
        borders = shared.value
        return pd.Series([bisect_right(borders, key) - 1 for key in zip(none, id, prefix, h)], dtype="int32")

    return rows.withColumn(name, at(*key_columns()))


def with_ranges(docs: DataFrame, range_bytes: int = RANGE_BYTES, keep: bool = False, held: int | None = None) -> tuple[DataFrame, int]:
    """``doc_id, text, __range`` (NULL text as empty) and the number of ranges;
    to ``keep`` the columns but the text, they are a struct ``rest``."""
    held = held or HELD
    others = [F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("rest")] if keep else []
    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), *others)
    total = rows.agg(F.sum(F.octet_length("text") + ROW_BYTES)).first()[0] or 0
    if total <= range_bytes:
        return rows.withColumn(RANGE, F.lit(0)), 1
    table = cuts(rows, total, range_bytes)
    sizes = {r["part"]: r["n"] for r in table.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect()}
    number = sum(sizes.values())
    if number <= held:
        found, fresh = _joined(table.orderBy("part", "place").collect(), range_bytes)
        return _place(rows, found, RANGE, fresh), len(found)
    return _by_table(rows, table, sizes, -(-number // held)), number


def _by_table(rows: DataFrame, table: DataFrame, sizes: dict[int, int], together: int) -> DataFrame:
    """Ranges where the driver holds only every ``together``-th cut."""
    begins = dict(zip(sorted(sizes), np.cumsum([0, *[sizes[p] for p in sorted(sizes)]]).tolist()))
    offsets = rows.sparkSession.createDataFrame(sorted(begins.items()), "part int, begin long")
    # at most CUT_PARTITIONS rows
    numbered = table.join(F.broadcast(offsets), "part").withColumn("number", F.col("begin") + F.col("place"))
    coarse = [_key(r) for r in numbered.filter(F.col("number") % together == 0).orderBy("number").collect()]
    fine = numbered.groupBy((F.floor(F.col("number") / together)).cast("int").alias("__cell")).agg(
        F.sort_array(F.collect_list(F.struct("none", "id", "prefix", "h"))).alias("__cuts"))
    celled = _place(rows, coarse, "__cell", fresh=False)
    below = F.size(F.filter("__cuts", lambda c: c <= F.struct(*key_columns())))
    return celled.join(fine, "__cell").withColumn(RANGE, F.col("__cell") * together + below - 1).drop("__cell", "__cuts")


def in_order(table: pa.Table) -> pa.Table:
    """An Arrow table of a range in the order of the documents."""
    table = table.sort_by([("doc_id", "ascending"), ("text", "ascending")])  # missing ids last
    ids = table["doc_id"].combine_chunks()
    if isinstance(ids, pa.ChunkedArray):
        ids = pa.concat_arrays(ids.chunks) if ids.num_chunks else pa.array([], pa.int64())
    if len(ids) < 2:
        return table
    none = ids.is_null().to_numpy(zero_copy_only=False)
    plain = ids.fill_null(0).to_numpy(zero_copy_only=False)
    same = (plain[1:] == plain[:-1]) & (none[1:] == none[:-1])
    if not same.any():
        return table
    # several rows of an id: by the beginning of the text, its hash, the text
    place = np.arange(len(ids))
    begins = np.flatnonzero(np.concatenate(([True], ~same)))
    ends = np.append(begins[1:], len(ids))
    texts = table["text"]
    for a, b in zip(begins.tolist(), ends.tolist()):
        if b - a > 1:
            part = texts.slice(a, b - a).to_pylist()
            place[a:b] = a + np.array(sorted(range(b - a), key=lambda k: order_key(part[k])))
    return table.take(pa.array(place))


def order_key(text: str) -> tuple[str, int, str]:
    """What orders the texts of one id."""
    h = xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass"), 42)
    return text[:PREFIX], h - (1 << 64) if h >> 63 else h, text

