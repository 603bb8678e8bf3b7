"""Sharding through fixed virtual slots.

A record's virtual slot is a hash of its id and its text and never changes (the
text spreads rows without an id, or of one id).  Bytes and
rows are aggregated per virtual slot, and a slot-to-shard map, stored as a
table with a version per edit, places the slots.  Version 1 deals them round
robin; ``rebalanced`` edits a version so that shard sizes come near each
other, moving only slots whose shard is above the mean.  Only the map is
ever edited: a reader needs the record, the slot count and the latest version.

The law is ``bytes``: shard sizes in bytes are near equal, to within about
one virtual slot.  Equal texts are the groups by which rows may be skewed; a group
may hold more than a shard, so its rows are spread by their ids and need not
share a shard.

Defined cases: a NULL text has size 1 (no bytes plus one) and the checksum of
nothing; rows without an id are spread by their text; rows equal in id and text
share a virtual slot and get places of their own; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from blotter.llm.native_text import documents, let, whole
from blotter.session import scratch_path

#: Virtual slots; also the row bound of every slot table that is broadcast.
VIRTUAL_SLOTS = 4096
SHARDS = 8


def virtual_slot(*key: Column, slots: int = VIRTUAL_SLOTS) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(slots)).cast("int")


def sized(docs: DataFrame, slots: int = VIRTUAL_SLOTS) -> DataFrame:
    """``doc_id, size, text_crc32, vslot`` per row."""
    text = whole(F.col("text"))
    return docs.select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), virtual_slot(F.col("doc_id"), text, slots=slots).alias("vslot"))


def slot_totals(rows: DataFrame, slots: int = VIRTUAL_SLOTS) -> DataFrame:
    """``vslot, bytes, n`` for all virtual slots, empty ones included."""
    totals = rows.groupBy("vslot").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"))
    every = rows.sparkSession.range(slots).select(F.col("id").cast("int").alias("vslot"))
    return every.join(totals, "vslot", "left").fillna(0, ["bytes", "n"])


def first_map(totals: DataFrame, shards: int) -> DataFrame:
    """Version 1: virtual slots dealt round robin."""
    return totals.select(F.lit(1).alias("version"), "vslot", F.pmod("vslot", F.lit(shards)).alias("shard"), "bytes", "n")


def rebalanced(slot_map: DataFrame, shards: int) -> DataFrame:
    """The next version: slots in descending bytes stay where they are while
    their shard has room up to the mean, and otherwise go to the least
    loaded shard.  One row per virtual slot goes in (a fixed number)."""
    slots = F.sort_array(F.collect_list(F.struct(F.col("bytes"), F.col("n"), F.col("vslot"), F.col("shard"))), asc=False)
    start = F.struct(
        F.array_repeat(F.lit(0).cast("long"), shards).alias("loads"),
        F.expr("cast(array() as array<struct<vslot:int,shard:int,bytes:bigint,n:bigint>>)").alias("placed"))

    def place(acc, x, mean):
        home = F.get(acc["loads"], x["shard"]) + x["bytes"] <= mean
        least = (F.array_position(acc["loads"], F.array_min(acc["loads"])) - 1).cast("int")
        return let(F.when(home, x["shard"]).otherwise(least), lambda to: F.struct(
            F.transform(acc["loads"], lambda v, i: F.when(i == to, v + x["bytes"]).otherwise(v)).alias("loads"),
            F.concat(acc["placed"], F.array(F.struct(
                x["vslot"].alias("vslot"), to.alias("shard"), x["bytes"].alias("bytes"), x["n"].alias("n")))).alias("placed")))

    one = slot_map.agg(slots.alias("slots"), F.sum("bytes").alias("total"), (F.max("version") + 1).alias("version"))
    mean = F.ceil(F.col("total") / F.lit(shards))
    placed = one.select("version", F.aggregate("slots", start, lambda acc, x: place(acc, x, mean)).alias("acc"))
    return placed.select("version", F.inline("acc.placed")).select("version", "vslot", "shard", "bytes", "n")


def stored_map(spark: SparkSession, rows: DataFrame, shards: int = SHARDS, slots: int = VIRTUAL_SLOTS,
               path: str | None = None) -> DataFrame:
    """Write versions 1 and 2 of the map to ``path`` (default: a new table in
    the shared folder) and return the whole versioned table."""
    path = path or scratch_path(spark, "slot-map")
    version = f"{path}/version="
    first_map(slot_totals(rows, slots), shards).coalesce(1).drop("version").write.parquet(f"{version}1")
    one = spark.read.parquet(f"{version}1").withColumn("version", F.lit(1))
    rebalanced(one, shards).drop("version").write.parquet(f"{version}2")
    return spark.read.parquet(path)


def assign(rows: DataFrame, slot_map: DataFrame, version: int) -> DataFrame:
    """``rows`` with ``shard`` and ``slot``, the gapless place in the shard.

    Places count up through a shard's virtual slots: the map gives where a
    virtual slot begins and the rows are numbered within it, so no task ever
    holds a whole shard.
    """
    before = Window.partitionBy("shard").orderBy("vslot").rowsBetween(Window.unboundedPreceding, -1)
    places = slot_map.filter(F.col("version") == version).select(
        "vslot", "shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("begin"))
    inside = Window.partitionBy("vslot").orderBy("doc_id", "text_crc32", "size")
    numbered = rows.withColumn("place", F.row_number().over(inside) - 1)
    # at most VIRTUAL_SLOTS rows: a proven bound
    return numbered.join(F.broadcast(places), "vslot").withColumn("slot", F.col("begin") + F.col("place")).drop(
        "begin", "place")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sized(documents(spark, sf_dir))
    table = stored_map(spark, rows)
    return assign(rows, table, version=2).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "vslot")
