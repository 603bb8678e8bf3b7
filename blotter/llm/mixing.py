"""Mixing sources to target weights by pivotal dependent rounding.

Every document of a source may be copied ``target / size`` times on average:
a whole number of copies, the same for all, and a fractional copy decided by
rounding.  The rounding is the pivotal method on words: two documents with
fractional probabilities exchange probability so that the expected words of
the pair stay the same, in a random direction chosen without bias, until one
of them is decided.  A block of ``BLOCK`` documents is reduced this way from the
largest to the smallest to one undecided document; those meet in the next
level's blocks, so a source of any size is a tree of small blocks.  Blocks are
counted off inside cells, hashes of id and size of about ``BLOCK ** 2`` documents,
so none is larger, whatever ids or sizes repeat.  The one
document left at the root is rounded to the nearer side: a source's total
misses its target by at most half of one document.

Randomness is a hash of the ids and a seed: reruns agree.

Targets: sources in code-point order, NULL last, weigh 1, 2, 3, repeating,
and share all words; a target stops at ``MOST`` times its source's size and
the excess goes to the others by weight, which is the level ``x`` at which
``sum(min(cap, weight * x))`` is the total.

Defined cases: a NULL text has size 0; documents without words are never
taken words of; equal rows of one document are decided together and count
each; a source without words has target 0; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from blotter.llm.native_text import WORD, documents, let, unused, whole
from blotter.session import checkpoint_base

MOST = 3
WEIGHTS = (1, 2, 3)
SEED = 20
BLOCK = 64
EPS = 1e-9


def sized(docs: DataFrame) -> DataFrame:
    return docs.select(
        "doc_id", "source", F.regexp_count(whole(F.col("text")), F.lit(WORD)).cast("long").alias("size"))


def source_targets(rows: DataFrame) -> DataFrame:
    """``source, source_size, units, target``: one row per source."""
    sources = rows.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("units"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.get(F.array(*[F.lit(float(w)) for w in WEIGHTS]), F.pmod(place, F.lit(len(WEIGHTS))).cast("int"))
    weighted = sources.withColumn("weight", weight).withColumn("cap", F.lit(MOST) * F.col("source_size"))
    # in the order in which rising levels fill the caps
    filling = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    onward = filling.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = filling.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0))) / F.sum("weight").over(onward)
    leveled = weighted.withColumn("level", level).withColumn("fits", F.col("cap") >= F.col("weight") * F.col("level"))
    reached = F.first(F.when(F.col("fits"), F.col("level")), ignorenulls=True).over(everything)
    target = F.least(F.col("cap").cast("double"), F.col("weight") * F.coalesce(reached, F.col("level")))
    return leveled.withColumn("target", target).select("source", "source_size", "units", "target")


def _uniform(seed: int, *ids: Column) -> Column:
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), *ids), 11)
    return bits / F.lit(float(1 << 53))


_UNIT = "struct<mass:bigint,doc_id:{id},size:bigint,n:bigint,whole:int,p:double>"


def _exchange(a: Column, b: Column, seed: int) -> Column:
    """The pair after one exchange: (undecided or decided a, b)."""
    up = F.least((1 - a["p"]) * a["mass"], b["p"] * b["mass"])
    down = F.least(a["p"] * a["mass"], (1 - b["p"]) * b["mass"])

    def moved(x):
        change = F.when(_uniform(seed, a["doc_id"], b["doc_id"]) * (x["up"] + x["down"]) < x["down"], x["up"]).otherwise(-x["down"])
        return let(change, lambda d: F.struct(_with_p(a, a["p"] + d / a["mass"]).alias("a"), _with_p(b, b["p"] - d / b["mass"]).alias("b")))

    return let(F.struct(up.alias("up"), down.alias("down")), moved)


def _with_p(unit: Column, p: Column) -> Column:
    snapped = let(p, lambda v: F.when(v < EPS, F.lit(0.0)).when(v > 1 - EPS, F.lit(1.0)).otherwise(v))
    return F.struct(unit["mass"].alias("mass"), unit["doc_id"].alias("doc_id"), unit["size"].alias("size"),
                    unit["n"].alias("n"), unit["whole"].alias("whole"), snapped.alias("p"))


def _open(unit: Column) -> Column:
    return (unit["p"] > 0) & (unit["p"] < 1)


def _reduce_block(units: Column, id_type: str, seed: int) -> Column:
    """All units of a block, at most one still undecided."""
    kind = _UNIT.format(id=id_type)
    start = F.struct(F.lit(None).cast(kind).alias("left"), F.expr(f"cast(array() as array<{kind}>)").alias("done"))

    def step(acc, unit):
        def paired(pair):
            stays = F.when(_open(pair["a"]), pair["a"]).when(_open(pair["b"]), pair["b"])
            done = F.filter(F.array(pair["a"], pair["b"]), lambda u: ~_open(u))
            return F.struct(stays.alias("left"), F.concat(acc["done"], done).alias("done"))

        return (
            F.when(~_open(unit), F.struct(acc["left"].alias("left"), F.concat(acc["done"], F.array(unit)).alias("done")))
            .when(acc["left"].isNull(), F.struct(unit.alias("left"), acc["done"].alias("done")))
            .otherwise(let(_exchange(acc["left"], unit, seed), paired)))

    return F.aggregate(units, start, step, lambda acc: F.concat(
        acc["done"], F.filter(F.array(acc["left"]), lambda u: u.isNotNull())))


def blocked(level: DataFrame, keys: list[str], seed: int, block: int = BLOCK) -> DataFrame:
    """``level`` with ``block``, counted off in each cell by a hash."""
    order = F.xxhash64(F.lit(seed), "u.doc_id", "u.size")
    place = F.row_number().over(Window.partitionBy(*keys, "cell").orderBy(order, "u.doc_id", "u.size"))
    return level.withColumn("block", F.floor((place - 1) / block))


def copies(rows: DataFrame, seed: int = SEED, block: int = BLOCK) -> DataFrame:
    """``source, doc_id, size, n, source_size, target, copies``: one row per
    distinct document; ``n`` counts its equal rows, ``copies`` is for each."""
    checkpoint_base(rows.sparkSession)
    sources = source_targets(rows)
    units = rows.groupBy("source", "doc_id", "size").agg(F.count(F.lit(1)).alias("n"))
    # one row per source: broadcast only if measured small, split if skewed
    joined = units.join(sources.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    cells = F.greatest(F.lit(1), F.ceil(F.col("units") / (block * block)))
    state = joined.withColumn("rate", rate).select(
        "source", "source_size", "target", F.pmod(F.xxhash64(F.lit(seed), "doc_id", "size"), cells).alias("cell"),
        F.floor("rate").cast("int").alias("whole"), (F.col("rate") - F.floor("rate")).alias("p"),
        (F.col("size") * F.col("n")).alias("mass"), "doc_id", "size", "n")
    unit = F.struct("mass", "doc_id", "size", "n", "whole", F.when(
        (F.col("p") < EPS) | (F.col("mass") == 0), F.lit(0.0)).when(F.col("p") > 1 - EPS, F.lit(1.0)).otherwise(F.col("p")).alias("p"))
    id_type = dict(rows.dtypes)["doc_id"]
    keys = ["source", "source_size", "target"]
    level = state.select(*keys, "cell", unit.alias("u"))
    most = sources.agg(F.max("units")).first()[0] or 0
    decided, depth = None, 0
    while True:
        last = most <= block
        if last:
            level = level.withColumn("cell", F.lit(0).cast("bigint"))
        gathered = blocked(level, keys, seed + depth, block).groupBy(*keys, "cell", "block").agg(
            F.sort_array(F.collect_list("u"), asc=False).alias("us"))
        reduced = gathered.select(*keys, "cell", F.explode(_reduce_block(F.col("us"), id_type, seed + depth)).alias("u"))
        if last:
            # the one document left at the root goes to the nearer side
            done = reduced.withColumn("drawn", F.when(F.col("u.p") >= 0.5, 1.0).otherwise(0.0))
        else:
            reduced = reduced.checkpoint()  # read several times: the decided and the rest
            done = reduced.filter(~_open(F.col("u"))).withColumn("drawn", F.col("u.p"))
            level = reduced.filter(_open(F.col("u"))).withColumn("cell", F.floor(F.col("cell") / block))
            most = level.groupBy("source").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
        decided = done if decided is None else decided.unionByName(done)
        if last:
            break
        depth += 1
    return decided.select(
        "source", "u.doc_id", "u.size", "u.n", "source_size", "target",
        (F.col("u.whole") + F.col("drawn").cast("int")).alias("copies"))


def repeated(n: Column) -> Column:
    """Explode into ``n`` equal rows."""
    return F.explode(F.array_repeat(F.lit(1), n.cast("int")))


def mix(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """``docs`` with every row repeated as often as the mix takes it."""
    id_, source, size, copies_, words, copy = unused(docs, "__id", "__source", "__size", "__copies", "__words", "__copy")
    plan = copies(sized(docs), seed).filter(F.col("copies") > 0).select(
        F.col("doc_id").alias(id_), F.col("source").alias(source), F.col("size").alias(size), F.col("copies").alias(copies_))
    counted = docs.withColumn(words, F.regexp_count(whole(F.col("text")), F.lit(WORD)).cast("long"))
    same = (F.col("doc_id").eqNullSafe(F.col(id_)) & F.col("source").eqNullSafe(F.col(source)) & (F.col(words) == F.col(size)))
    return counted.join(plan, same).select(
        *[F.col(f"`{c}`") for c in docs.columns], repeated(F.col(copies_)).alias(copy)).drop(copy)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = copies(sized(documents(spark, sf_dir)))
    return rows.select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).cast("long").alias("taken"),
        "source", repeated(F.col("n")).alias("copy")).drop("copy")
