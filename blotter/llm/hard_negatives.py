"""Hard-negative mining with STR-packed R-trees.

For every anchor: its ``POSITIVES`` best rows of the same label by inner
product, and for each of them the ``NEGATIVES`` best rows of another label
whose score lies within ``LOW`` to ``HIGH`` percent of the positive's.

*Packing.*  Rows are dealt into shards by sort-tile-recursive cuts: slabs by
quantiles of the coordinate with the greatest variance, each slab into tiles by
those of the second.  The driver holds the slabs' cuts (the square root of the
number of shards), the tiles' cuts are a table.  In its shard's task the packing
goes on over further coordinates down to leaves of ``LEAF`` rows, and runs of
``FAN`` neighbouring nodes become the nodes of the next level, each with its
minimum bounding box.

*Search.*  For an anchor ``a`` a box gives each coordinate's product an interval,
so the sums of the ends bound every inner product inside.  Nodes wait in a
queue, the greatest upper bound first; a node is dropped when its bounds lie
outside every score window still open or its upper bound is strictly below the
window's worst kept score (at equality a smaller id may win).  The windows of an
anchor share one queue.  Each shard returns at most the first few rows per
window, which meet in a window function that ranks them.

Anchors meet the rows in blocks: a task searches one shard for one block of
anchors, so both sides of a task are bounded.

Everything is exact: components are integers, so are scores.

Defined cases: rows with a NULL id, label or vector, a NULL or non-finite
component, or another number of components than most rows take no part; of
several rows of one id the one with the smallest label, then vector, stands; an
empty table gives no rows; other columns do not matter.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from blotter.llm.shipping import on_workers
from blotter.session import checkpoint_base

POSITIVES, NEGATIVES = 5, 5
LOW, HIGH = 80, 100
SCALE = 256
#: Rows of a shard, anchors of a block, rows of a leaf, nodes under a node.
SHARD_ROWS, BLOCK_ANCHORS, LEAF, FAN = 8192, 4096, 64, 16


# --- one shard's tree ---------------------------------------------------------


def str_order(points: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """Rows in sort-tile-recursive order: slabs by the coordinate with the
    greatest spread, within a slab by the next, until leaves are left."""
    spread = np.argsort(-points.var(axis=0), kind="stable") if len(points) else np.zeros(0, np.int64)

    def tile(rows: np.ndarray, depth: int) -> list[np.ndarray]:
        leaves = -(-len(rows) // leaf)
        if leaves <= 1 or depth >= len(spread):
            return [rows]
        left = min(len(spread) - depth, max(1, math.ceil(math.log2(leaves) / 2)))
        slabs = math.ceil(leaves ** (1 / left))
        size = leaf * -(-leaves // slabs)
        rows = rows[np.argsort(points[rows, spread[depth]], kind="stable")]
        return [part for at in range(0, len(rows), size) for part in tile(rows[at:at + size], depth + 1)]

    return np.concatenate(tile(np.arange(len(points)), 0)) if len(points) else np.zeros(0, np.int64)


class RTree:
    """Rows packed into leaves and nodes with minimum bounding boxes."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, points: np.ndarray, leaf: int = LEAF, fan: int = FAN):
        order = str_order(points, leaf)
        self.ids, self.labels, self.points = ids[order], labels[order], points[order]
        self.leaf, self.fan = leaf, fan
        starts = np.arange(0, len(order), leaf)
        self.levels = []  # (low corners, high corners), leaves first
        if len(order):
            low, high = np.minimum.reduceat(self.points, starts), np.maximum.reduceat(self.points, starts)
            self.levels.append((low, high))
            while len(low) > 1:
                starts = np.arange(0, len(low), fan)
                low, high = np.minimum.reduceat(low, starts), np.maximum.reduceat(high, starts)
                self.levels.append((low, high))

    def _bounds(self, level: int, begin: int, end: int, a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        low, high = self.levels[level]
        one, other = low[begin:end] * a, high[begin:end] * a
        return np.minimum(one, other).sum(axis=1), np.maximum(one, other).sum(axis=1)

    def search(self, a: np.ndarray, wanted, windows: list[tuple[float, float]], k: int, visited: list | None = None) -> list[list[tuple]]:
        """Per score window (both ends included) the first ``k`` rows (score, id)
        among those whose places ``wanted(begin, end)`` admits, best score first,
        then by id."""
        best: list[list[tuple]] = [[] for _ in windows]  # (-score, id), in order

        def asked(low: float, high: float) -> bool:
            return any(low <= w[1] and high >= w[0] and (len(b) < k or high >= -b[-1][0]) for w, b in zip(windows, best))

        queue, top = [], len(self.levels) - 1
        if top >= 0:
            lows, highs = self._bounds(top, 0, len(self.levels[top][0]), a)
            queue = [(-h, top, n, l) for n, (l, h) in enumerate(zip(lows.tolist(), highs.tolist()))]
            heapq.heapify(queue)
        while queue:
            high, level, node, low = heapq.heappop(queue)
            if not asked(low, -high):
                continue
            if level:
                begin = node * self.fan
                lows, highs = self._bounds(level - 1, begin, begin + self.fan, a)
                for n, (l, h) in enumerate(zip(lows.tolist(), highs.tolist())):
                    if asked(l, h):
                        heapq.heappush(queue, (-h, level - 1, begin + n, l))
                continue
            begin, end = node * self.leaf, min((node + 1) * self.leaf, len(self.ids))
            if visited is not None:
                visited.append(node)
            scores = self.points[begin:end] @ a
            open_ = wanted(begin, end)
            for n, (least, most) in enumerate(windows):
                held = best[n]
                floor = max(least, -held[-1][0]) if len(held) == k else least
                hits = np.flatnonzero(open_ & (scores >= floor) & (scores <= most))
                if len(hits):
                    held.extend(zip((-scores[hits]).tolist(), self.ids[begin + hits].tolist()))
                    held.sort()
                    del held[k:]
        return [[(-s, i) for s, i in held] for held in best]


# --- on the cluster -----------------------------------------------------------


def points(rows: DataFrame, vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """``vec_id, label, v`` of the rows that take part; ``v`` holds each
    component times ``scale``, rounded down, one row per id."""
    scaled = F.transform(F.col(vector), lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("double"))
    finite = ~F.exists(F.col(vector), lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    taken = rows.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col(vector).isNotNull()).filter(finite)
    shaped = taken.select("vec_id", "label", scaled.alias("v"))
    # the length that most rows have; one row per length
    usual = shaped.groupBy(F.size("v").alias("dims")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("dims")).limit(1).collect()
    dims = usual[0]["dims"] if usual else 0
    one = shaped.filter(F.size("v") == dims).groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("row"))
    return one.select("vec_id", "row.label", "row.v")


def _cell(value: Column, cuts: Column) -> Column:
    """How many of the sorted cuts are at or below the value."""
    return F.size(F.filter(cuts, lambda c: c <= value))


def sharded(table: DataFrame, shard_rows: int = SHARD_ROWS) -> tuple[DataFrame, int]:
    """``table`` with ``shard``, its sort-tile-recursive tile, and their number."""
    dims = table.select(F.size("v").alias("n")).limit(1).collect()
    n = table.count()
    side = math.ceil(math.sqrt(-(-n // shard_rows))) if n else 1
    if side <= 1:
        return table.withColumn("shard", F.lit(0)), 1
    spread = table.agg(*[F.var_pop(F.get("v", d)).alias(str(d)) for d in range(dims[0]["n"])]).first()
    widest = sorted(range(dims[0]["n"]), key=lambda d: (-spread[d], d))
    first, second = F.get("v", widest[0]), F.get("v", widest[min(1, len(widest) - 1)])
    shares = [k / side for k in range(1, side)]
    exactness = max(10_000, 20 * side)
    slabs = table.agg(F.percentile_approx(first, shares, exactness).alias("c")).first()["c"]
    slabbed = table.withColumn("slab", _cell(first, F.lit([float(c) for c in slabs])))
    tiles = slabbed.groupBy("slab").agg(F.percentile_approx(second, shares, exactness).alias("cuts"))
    tiled = slabbed.join(tiles, "slab").withColumn("shard", F.col("slab") * side + _cell(second, F.col("cuts")))
    return tiled.drop("slab", "cuts"), side * side


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    lists = column.combine_chunks()
    if isinstance(lists, pa.ChunkedArray):
        lists = pa.concat_arrays(lists.chunks)
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1)


def _met(table: DataFrame, shards: int, anchors: DataFrame, search, schema: str, block: int):
    """``search(tree, anchor table)`` for every shard and block of anchors."""
    n = anchors.count()
    blocks = max(1, -(-n // block))
    dealt = anchors.withColumn("part", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")).withColumn(
        "shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    rows = table.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def run(rows, asked):
        found = []
        if rows.num_rows and asked.num_rows:
            tree = RTree(rows["vec_id"].to_numpy(), rows["label"].to_numpy(), _matrix(rows["v"]))
            found = search(tree, asked)
        columns = list(zip(*found)) if found else [()] * len(kinds)
        return pa.table({name: pa.array(c, kind) for (name, kind), c in zip(kinds, columns)})

    arrow = {"long": pa.int64(), "double": pa.float64()}
    kinds = [(name, arrow[kind]) for name, kind in (f.split() for f in schema.split(", "))]
    return rows.groupBy("shard", "part").cogroup(dealt.groupBy("shard", "part")).applyInArrow(run, schema)


def _positives(tree: RTree, asked: pa.Table, k: int) -> list[tuple]:
    out = []
    for anchor, label, a in zip(asked["vec_id"].to_pylist(), asked["label"].to_pylist(), _matrix(asked["v"])):
        def wanted(begin, end):
            return (tree.labels[begin:end] == label) & (tree.ids[begin:end] != anchor)

        found, = tree.search(a, wanted, [(-np.inf, np.inf)], k)
        out += [(anchor, i, s) for s, i in found]
    return out


def _negatives(tree: RTree, asked: pa.Table, k: int, low: int, high: int) -> list[tuple]:
    out = []
    for anchor, label, a, positives in zip(
            asked["vec_id"].to_pylist(), asked["label"].to_pylist(), _matrix(asked["v"]), asked["positives"].to_pylist()):
        # the whole numbers s with low * positive <= 100 * s <= high * positive
        ends = [(-(-low * int(p["score"]) // 100), high * int(p["score"]) // 100) for p in positives]
        found = tree.search(a, lambda begin, end: tree.labels[begin:end] != label, ends, k)
        out += [(anchor, p["id"], p["score"], i, s) for p, rows in zip(positives, found) for s, i in rows]
    return out


def mined(table: DataFrame, anchors: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES,
          low: int = LOW, high: int = HIGH, shard_rows: int = SHARD_ROWS, block: int = BLOCK_ANCHORS) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score`` for ``anchors``, rows of ``table`` (``vec_id, label, v``)."""
    on_workers(table.sparkSession)
    checkpoint_base(table.sparkSession)
    table, shards = sharded(table, shard_rows)
    table = table.checkpoint()  # read by both searches

    def same(tree, asked):
        return _positives(tree, asked, positives)

    def other(tree, asked):
        return _negatives(tree, asked, negatives, low, high)

    first = F.row_number().over(Window.partitionBy("anchor_id").orderBy(F.desc("score"), "positive_id"))
    near = _met(table, shards, anchors, same, "anchor_id long, positive_id long, score double", block)
    chosen = near.withColumn("place", first).filter(F.col("place") <= positives)
    lists = chosen.groupBy("anchor_id").agg(F.sort_array(F.collect_list(F.struct(
        "place", F.col("positive_id").alias("id"), "score"))).alias("positives"))  # at most ``positives`` each
    windows = anchors.join(lists, F.col("vec_id") == F.col("anchor_id")).drop("anchor_id").checkpoint()
    found = _met(table, shards, windows, other,
                 "anchor_id long, positive_id long, positive_score double, negative_id long, negative_score double", block)
    rank = F.row_number().over(Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= negatives).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id",
        F.col("positive_score").cast("long").alias("positive_score"), F.col("negative_score").cast("long").alias("negative_score"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    turned = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    checkpoint_base(spark)
    table = points(rows.withColumn("label", turned)).checkpoint()
    return mined(table, table.filter(F.col("vec_id") % 100 == 0))


SQL = """
WITH whole AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
anchor AS (SELECT * FROM whole WHERE vec_id % 100 = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, r.vec_id AS id, a.label = r.label AS same, list_dot_product(a.v, r.v)::BIGINT AS score
  FROM anchor a JOIN whole r ON a.vec_id <> r.vec_id),
pos AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score
  FROM scored WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, positive_id,
       row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id)::INTEGER AS rank,
       id AS negative_id, positive_score, score AS negative_score
FROM pos JOIN scored USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY rank <= 5
"""
