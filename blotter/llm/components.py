"""Connected components by alternating stars.

Each round first links, around every node, its larger neighbours to the
smallest one known, then its smaller neighbours likewise; components shrink
to stars around their smallest member in a number of rounds that grows with
the logarithm of the longest chain.  A hub never gathers its neighbours in
one place: the smallest neighbour comes from a partially aggregated minimum
and is joined back.  Every round is a checkpoint in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blotter.session import checkpoint_base


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star operation on ``u, v`` with ``u > v``."""
    if large:
        # neighbours both ways; each node's larger neighbours go to its least
        seen = edges.select(F.col("u").alias("node"), F.col("v").alias("near")).unionByName(
            edges.select(F.col("v").alias("node"), F.col("u").alias("near")))
    else:
        seen = edges.select(F.col("u").alias("node"), F.col("v").alias("near"))
    least = seen.groupBy("node").agg(F.min("near").alias("m")).select("node", F.least("node", "m").alias("m"))
    met = seen.join(least, "node")
    if large:
        moved = met.filter(F.col("near") > F.col("node")).select(F.col("near").alias("u"), F.col("m").alias("v"))
    else:
        moved = met.select(F.col("near").alias("u"), F.col("m").alias("v")).filter("u != v").unionByName(
            least.select(F.col("node").alias("u"), F.col("m").alias("v")))
    return moved.filter("u != v").distinct()


def _signature(edges: DataFrame):
    hashed = F.xxhash64("u", "v")
    return edges.agg(F.count(F.lit(1)), F.bit_xor(hashed), F.sum(F.shiftright(hashed, 16))).first()


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` (the smallest member) for every node of the edges
    ``a, b`` but the smallest members themselves and those alone."""
    checkpoint_base(edges.sparkSession)
    state = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u != v").distinct().checkpoint()
    before = _signature(state)
    while True:
        following = _star(_star(state, large=True), large=False).checkpoint()
        now = _signature(following)
        if now == before:
            break
        state, before = following, now
    return state.select(F.col("u").alias("node"), F.col("v").alias("component"))
