"""Joins with a selectable physical strategy and explicit duplicate handling.

Default (``strategy=None``): no hint.  Spark plans from size estimates and AQE
re-plans at runtime from the *measured* shuffle sizes - converting to a
broadcast join when one side turns out small, splitting skewed partitions
otherwise.  That is the right choice for almost every join here.

A strategy asked for by name becomes a hint.  ``'broadcast'`` is put on a side
only while the optimizer's estimate of its bytes is within a bound; the
estimate comes with the plan, so asking for it starts no job.
"""

from __future__ import annotations

import warnings
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STRATEGIES = ("broadcast", "merge", "shuffle_hash", "shuffle_replicate_nl")

# Session setting (non-Spark key) and its default: most bytes a hint broadcasts.
MAX_BROADCAST_BYTES_CONF = "blotter.broadcast.maxBytes"
DEFAULT_MAX_BROADCAST_BYTES = 256 * 1024 * 1024

# Likewise: in-memory bytes per byte of the estimate, which counts files as
# they are stored (compressed, encoded).
EXPANSION_CONF = "blotter.broadcast.expansion"
DEFAULT_EXPANSION = 4


def estimated_bytes(df: DataFrame) -> float:
    """The optimizer's size estimate of ``df``, from its plan (no job);
    infinite where the plan gives none."""
    if not hasattr(df, "_jdf"):  # no JVM plan at hand (Spark Connect)
        return float("inf")
    return float(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcast_fits(df: DataFrame, max_bytes: int | None = None) -> bool:
    """True while the estimated size of ``df``, times the expansion from stored
    to in-memory bytes, is within the bound."""
    conf = df.sparkSession.conf
    if max_bytes is None:
        max_bytes = int(conf.get(MAX_BROADCAST_BYTES_CONF, str(DEFAULT_MAX_BROADCAST_BYTES)))
    return estimated_bytes(df) * float(conf.get(EXPANSION_CONF, str(DEFAULT_EXPANSION))) <= max_bytes


def keep_first(df: DataFrame, keys: Sequence[str], order_col: str) -> DataFrame:
    """One row per key: the row with the smallest ``order_col`` (remaining
    columns break ties, so the choice is deterministic).  A NULL order value
    comes after all others; a key with NULLs only keeps one of its rows.

    Written as an aggregate (min over a struct), not a window: the reduction
    is partial on the map side, so a key holding a third of all rows is
    collapsed inside each task before anything is shuffled.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys and c != order_col]
    packed = F.min(F.struct(
        F.col(order_col).isNull().alias("_unordered"), F.col(order_col), *[F.col(c) for c in rest])).alias("_kept")
    kept = df.groupBy(*keys).agg(packed)
    fields = [F.col("_kept").getField(c).alias(c) for c in [order_col, *rest]]
    return kept.select(*[F.col(k) for k in keys], *fields).select(*df.columns)


_SALTABLE = {"inner", "left", "leftouter", "left_outer", "left_semi", "leftsemi", "semi", "left_anti", "leftanti", "anti"}


def salted(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str, salt: int, by: Sequence[str] | None = None
):
    """Spread every key of ``left`` over ``salt`` sub-keys and replicate
    ``right`` once per sub-key, so a hot key is joined by ``salt`` tasks.

    The sub-key is a hash of the columns ``by`` (not ``rand()``): a recomputed
    task assigns the same sub-keys, so retries after a lost executor neither
    drop nor duplicate rows.  Name a unique column in ``by``; without it the
    whole row is hashed, and equal rows share one sub-key.  Exact for joins
    that preserve only the left side; ``right`` grows ``salt`` times, so use
    it for dimension-sized sides.
    """
    if how.lower() not in _SALTABLE:
        raise ValueError(f"salting replicates the right side; not valid for {how!r} joins")
    sub = F.pmod(F.xxhash64(*[F.col(c) for c in by or left.columns]), F.lit(salt))
    left = left.withColumn("_salt", sub)
    right = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salt - 1)).cast("array<bigint>")))
    return left, right, [*keys, "_salt"]


def join_with_strategy(
    left: DataFrame,
    right: DataFrame,
    on: str | Sequence[str] | Column,
    how: str = "inner",
    strategy: str | None = None,
    dedupe: str | None = None,
    max_bytes: int | None = None,
    salt: int | None = None,
    salt_by: Sequence[str] | None = None,
) -> DataFrame:
    """Join ``left`` with ``right`` under an optional strategy hint.

    ``strategy``: ``None`` (planner + AQE), ``broadcast``, ``merge``,
    ``shuffle_hash`` or ``shuffle_replicate_nl``; the hint goes on ``right``.
    Spark ignores hints that cannot apply (no broadcast of the preserved side
    of an outer join) and plans as usual.  ``shuffle_replicate_nl`` never
    yields a nested loop here: keyed joins are always planned on their keys.

    ``dedupe``: ``None`` keeps SQL semantics (every matching pair), or the
    name of an ordering column: ``right`` is first reduced to the row with
    the smallest value per key, i.e. one partner per key.

    ``max_bytes`` bounds what a broadcast hint may send (by default the
    session's bound).  NULL keys never match, whatever the strategy.

    ``salt=n`` splits each key of a shuffle join over n tasks by the columns
    ``salt_by`` (see :func:`salted`).  AQE's skew-join splitting does this adaptively and is
    the default; salting is for sessions where it is off or does not apply.
    """
    if (dedupe is not None or salt) and isinstance(on, Column):
        raise ValueError("dedupe and salt need join keys given by name")
    keys = None if isinstance(on, Column) else ([on] if isinstance(on, str) else list(on))
    # The side as given bounds the reduced one: de-duplication removes rows.
    unreduced = right
    if dedupe is not None:
        right = keep_first(right, keys, dedupe)
    if salt and salt > 1 and strategy != "broadcast":
        left, right, on = salted(left, right, keys, how, salt, salt_by)
        return join_with_strategy(left, right, on, how, strategy, max_bytes=max_bytes).drop("_salt")
    if strategy is None:
        return left.join(right, on, how)
    if strategy not in STRATEGIES:
        raise ValueError(f"strategy must be one of {STRATEGIES} or None, got {strategy!r}")
    if strategy == "shuffle_replicate_nl":
        # A nested loop over an equi-join is a cross product: quadratic in
        # the input.  On outer joins Spark ignores this hint anyway, and the
        # optimizer may turn an outer join into an inner one (when a later
        # filter rejects NULLs), which would silently activate it.  The join
        # is therefore planned on its keys; the hint is accepted for parity.
        warnings.warn(
            "shuffle_replicate_nl is not applied to keyed joins; planning an equi-join",
            RuntimeWarning,
            stacklevel=2,
        )
        return left.join(right, on, how)
    if strategy == "broadcast" and not broadcast_fits(unreduced, max_bytes):
        warnings.warn(
            "broadcast side exceeds the byte bound; leaving the choice to the planner",
            RuntimeWarning,
            stacklevel=2,
        )
        return left.join(right, on, how)
    return left.join(right.hint(strategy), on, how)


def geo_enrich(
    facts: DataFrame,
    geo: DataFrame,
    on: Sequence[str] = ("lat", "lon"),
    cols: Sequence[str] = ("zip",),
    strategy: str | None = None,
    digits: int | None = None,
) -> DataFrame:
    """Left join facts to a coordinate lookup.

    By default coordinates must be exactly equal doubles.  ``digits`` rounds
    both sides to that many decimals for the comparison only (the facts keep
    their own coordinates).  Facts without a match keep NULL in ``cols``.
    Duplicate lookup rows for a coordinate fan out (see ``duplicate_keys``).
    """
    if digits is None:
        lookup = geo.select(*on, *cols)
        return join_with_strategy(facts, lookup, list(on), "left", strategy)
    keys = [f"_geo_{i}" for i in range(len(on))]
    lookup = geo.select(*[F.round(c, digits).alias(k) for c, k in zip(on, keys)], *cols)
    rounded = facts.withColumns({k: F.round(c, digits) for c, k in zip(on, keys)})
    return join_with_strategy(rounded, lookup, keys, "left", strategy).drop(*keys)


def semi_join_keys(facts: DataFrame, keys: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Keep facts whose key appears in ``keys`` (``left_semi``: no fan-out,
    no columns from ``keys``).  A short key list is broadcast by the planner
    or, once measured, by AQE."""
    names = [key] if isinstance(key, str) else list(key)
    return facts.join(keys.select(*names), names, "left_semi")
