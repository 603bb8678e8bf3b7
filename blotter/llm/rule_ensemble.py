"""Quality classifier as a sparse ensemble of rules.

1. *Statistics.*  Each whole text becomes a row of numbers (``STATISTICS``):
   sizes, shares of character classes, repeated words and lines.
2. *Rules.*  Shallow trees are grown on a sample of labelled rows; every path
   from a root to a node is a conjunction of conditions on statistics.
3. *Weights.*  A lasso logistic regression over the rules' truth values keeps
   few of them; its penalty is the strongest of ``PENALTIES`` whose log loss on
   a third of the sample is within ``SLACK`` of the best.
4. *Scoring.*  The kept rules are compiled into one Spark column expression:
   the logistic function of the weights of the rules that hold.

The sample is the only thing bounded: the ``SAMPLE`` labelled documents with
the least hash of their id, a parameter.  Statistics and scores cover all
documents.  Labels, ids, language and source are no statistics.

Defined cases: a NULL text is empty and scored as such (all statistics 0);
repeated rows are each scored; of several labels of one id the least counts, a
NULL label does not; without labels, or with one label only, every score is the
smoothed share of label 1; an empty table gives no rows; other columns do not
matter.
"""

from __future__ import annotations

import math
import re
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from blotter.llm.native_text import documents
from blotter.llm.shipping import on_workers
from blotter.llm.words import WordSpans, joined, lots
from blotter.session import scratch_path

#: Labelled rows that are learned from, at most.
SAMPLE = 10_000
TREES, DEPTH, BINS, SEED = 20, 3, 64, 11
#: Lasso penalties, strongest first, and the loss given up for a stronger one.
PENALTIES, SLACK = (0.03, 0.01, 0.003, 0.001), 0.005
#: Text measured at a time.
CHUNK = 2 << 20

STATISTICS = (
    "chars", "words", "mean_word", "symbols", "stops", "marks", "upper", "digits", "beyond_ascii",
    "distinct_words", "twin_words", "lines", "words_per_line", "twin_lines", "ended_lines")

#: Character classes by byte: fixed values.
_CLASSES = {"symbols": b"#*$%&|<>{}[]\\^~_=+@/", "stops": b".", "marks": b",;:!?\"'()-", "upper": bytes(range(65, 91)), "digits": b"0123456789"}


# --- statistics -----------------------------------------------------------------


def _sums(values: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    ahead = np.concatenate(([0], np.cumsum(values, dtype=np.int64)))
    return ahead[end] - ahead[begin]


def _distinct(codes: np.ndarray, of: np.ndarray, n: int) -> np.ndarray:
    """Distinct codes per text."""
    if not len(codes):
        return np.zeros(n, np.int64)
    pairs = np.unique(of.astype(np.int64) * (int(codes.max()) + 1) + codes)
    return np.bincount(pairs // (int(codes.max()) + 1), minlength=n)


def measured(texts: pa.Array) -> np.ndarray:
    """One row of ``STATISTICS`` per text."""
    data, begin, end = joined(texts)
    n = len(begin)
    spans = WordSpans(data, begin, end)
    codes, _ = spans.coded()
    words = spans.last - spans.first
    of = np.repeat(np.arange(n), words)
    chars = _sums((data & 0xC0) != 0x80, begin, end)
    out = {"chars": chars, "words": words}
    per_char, per_word = 1.0 / np.maximum(chars, 1), 1.0 / np.maximum(words, 1)
    out["mean_word"] = _sums(spans.inside & ((data & 0xC0) != 0x80), begin, end) * per_word
    for name, members in _CLASSES.items():
        inside = np.zeros(256, bool)
        inside[list(members)] = True
        out[name] = _sums(inside[data], begin, end) * per_char
    out["beyond_ascii"] = _sums(data >= 0xC0, begin, end) * per_char
    out["distinct_words"] = _distinct(codes, of, n) * per_word
    twin = np.zeros(len(codes), bool)
    twin[1:] = (codes[1:] == codes[:-1]) & (of[1:] == of[:-1])
    out["twin_words"] = _sums(twin, spans.first, spans.last) * per_word
    # lines: runs of bytes other than the line feed
    feed = data == 0x0A
    starts = ~feed
    starts[1:] &= feed[:-1]
    edges = begin[begin < end]
    starts[edges] = ~feed[edges]
    at = np.flatnonzero(starts)
    first, last = np.searchsorted(at, begin), np.searchsorted(at, end)
    lines = last - first
    line_of = np.repeat(np.arange(n), lines)
    ends = np.append(at[1:], len(data))
    stop = np.concatenate(([0], np.cumsum(~feed)))
    size = stop[ends] - stop[at]
    coded = pa.Array.from_buffers(pa.large_binary(), len(at), [
        None, pa.py_buffer(np.concatenate(([0], np.cumsum(size))).astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data[~feed]))]).dictionary_encode()
    kinds = _distinct(coded.indices.to_numpy(zero_copy_only=False), line_of, n)
    per_line = 1.0 / np.maximum(lines, 1)
    out["lines"], out["words_per_line"], out["twin_lines"] = lines, words * per_line, (lines - kinds) * per_line
    final = np.zeros(len(at), bool)
    full = size > 0
    final[full] = np.isin(data[at[full] + size[full] - 1], list(b".!?"))
    out["ended_lines"] = _sums(final, first, last) * per_line
    return np.stack([out[name] for name in STATISTICS], axis=1).astype(np.float64)


def statistics(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of ``docs`` and one column per statistic."""
    on_workers(docs.sparkSession)

    def run(batches):
        for batch in batches:
            texts = batch["text"]
            for a, b in lots(texts, CHUNK):
                rows = measured(texts.slice(a, b - a))
                kept = [batch[c].slice(a, b - a) for c in keep]
                yield pa.RecordBatch.from_arrays([*kept, *[pa.array(rows[:, k]) for k in range(len(STATISTICS))]], [*keep, *STATISTICS])

    kinds = dict(docs.dtypes)
    schema = ", ".join([f"`{c}` {kinds[c]}" for c in keep] + [f"{s} double" for s in STATISTICS])
    return docs.select(*[F.col(f"`{c}`") for c in keep], F.col("text").cast("string").alias("text")).mapInArrow(run, schema)


# --- rules ------------------------------------------------------------------------

#: A rule: per statistic (place) an interval, exclusive below, inclusive above.
Rule = tuple[tuple[int, float, float], ...]

_CONDITION = re.compile(r"^( *)(If|Else) \(feature (\d+) (<=|>) (\S+)\)$")


def paths(tree: str) -> list[Rule]:
    """The rules of all nodes but the root of a printed decision tree."""
    found, above = [], []
    for line in tree.splitlines():
        match = _CONDITION.match(line)
        if match is None:
            continue
        depth = len(match[1])
        above = [step for step in above if step[0] < depth]
        above.append((depth, int(match[3]), match[4], float(match[5])))
        rule: dict[int, tuple[float, float]] = {}
        for _, feature, side, threshold in above:
            low, high = rule.get(feature, (-math.inf, math.inf))
            rule[feature] = (low, min(high, threshold)) if side == "<=" else (max(low, threshold), high)
        found.append(tuple((k, low, high) for k, (low, high) in sorted(rule.items())))
    return found


def holds(rule: Rule) -> Column:
    """Whether a rule holds, over the statistics' columns."""
    conditions = []
    for k, low, high in rule:
        if low > -math.inf:
            conditions.append(F.col(STATISTICS[k]) > F.lit(low))
        if high < math.inf:
            conditions.append(F.col(STATISTICS[k]) <= F.lit(high))
    return reduce(lambda a, b: a & b, conditions)


def _added(terms: list[Column]) -> Column:
    """Their sum, as a balanced tree."""
    while len(terms) > 1:
        terms = [terms[k] + terms[k + 1] if k + 1 < len(terms) else terms[k] for k in range(0, len(terms), 2)]
    return terms[0]


class Ensemble:
    """Weighted rules; ``score`` is the column that applies them."""

    def __init__(self, intercept: float, weighted: list[tuple[float, Rule]]):
        self.intercept, self.weighted = intercept, weighted

    def score(self) -> Column:
        terms = [F.when(holds(rule), F.lit(weight)).otherwise(F.lit(0.0)) for weight, rule in self.weighted]
        z = _added([F.lit(self.intercept), *terms])
        return 1.0 / (1.0 + F.exp(-z))


def truth(rules: list[Rule], stats: np.ndarray) -> np.ndarray:
    """Whether each rule (column) holds for each row of statistics."""
    out = np.ones((len(stats), len(rules)), bool)
    for n, rule in enumerate(rules):
        for k, low, high in rule:
            out[:, n] &= (stats[:, k] > low) & (stats[:, k] <= high)
    return out


def lasso(x: np.ndarray, y: np.ndarray, penalty: float, rounds: int = 500) -> tuple[float, np.ndarray]:
    """Intercept and weights of the logistic regression of ``y`` on ``x`` with
    an absolute penalty on the weights of the standardised columns, by
    accelerated proximal gradient steps."""
    mean, scale = x.mean(axis=0), x.std(axis=0)
    scale[scale == 0] = 1.0
    z = np.hstack((np.ones((len(x), 1)), (x - mean) / scale))
    v = np.ones(z.shape[1])
    for _ in range(30):  # the greatest curvature bounds the step
        v = z.T @ (z @ v)
        v /= np.linalg.norm(v)
    step = 4 * len(z) / max(1e-12, float(np.linalg.norm(z @ v) ** 2)) / 1.05
    w = ahead = np.zeros(z.shape[1])
    momentum = 1.0
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-(z @ ahead)))
        moved = ahead - step * (z.T @ (p - y)) / len(z)
        moved[1:] = np.sign(moved[1:]) * np.maximum(np.abs(moved[1:]) - step * penalty, 0)
        following = (1 + math.sqrt(1 + 4 * momentum ** 2)) / 2
        ahead = moved + (momentum - 1) / following * (moved - w)
        w, momentum = moved, following
    weights = w[1:] / scale
    return float(w[0] - weights @ mean), weights


def _loss(x: np.ndarray, y: np.ndarray, model: tuple[float, np.ndarray]) -> float:
    p = np.clip(1 / (1 + np.exp(-(model[0] + x @ model[1]))), 1e-9, 1 - 1e-9)
    return float(-np.mean(np.where(y == 1, np.log(p), np.log(1 - p))))


def fitted(rows: DataFrame) -> Ensemble:
    """The ensemble learned from ``rows``: ``quality`` (0, 1), ``check`` (rows
    that choose the penalty) and the statistics.  A table of at most ``SAMPLE``
    ids: trees are grown on it as a DataFrame, weights fitted on the driver."""
    held = rows.select("quality", "check", *STATISTICS).toPandas()
    y, check = held["quality"].to_numpy(np.float64), held["check"].to_numpy(bool)
    share = (y.sum() + 1) / (len(y) + 2)
    plain = Ensemble(math.log(share / (1 - share)), [])
    if len(np.unique(y)) < 2:
        return plain
    if check.all() or len(np.unique(y[~check])) < 2:
        check[:] = False
    training = rows if not check.any() else rows.filter(~F.col("check"))
    vectors = training.select(F.col("quality").cast("double").alias("label"), array_to_vector(F.array(*STATISTICS)).alias("features"))
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, maxBins=BINS, seed=SEED).fit(vectors)
    rules = sorted({rule for tree in forest.trees for rule in paths(tree.toDebugString)})
    if not rules:
        return plain
    x = truth(rules, held[list(STATISTICS)].to_numpy(np.float64)).astype(np.float64)
    penalty = PENALTIES[-1]
    if check.any():
        losses = [_loss(x[check], y[check], lasso(x[~check], y[~check], p)) for p in PENALTIES]
        penalty = next(p for p, loss in zip(PENALTIES, losses) if loss <= min(losses) + SLACK)
    intercept, weights = lasso(x, y, penalty)
    return Ensemble(intercept, [(float(w), rule) for w, rule in zip(weights, rules) if w])


def remainder() -> Column:
    """crc32 of the id as text modulo 3; a NULL id counts as empty."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 3


def sample(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE) -> DataFrame:
    """Labelled statistics of at most ``rows`` labelled ids that are not held
    out, stored in the shared folder."""
    spark = docs.sparkSession
    usable = labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & (remainder() != 1))
    marked = usable.groupBy("doc_id").agg(F.min(F.col("quality").cast("int")).alias("quality"))
    marked = marked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    # at most ``rows`` ids: a proven bound
    texts = docs.select("doc_id", "text").join(F.broadcast(marked), "doc_id")
    rows_ = statistics(texts, ["doc_id", "quality"]).withColumn("check", remainder() == 2)
    path = scratch_path(spark, "quality-sample")
    # in one file and order, so that the trees' sampling is the same each time
    rows_.select("quality", "check", *STATISTICS).repartition(1).sortWithinPartitions("quality", *STATISTICS).write.parquet(path)
    return spark.read.parquet(path)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    ensemble = fitted(sample(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
    rows = statistics(docs, ["doc_id"]).select(
        "doc_id", (remainder() == 1).alias("held_out"), ensemble.score().alias("score"))
    return rows.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
