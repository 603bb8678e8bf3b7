r"""Quality rules as a bitmask ledger.

``ledger`` measures every text once and evaluates every rule once: one row
per document with the measurements and one bit per failed rule.  A policy is
a named mask of bits; ``apply_policy`` keeps documents with no failed bit in
the mask, and ``ablations`` reads from a count per distinct bit set how many
documents each rule removes alone and how many would come back without it.
Policies change without a second pass over the texts.

Everything is a column expression on the row itself: no shuffle, no Python.

Defined cases: a NULL or blank text has no words and fails ``few_words``;
repeated rows are judged alike, each on its own; other columns pass through
untouched, and an input column named like a measurement is replaced by it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from blotter.llm.native_text import SPACES, documents, let, whole, words

SYMBOLS = "#*$%&|<>"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")

#: Rule name -> condition on the measurements; the order fixes the bit.
RULES: dict[str, Column] = {
    "few_words": lambda: F.col("n_words") < 50,
    "repeated_words": lambda: 100 * F.col("n_repeat_words") > 50 * F.col("n_words"),
    "symbols": lambda: 100 * F.col("n_symbols") > 8 * F.col("word_chars"),
    "dup_lines": lambda: (100 * F.col("n_dup_lines") > 50 * F.col("n_lines")) & (F.col("n_lines") >= 4),
    "long_words": lambda: F.col("word_chars") > 25 * F.col("n_words"),
}
BITS = {name: 1 << i for i, name in enumerate(RULES)}

#: Versioned policies: the rules each one enforces.
POLICIES = {
    "base": ("few_words", "repeated_words"),
    "v1": ("few_words", "repeated_words", "symbols", "dup_lines"),
    "v2": tuple(RULES),
}
CURRENT = "v2"


def mask(policy: str) -> int:
    return sum(BITS[name] for name in POLICIES[policy])


def _repeat_words(tokens: Column) -> Column:
    """Words inside three-word windows that occur twice or more.

    The windows are sorted with their positions, so equal ones are adjacent;
    a position is hit if either neighbour is equal, and the hits, back in
    text order, cover three words each, overlaps once.
    """
    n = F.size(tokens) - 2
    windows = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.struct(
        F.concat_ws(" ", F.get(tokens, i), F.get(tokens, i + 1), F.get(tokens, i + 2)).alias("w"), i.alias("i")))

    def hits(s):
        # get() is NULL beyond either end
        return F.sort_array(F.transform(
            F.filter(s, lambda x, k: F.coalesce(x["w"] == F.get(s, k - 1)["w"], F.lit(False))
                     | F.coalesce(x["w"] == F.get(s, k + 1)["w"], F.lit(False))),
            lambda x: x["i"]))

    def covered(h):
        gaps = F.transform(h, lambda p, k: F.least(F.coalesce(F.get(h, k + 1) - p, F.lit(3)), F.lit(3)))
        return F.aggregate(gaps, F.lit(0).cast("long"), lambda a, g: a + g)

    return F.when(n < 2, F.lit(0).cast("long")).otherwise(
        let(F.sort_array(windows), lambda s: let(hits(s), covered)))


def measured(docs: DataFrame) -> DataFrame:
    """``docs`` with the columns of ``MEASURES``."""
    text = whole(F.col("text"))
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(F.translate(x, SPACES, "")) > 0)
    bare = F.translate(text, SPACES, "")
    kept = [c for c in docs.columns if c not in (*MEASURES, "fail_bits")]
    return docs.select(*[F.col(f"`{c}`") for c in kept]).withColumns({
        "__words": words(F.col("text")), "__lines": lines,
        "word_chars": F.length(bare).cast("long"),
        "n_symbols": (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long"),
    }).withColumns({
        "n_words": F.size("__words").cast("long"),
        "n_lines": F.size("__lines").cast("long"),
        "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"),
        "n_repeat_words": _repeat_words(F.col("__words")),
    }).drop("__words", "__lines")


def ledger(docs: DataFrame) -> DataFrame:
    """``docs`` with measurements and ``fail_bits``.

    The ledger's columns leave through a generator (one row in, one out):
    a later filter on them would otherwise be pushed below the measurements
    and evaluate each of them once per use.
    """
    bits = sum((F.when(rule(), F.lit(BITS[name])).otherwise(F.lit(0)) for name, rule in RULES.items()), F.lit(0))
    rows = measured(docs).withColumn("fail_bits", bits.cast("long"))
    others = [F.col(f"`{c}`") for c in rows.columns if c not in (*MEASURES, "fail_bits")]
    return rows.select(*others, F.inline(F.array(F.struct(*MEASURES, "fail_bits"))))


def passes(policy: str = CURRENT) -> Column:
    return F.col("fail_bits").bitwiseAND(F.lit(mask(policy))) == 0


def apply_policy(rows: DataFrame, policy: str = CURRENT) -> DataFrame:
    """Rows of a ledger that pass the policy."""
    return rows.filter(passes(policy))


def filtered(docs: DataFrame, policy: str = CURRENT) -> DataFrame:
    """Rows of ``docs`` that pass the policy, all columns as they came."""
    whole_row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row")
    return apply_policy(ledger(docs.select(whole_row, "text")), policy).select("__row.*")


def ablations(rows: DataFrame, policy: str = CURRENT) -> DataFrame:
    """``rule, failed, alone, kept_without`` for each rule of the policy.

    The ledger collapses to one count per distinct bit set (at most two to
    the number of rules) before anything is compared.
    """
    sets = rows.groupBy(F.col("fail_bits").bitwiseAND(F.lit(mask(policy))).alias("bits")).agg(
        F.count(F.lit(1)).alias("n"))
    rule = F.explode(F.array(*[
        F.struct(F.lit(r).alias("rule"), F.lit(BITS[r]).cast("long").alias("bit")) for r in POLICIES[policy]]))
    bits, bit = F.col("bits"), F.col("r.bit")
    count = lambda cond: F.sum(F.when(cond, F.col("n")).otherwise(0)).alias
    return sets.select("bits", "n", rule.alias("r")).groupBy(F.col("r.rule").alias("rule")).agg(
        count(bits.bitwiseAND(bit) != 0)("failed"),
        count(bits == bit)("alone"),
        count(bits.bitwiseAND(F.bitwise_not(bit)) == 0)("kept_without"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ledger(documents(spark, sf_dir))
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~passes("base")).alias("base_failed"), passes().alias("kept"), "fail_bits")


SQL = r"""
WITH t AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM t),
l AS (
  SELECT *, list_filter(string_split(text, chr(10)), lambda x: length(regexp_replace(x, '[\x20\x09-\x0D]+', '', 'g')) > 0) AS ls
  FROM w),
tri AS (
  SELECT rid, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g
  FROM (SELECT rid, ws, unnest(range(1, len(ws) - 1)) AS i FROM w WHERE len(ws) >= 3)),
hit AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM tri) WHERE c >= 2),
cov AS (
  SELECT rid, count(*) AS n FROM (
    SELECT DISTINCT rid, unnest([i, i + 1, i + 2]) AS p FROM hit) GROUP BY rid),
m AS (
  SELECT doc_id, len(ws)::BIGINT AS n_words,
         length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
         (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         len(ls)::BIGINT AS n_lines,
         (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
         coalesce(n, 0)::BIGINT AS n_repeat_words
  FROM l LEFT JOIN cov USING (rid)),
b AS (
  SELECT *, (n_words < 50)::BIGINT + 2 * (100 * n_repeat_words > 50 * n_words)::BIGINT
            + 4 * (100 * n_symbols > 8 * word_chars)::BIGINT
            + 8 * (100 * n_dup_lines > 50 * n_lines AND n_lines >= 4)::BIGINT
            + 16 * (word_chars > 25 * n_words)::BIGINT AS fail_bits
  FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (fail_bits & 3) <> 0 AS base_failed, fail_bits = 0 AS kept, fail_bits
FROM b
"""
