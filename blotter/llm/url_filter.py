"""URL filter: host-suffix and path-prefix expressions joined to rules by hash.

Every URL expands into (host suffix, path prefix) expressions; an expression
meets a rule by an equi-join on the first four bytes of its SHA-256, is
confirmed by the full digest, and the most specific confirmed rule decides.
Only suffixes with as many labels, and prefixes with as many characters, as
some rule has are generated, so a long URL costs no more than the rule set's
distinct lengths and no match is lost.

Defined cases: NULL urls and urls without ``://`` have empty host and path and
match nothing; repeated rows are each judged; equally long rules: block wins,
then the smaller text; no matching rule: the default verdict (``allow``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SHORT_HEX = 8
DEFAULT_VERDICT = "allow"

#: The rules of the registered query (host, path, verdict).
RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)


def rules_table(spark: SparkSession, rules=RULES) -> DataFrame:
    return spark.createDataFrame(list(rules), "host string, path string, verdict string")


def host_path(url: Column) -> tuple[Column, Column]:
    """Lower-cased host and raw path; both empty without ``://``."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def _lengths(rules: DataFrame) -> tuple[list[int], list[int]]:
    """Distinct label counts and path lengths of the rules (at most the
    longest URL's length each, however many rules there are)."""
    labels = F.size(F.split("host", r"\."))
    row = rules.filter(F.col("host") != "").agg(
        F.sort_array(F.collect_set(labels)), F.sort_array(F.collect_set(F.length("path")))
    ).first()
    return row[0], row[1]


def expressions(host: Column, path: Column, labels: list[int], lengths: list[int]) -> Column:
    """Distinct host-suffix + path-prefix strings that could equal a rule."""
    n = F.size(F.split(host, r"\."))
    hosts = [F.when((host != "") & (n >= k), F.substring_index(host, ".", -k)) for k in labels]
    paths = [F.when(F.length(path) >= k, F.substring(path, 1, k)) for k in lengths]
    return F.array_compact(F.array(*[F.concat(h, p) for h in hosts for p in paths]))


def judge(pages: DataFrame, rules: DataFrame, default: str = DEFAULT_VERDICT) -> DataFrame:
    """``page_id, url, host, path, rule, verdict`` for every row of ``pages``."""
    rules = rules.select(
        F.coalesce("host", F.lit("")).alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict")
    labels, lengths = _lengths(rules)
    rule = F.concat("host", "path")
    keyed = (
        rules.filter(F.col("host") != "").select(rule.alias("rule"), F.col("verdict").alias("rule_verdict"))
        .withColumn("rule_digest", F.sha2(F.col("rule"), 256))
        .withColumn("short", F.substring("rule_digest", 1, SHORT_HEX))
    )
    host, path = host_path(F.col("url"))
    # equal rows are judged once and repeated at the end
    distinct = pages.select("page_id", "url").groupBy("page_id", "url").agg(F.count(F.lit(1)).alias("copies"))
    parsed = distinct.withColumns({"host": host, "path": path})
    asked = parsed.withColumn(
        "expression",
        F.explode_outer(expressions(F.col("host"), F.col("path"), labels, lengths))
        if labels else F.lit(None).cast("string"),
    ).withColumn("digest", F.sha2(F.col("expression"), 256))
    met = asked.withColumn("short", F.substring("digest", 1, SHORT_HEX)).join(keyed, "short", "left")
    confirmed = F.col("digest") == F.col("rule_digest")
    best = F.min(F.when(confirmed, F.struct(
        (-F.length("rule")).alias("rank"), (F.col("rule_verdict") != "block").alias("allows"),
        F.col("rule").alias("rule"), F.col("rule_verdict").alias("verdict"))))
    return (
        met.groupBy("page_id", "url", "host", "path", "copies").agg(best.alias("best"))
        .select("page_id", "url", "host", "path", F.col("best.rule").alias("rule"),
                F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
                F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int"))).alias("copy"))
        .drop("copy")
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return judge(pages, rules_table(spark)).drop("url")


SQL = r"""
WITH rules(rhost, rpath, rverdict) AS (VALUES
  ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
  ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
rest AS (
  SELECT row_number() OVER () AS rid, page_id,
         CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS r
  FROM pages),
parts AS (
  SELECT rid, page_id,
         translate(regexp_extract(r, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path
  FROM rest),
best AS (
  SELECT rid, arg_max(rhost || rpath, length(rhost || rpath)) AS rule,
         arg_max(rverdict, length(rhost || rpath)) AS verdict
  FROM parts JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
  GROUP BY rid)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM parts LEFT JOIN best USING (rid)
"""
