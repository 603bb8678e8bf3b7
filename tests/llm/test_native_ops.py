"""Quality rules, mixing, URL filter and sharding on small inputs."""

import re
import zlib

import pytest
from pyspark.sql import functions as F

from blotter.llm import mixing, quality_rules, sharding, url_filter
from tests.conftest import SF001, SF01, formatted_plan
from tests.llm.common import LONG, SCHEMA, TEXTS, WORD, edge_docs

NATIVE = [quality_rules.query, mixing.query, sharding.query]


@pytest.mark.parametrize("query", NATIVE)
def test_native_plans_have_no_python(spark, query):
    plan = formatted_plan(query(spark, SF001))
    assert not re.search("Python|Pandas|Arrow", plan)


# --- quality rules ---------------------------------------------------------


def measures(text):
    text = text or ""
    words = WORD.findall(text)
    grams = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    covered = {p for i, g in enumerate(grams) if grams.count(g) > 1 for p in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


def test_measures_of_edge_rows(spark):
    rows = [r for r in TEXTS if r[1] != LONG]
    extra = [(20, "a b a b a b a b", "s"), (21, "x y z x y z", "s"), (22, "l one\nl one\n\n \nl two\nl one", "s"),
             (23, "a\x0bb\x0cc\rd\u00a0e", "s")]
    docs = edge_docs(spark, rows + extra)
    got = quality_rules.measured(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    want = [(i, *measures(t)) for i, t, _ in rows + extra]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
    assert quality_rules.ledger(spark.createDataFrame([], SCHEMA)).count() == 0


def test_filtered_keeps_columns_and_clean_documents(spark):
    docs = edge_docs(spark)
    kept = quality_rules.filtered(docs)
    assert kept.columns == docs.columns and dict(kept.dtypes) == dict(docs.dtypes)
    ids = {r.doc_id for r in kept.collect()}
    assert {0, 5, 6} <= ids and not ids & {1, 2, 3, 4, 8, 9, 12}
    table = spark.read.parquet(f"{SF01}/documents.parquet")
    labels = spark.read.parquet(f"{SF01}/labels.parquet")
    judged = quality_rules.ledger(table).join(labels, "doc_id").filter("n_words >= 50 and 100 * n_repeat_words <= 50 * n_words")
    good = judged.filter("quality = 1")
    assert good.filter(quality_rules.passes()).count() == good.count()
    assert judged.filter("quality = 0").filter(~quality_rules.passes()).count() >= 0.9 * judged.filter("quality = 0").count()


def test_policies_and_ablations_from_the_ledger(spark):
    rows = [(k, *bits) for k, bits in enumerate([(0,), (1,), (3,), (4,), (4,), (6,), (16,)])]
    ledger = spark.createDataFrame(rows, "doc_id long, fail_bits long")
    assert {r.doc_id for r in quality_rules.apply_policy(ledger, "base").collect()} == {0, 3, 4, 6}
    assert {r.doc_id for r in quality_rules.apply_policy(ledger, "v2").collect()} == {0}
    found = {r.rule: (r.failed, r.alone, r.kept_without) for r in quality_rules.ablations(ledger, "v2").collect()}
    assert found["few_words"] == (2, 1, 2)
    assert found["repeated_words"] == (2, 0, 1)
    assert found["symbols"] == (3, 2, 3)
    assert found["long_words"] == (1, 1, 2)
    assert found["dup_lines"] == (0, 0, 1)


# --- mixing ----------------------------------------------------------------


def water_level(sizes):
    """Targets by repeated sharing of the excess."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (1, 2, 3)[k % 3] for k, s in enumerate(names)}
    capped, total = set(), float(sum(sizes.values()))
    while True:
        rest = total - sum(3 * sizes[s] for s in capped)
        spread = sum(weight[s] for s in names if s not in capped)
        target = {s: 3.0 * sizes[s] if s in capped else rest * weight[s] / spread for s in names}
        over = {s for s in names if s not in capped and target[s] > 3 * sizes[s]}
        if not over:
            return target
        capped |= over


def check_mix(rows):
    sizes = {}
    for r in rows:
        sizes[r.source] = sizes.get(r.source, 0) + r.size
    targets = water_level(sizes)
    for source, size in sizes.items():
        mine = [r for r in rows if r.source == source]
        assert all(r.source_size == size and abs(r.target - targets[source]) < 1e-6 * max(1, targets[source]) for r in mine)
        assert all(r.taken % r.size == 0 if r.size else r.taken == 0 for r in mine)
        assert all(r.taken <= 3 * r.size for r in mine)
        # one document is left to rounding (equal rows are one unit)
        assert abs(sum(r.taken for r in mine) - targets[source]) <= max(r.size for r in mine) * 0.5 * max(
            1, max(sum(o.doc_id == r.doc_id for o in mine) for r in mine)) + 1e-6


@pytest.mark.parametrize("sf", [SF001, SF01])
def test_mix_of_a_whole_table(spark, sf):
    rows = mixing.query(spark, sf).collect()
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    check_mix(rows)
    assert sorted(map(tuple, mixing.query(spark, sf).collect()), key=repr) == sorted(map(tuple, rows), key=repr)


def test_mix_survives_another_layout_and_block_size(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    one = {(r.doc_id, r.copies) for r in mixing.copies(mixing.sized(docs)).collect()}
    assert {(r.doc_id, r.copies) for r in mixing.copies(mixing.sized(docs.repartition(9))).collect()} == one
    small = mixing.copies(mixing.sized(docs), block=4)
    taken = small.groupBy("source").agg(F.sum(F.col("copies") * F.col("size")).alias("t"), F.first("target").alias("g"),
                                        F.max("size").alias("m"))
    assert all(abs(r.t - r.g) <= 0.5 * r.m for r in taken.collect())


def test_copies_are_unbiased(spark):
    """Documents of each size are taken as often as their source's rate."""
    rows = spark.range(3000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("source"),
        (10 * (F.col("id") % 5 + 1)).alias("size"))
    found = mixing.copies(rows).groupBy("source", "size").agg(
        F.avg("copies").alias("mean"), F.min("copies").alias("low"), F.max("copies").alias("high"),
        F.first(F.col("target") / F.col("source_size")).alias("rate"))
    for r in found.collect():
        assert (r.low, r.high) == (int(r.rate), int(r.rate) + 1)
        assert abs(r["mean"] - r.rate) < 0.08


def test_mix_edge_rows(spark):
    docs = edge_docs(spark)
    rows = mixing.copies(mixing.sized(docs)).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "source",
        mixing.repeated(F.col("n")).alias("one")).collect()
    assert len(rows) == len(TEXTS)
    check_mix(rows)
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    assert sum(len(WORD.findall(r.text or "")) for r in mixed.collect()) == sum(r.taken for r in rows)
    empty = spark.createDataFrame([], SCHEMA)
    assert mixing.copies(mixing.sized(empty)).count() == 0 and mixing.mix(empty).count() == 0


def test_no_block_is_larger_than_its_size(spark, monkeypatch):
    """A third of the rows without an id, another third of one id: every block
    of every level holds at most ``BLOCK`` documents, and the law holds."""
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    which = F.pmod(F.xxhash64("text"), F.lit(3))
    skewed = docs.withColumn("doc_id", F.when(which == 0, None).when(which == 1, 7).otherwise(F.col("doc_id"))).withColumn(
        "source", F.lit("one"))
    sizes, plain = [], mixing.blocked

    def watched(level, keys, seed, block):
        out = plain(level, keys, seed, block)
        sizes.extend(r["count"] for r in out.groupBy(*keys, "cell", "block").count().collect())
        return out

    monkeypatch.setattr(mixing, "blocked", watched)
    for block in (mixing.BLOCK, 5):
        sizes.clear()
        found = mixing.copies(mixing.sized(skewed), block=block).collect()
        assert max(sizes) <= block and sum(sizes) > 500
        assert sum(r.n for r in found) == docs.count()
        taken, target = sum(r.copies * r.size * r.n for r in found), found[0].target
        assert abs(taken - target) <= 0.5 * max(r.size * r.n for r in found) + 1e-6


# --- URL filter --------------------------------------------------------------

URLS = [None, "", "no scheme", "http://", "http://a.net", "http://EXAMPLE.net/en/x?q=/de/", "http://www.example.net/en",
        "http://example.net/en/", "http://notexample.net/en/", "http://a.org/fr/1", "http://a.org/de/", "https://x.Example.com/de/#f",
        "http://example.com?x=/de/", "http://a.b.c.d.e.net/", "x://h/" + "a" * 50_000, "ftp://u@host.net:80/p", "http://net/", "://org/fr/"]


def brute_verdict(url, rules):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest).group()
        path = re.match(r"[^?#]*", rest[len(host):]).group()
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), v == "block", h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, key=lambda x: (x[0], x[1]), default=(0, False, None, "allow"))
    return host, path, best[2], best[3]


@pytest.mark.parametrize("rules", [url_filter.RULES, (("net", "", "block"), ("net", "/e", "allow"), ("example.net", "/en", "block"),
                                                      ("a.org", "/fr/1", "allow"), ("a.org", "/fr/1", "block"), ("", "/", "block"))])
def test_urls(spark, rules):
    urls = URLS + ["http://a.net", None]
    pages = spark.createDataFrame([(k % 12 or None, u, "h", "r", "v") for k, u in enumerate(urls)],
                                  "page_id long, url string, host string, rule string, short string")
    known = [r for r in rules if r[0]]
    got = [(r.page_id, r.url, r.host, r.path, r.rule, r.verdict) for r in url_filter.judge(pages, url_filter.rules_table(spark, rules)).collect()]
    want = [(k % 12 or None, u, *brute_verdict(u, known)) for k, u in enumerate(urls)]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_no_rules_and_no_pages(spark):
    none = spark.createDataFrame([], "host string, path string, verdict string")
    pages = spark.createDataFrame([(1, "http://a.net/")], "page_id long, url string")
    assert [r.verdict for r in url_filter.judge(pages, none).collect()] == ["allow"]
    assert url_filter.judge(pages.filter("page_id = 2"), url_filter.rules_table(spark)).count() == 0


# --- sharding ------------------------------------------------------------------


def check_shards(rows, docs):
    want = sorted(((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in docs), key=repr)
    assert sorted(((r.doc_id, r.size, r.text_crc32) for r in rows), key=repr) == want
    for shard in {r.shard for r in rows}:
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(sum(r.shard == shard for r in rows)))


@pytest.mark.parametrize("sf", [SF001, SF01])
def test_shards_of_a_whole_table(spark, sf):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    rows = sharding.query(spark, sf).collect()
    check_shards(rows, docs)
    loads = [sum(r.size for r in rows if r.shard == s) for s in range(8)]
    slots = {}
    for r in rows:
        slots[r.vslot] = slots.get(r.vslot, 0) + r.size
    assert max(loads) - min(loads) <= max(slots.values())
    assert max(loads) - min(loads) <= 0.01 * sum(loads)


def test_shards_of_edge_rows(spark):
    docs = edge_docs(spark)
    rows = sharding.sized(docs)
    table = sharding.stored_map(spark, rows)
    check_shards(sharding.assign(rows, table, 2).collect(), [(i, t) for i, t, _ in TEXTS])
    empty = sharding.sized(spark.createDataFrame([], SCHEMA))
    assert sharding.assign(empty, sharding.stored_map(spark, empty), 2).count() == 0


def test_rebalancing_edits_the_map(spark):
    rows = sharding.sized(spark.read.parquet(f"{SF01}/documents.parquet"))
    table = sharding.stored_map(spark, rows)
    one, two = ({r.vslot: r.shard for r in table.filter(F.col("version") == v).collect()} for v in (1, 2))
    assert set(one) == set(two) == set(range(sharding.VIRTUAL_SLOTS))
    moved = sum(one[v] != two[v] for v in one)
    assert 0 < moved < len(one) / 2
    again = {r.vslot: r.shard for r in sharding.rebalanced(table.filter("version = 2"), 8).collect()}
    assert sum(again[v] != two[v] for v in two) <= moved


def test_shards_are_even_where_ids_are_missing(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    for share in (F.lit(None), F.lit(3)):
        skewed = docs.withColumn("doc_id", F.when(F.col("doc_id") % 3 == 0, share).otherwise(F.col("doc_id")))
        rows = sharding.sized(skewed)
        placed = sharding.assign(rows, sharding.stored_map(spark, rows), 2)
        sizes = [r.b for r in placed.groupBy("shard").agg(F.sum("size").alias("b")).collect()]
        assert len(sizes) == 8 and max(sizes) < 1.01 * min(sizes)
        slots = placed.groupBy("shard").agg(F.min("slot").alias("low"), F.max("slot").alias("high"), F.count_distinct("slot").alias("n"))
        assert all((r.low, r.high) == (0, r.n - 1) for r in slots.collect())
        assert placed.groupBy("vslot").count().agg(F.max("count")).first()[0] < 10
