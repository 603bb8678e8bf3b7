"""From raw documents to token ids: five stages over the whole corpus.

Each stage takes what its predecessor kept and returns the columns of
``documents`` with its decisions carried out; the last returns the token ids.
The driver that runs the stages writes and rereads each one's result; ``run``
does the same in the shared folder, which also cuts the lineage.

Defined cases, for every stage: an empty table gives an empty result; other
columns are carried along, whatever their names; NULLs in them do not matter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blotter.llm import bpe, mixing, quality_rules, simhash, suffix_array
from blotter.llm.native_text import documents
from blotter.session import scratch_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the current quality policy.  A NULL text has no words
    and is rejected like an empty one; repeated rows are each judged; rows
    without an id or source are judged by their text."""
    return quality_rules.filtered(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the smallest id, of each group of near duplicates.  Rows
    without an id are members like any other and stay only where no row of the
    group has one; of rows of the smallest id the text with the least XXH64
    stays, of rows equal in both one.  NULL and blank texts are one group."""
    return simhash.representatives(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the strings that start earlier in the corpus too, all rows
    kept.  Rows of one id count in the order of ``doc_ranges``, rows without an
    id last; a NULL text becomes empty; of equal rows the first keeps its text."""
    cut = suffix_array.dedup(docs)
    if "n_chars" not in docs.columns:
        return cut
    return cut.withColumn("n_chars", F.length("text").cast(dict(docs.dtypes)["n_chars"]))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of their sources takes them.  A missing
    source is a source of its own; texts without words (NULL, empty) are not
    taken; equal rows of one document are decided together and each taken as often."""
    return mixing.mix(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, ids, n_tokens, decoded_sha256`` per row; the last tells that
    the ids decode to the text.  A NULL text is empty and has no ids; repeated
    rows, and rows without an id, are each encoded."""
    return bpe.round_trip(docs, lists=True).select(
        "doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality_rules", quality),
    ("simhash_dedup", near_dedup),
    ("suffix_array_dedup", substring_dedup),
    ("source_mixing", mix_sources),
    ("byte_bpe", tokenize),
]

#: XXH64, byte-level removal, dependent rounding and BPE are not SQL; the
#: pipeline is tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        out = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
    return STAGES[-1][1](spark, docs, sf_dir)
