"""Pipeline over ``documents``: toxicity, quality rules, n-gram Jaccard join,
secret scan, packing. Each stage reads what its predecessor kept, as Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from flowlens.llm import ngram_join, packing, quality_rules, secret_scan, toxicity
from flowlens.llm.common import materialize, session, table

# pieces a packing worker remembers: fewer than op9's, since the executor's JVM keeps the heap of the stages before
PACKING_MEMO = 300_000


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic go."""
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"))


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule or a certified threshold refuses go."""
    return quality_rules.keep_good(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays (five-word shingles, similarity 0.8 or
    more): the one with the smallest id."""
    return ngram_join.keep_one(docs, size=5, percent=80)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret found is replaced in the text."""
    return secret_scan.redact_documents(docs, secret_scan.train(docs))


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The texts as pieces of token windows."""
    return packing.pack(docs, memo=PACKING_MEMO)


STAGES = [
    ("toxicity", drop_toxic),
    ("quality_rules", drop_low_quality),
    ("ngram_jaccard_join", drop_near_copies),
    ("secret_scan", redact_secrets),
    ("packing", pack_windows),
]

# trained models and the tokenizer aren't SQL: tested against brute force instead
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(session(spark), sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
