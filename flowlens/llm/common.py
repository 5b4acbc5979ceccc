"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.names import unused
from ..session import materialize, prepare  # noqa: F401  (re-exported to the operators)

# rows per Arrow batch handed to Python: a batch of texts stays at a few MB
ARROW_ROWS = 1024
# and bytes per batch: very long texts or wide blocks come in smaller batches
ARROW_BYTES = 16 << 20
# distinct words kept per worker memo before it is emptied (bounds memory, never results)
MEMO_WORDS = 250_000


def session(spark: SparkSession) -> SparkSession:
    """Runtime settings of the Python operators: small Arrow batches, so that
    a batch of very long texts still fits a worker."""
    prepare(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return session(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# caches that an operator leaves in its Python worker for its next task, as modules of these names
WORKER_CACHES = ("_piece_encoders", "_sentencepiece_codecs")


def map_arrow(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema, keep: str | None = None) -> DataFrame:
    """mapInArrow; first frees what other operators cached in the worker (all
    but the cache named ``keep``), since workers outlive stages."""
    def run(batches):
        for name in WORKER_CACHES:
            if name != keep:
                sys.modules.pop(name, None)
        yield from fn(batches)

    return df.mapInArrow(run, schema)


def plain_names(columns: list[str]) -> list[str]:
    """``columns`` with other names for those that mapInArrow can't address
    (with dots or backquotes): rename by toDF before, and back after."""
    odd = [c for c in columns if "." in c or "`" in c]
    other = dict(zip(odd, unused(columns, *[f"plain_{k}" for k in range(len(odd))])))
    return [other.get(c, c) for c in columns]


def splitmix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64: every input bit moves every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Memo(dict):
    """word -> value, computed once per distinct word; emptied between texts
    when it grows past ``limit`` (``trim``)."""

    def __init__(self, make, limit: int = MEMO_WORDS):
        super().__init__()
        self.make, self.limit = make, limit

    def __missing__(self, word):
        value = self[word] = self.make(word)
        return value

    def trim(self):
        if len(self) > self.limit:
            self.clear()


def word_hash(word: bytes) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(word)


def labelled(labels: DataFrame, column: str) -> DataFrame:
    """One row per document: (doc_id, ``column``); repeated labels of a
    document count as the largest, null labels are left out."""
    return (labels.select("doc_id", F.col(column).cast("int").alias(column))
            .where(F.col("doc_id").isNotNull() & F.col(column).isNotNull())
            .groupBy("doc_id").agg(F.max(column).alias(column)))


def sampled_texts(docs: DataFrame, sample: DataFrame) -> DataFrame:
    """(doc_id, text, further columns of ``sample``): one row per doc_id of the
    sample, at most as many rows as it has. Of rows that repeat an id the text with
    the smallest hash counts; they are reduced per task before the shuffle."""
    more = [c for c in sample.columns if c != "doc_id"]
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(sample), "doc_id")
    one = F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("one")
    return rows.groupBy("doc_id", *more).agg(one).select("doc_id", F.col("one.text").alias("text"), *more)


def bounded_sample(rows: DataFrame, key: str, n: int) -> DataFrame:
    """At most ``n`` rows, those with the smallest hash of ``key``: the same
    rows at every run, whatever the partitioning."""
    return rows.orderBy(F.xxhash64(F.lit("sample"), key), key).limit(n)
