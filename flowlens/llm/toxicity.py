"""Toxicity: FTRL-proximal logistic regression over hashed words, word bigrams
and skip-grams.

Features of a text are the distinct hashes (``BITS`` bits) of its words, of
neighbouring pairs and of pairs with one word between them. FTRL-proximal keeps
two numbers per coordinate (the adjusted gradient sum ``z`` and the squared
gradient sum ``n``); the learning rate of a coordinate falls with its own ``n``,
and a coordinate whose ``|z|`` stays within the L1 strength has weight zero. The model is
therefore the short list of non-zero weights, which is broadcast.

Training is bounded: at most ``TRAIN_ROWS`` labelled documents (those with the
smallest hash of their id, the same at every run; one text per id, the one of
smallest hash), out of the ids whose crc32(doc_id as text) mod 5 is not 0, in one
task. Scoring covers every row and the whole text, is a map without a shuffle, and
never reads lang, source or labels.

Defined results: a null text counts as empty and gets the score of the bias
alone; without any usable label every score is a quarter, with labels of one class only
the share of toxic ones, smoothed by half a toxic and one and a half clean texts -- in
both cases nothing is known of the texts, so ``keep_clean`` keeps them all;
repeated documents keep their rows; a null doc_id is scored, with held_out null; an
empty table gives an empty result. Columns of any name pass ``keep_clean`` unchanged."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from ..functions.names import quoted, unused
from .common import Memo, bounded_sample, labelled, map_arrow, plain_names, sampled_texts, splitmix, table, word_hash

BITS = 20                 # hashed coordinates: 2^20
TRAIN_ROWS = 10_000       # bound on the labelled documents trained on
EPOCHS = 5
ALPHA, BETA, L2 = 2.0, 1.0, 0.0
L1_ROOT = 0.2             # L1 per square root of the training rows: noise sums grow so

# bytes that separate words become spaces, A-Z become a-z, other bytes stay
_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or 48 <= b <= 57 or b >= 128 else 32 for b in range(256))


def hashed_features(text: str | None, memo: Memo, bits: int = BITS) -> np.ndarray:
    """Distinct coordinates of a text; coordinate 0 is kept for the bias."""
    words = (text or "").encode().translate(_WORDS).split()
    memo.trim()
    h = np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))
    parts = [h,
             splitmix(h[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[1:]),
             splitmix(h[:-2] * np.uint64(0xC2B2AE3D27D4EB4F) + h[2:] + np.uint64(1))]
    return np.unique(np.concatenate(parts) >> np.uint64(64 - bits)).astype(np.int32)


class Ftrl:
    """FTRL-proximal for logistic loss; an example is its set of coordinates."""

    def __init__(self, size: int, l1: float, alpha=ALPHA, beta=BETA, l2=L2):
        self.z, self.n = np.zeros(size), np.zeros(size)
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.bias_z = self.bias_n = 0.0

    def weights(self, at: np.ndarray) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        w = -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)
        return np.where(np.abs(z) <= self.l1, 0.0, w)

    def bias(self) -> float:
        return -self.bias_z / ((self.beta + np.sqrt(self.bias_n)) / self.alpha)

    def learn(self, at: np.ndarray, label: int) -> None:
        w, b = self.weights(at), self.bias()
        g = 1 / (1 + np.exp(-np.clip(w.sum() + b, -35, 35))) - label
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * w
        self.n[at] = n + g * g
        self.bias_z += g - (np.sqrt(self.bias_n + g * g) - np.sqrt(self.bias_n)) / self.alpha * b
        self.bias_n += g * g


def _features(batches, bits: int):
    memo = Memo(word_hash)
    for b in batches:
        yield pa.RecordBatch.from_arrays(
            [b.column("h"), b.column("toxic"), pa.array([hashed_features(t, memo, bits) for t in b.column("text").to_pylist()], pa.list_(pa.int32()))],
            ["h", "toxic", "features"])


def _fit(batches, bits: int, epochs: int):
    """The bounded sample (one task) -> rows (at, weight); at = -1 is the bias."""
    rows = [(h, f.values.to_numpy(), t) for b in batches
            for h, f, t in zip(b.column("h").to_pylist(), b.column("features"), b.column("toxic").to_pylist())]
    rows.sort(key=lambda r: (r[0], r[1].tobytes()))
    data = [(f, t) for _, f, t in rows]
    toxic = sum(t for _, t in data)
    prior = float(np.log((toxic + 0.5) / (len(data) - toxic + 1.5)))
    model = Ftrl(1 << bits, L1_ROOT * len(data) ** 0.5)
    if 0 < toxic < len(data):
        for epoch in range(epochs):
            for k in np.random.default_rng(epoch).permutation(len(data)):
                model.learn(*data[k])
        every = model.weights(np.arange(1 << bits))
        at = np.flatnonzero(every)
        bias = model.bias()
    else:
        at, every, bias = np.zeros(0, np.int64), np.zeros(0), prior
    yield pa.RecordBatch.from_pydict({
        "at": pa.array([-1, *at.tolist()], pa.int32()),
        "weight": pa.array([bias, *every[at].tolist()], pa.float64())})


def training_rows(docs: DataFrame, labels: DataFrame, n: int = TRAIN_ROWS) -> DataFrame:
    """(doc_id, text, toxic, h) of the bounded sample of labelled documents."""
    usable = labelled(labels, "toxic").where(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) != 0)
    sample = bounded_sample(usable.select("doc_id", F.greatest(F.lit(0), F.least(F.lit(1), "toxic")).alias("toxic")), "doc_id", n)
    # at most n small rows: the bound of the broadcast, and of what is trained on
    return sampled_texts(docs, sample).withColumn("h", F.xxhash64("doc_id"))


def train(docs: DataFrame, labels: DataFrame, n: int = TRAIN_ROWS, bits: int = BITS, epochs: int = EPOCHS) -> dict[str, np.ndarray]:
    """at, weight (the non-zero ones), bias; nothing in ``at`` if the labels don't
    hold both classes."""
    features = map_arrow(training_rows(docs, labels, n), lambda batches: _features(batches, bits), "h long, toxic int, features array<int>")
    # the sample only (at most n rows) meets in one task; the scan stays parallel
    rows = map_arrow(features.repartition(1), lambda batches: _fit(batches, bits, epochs), "at int, weight double").toArrow().to_pydict()
    at, weight = np.array(rows["at"], np.int64), np.array(rows["weight"])
    if not len(at):      # no partition at all: no labelled document
        return {"at": at, "weight": weight, "bias": np.log(np.array([0.5 / 1.5]))}
    return {"at": at[at >= 0], "weight": weight[at >= 0].astype(np.float32), "bias": weight[at < 0][:1]}


def score(docs: DataFrame, model: dict[str, np.ndarray], column: str = "score", bits: int = BITS) -> DataFrame:
    """``docs`` with all its columns plus ``column`` (0..1); needs a text column."""
    sparse = docs.sparkSession.sparkContext.broadcast(model)   # the non-zero weights, at most 2^bits

    def run(batches):
        m = sparse.value
        dense = np.zeros(1 << bits, np.float32)
        dense[m["at"]] = m["weight"]
        memo = Memo(word_hash)
        for b in batches:
            sums = [float(dense[hashed_features(t, memo, bits)].sum(dtype=np.float64)) + float(m["bias"][0])
                    for t in b.column("text").to_pylist()]
            scores = pa.array(1 / (1 + np.exp(-np.clip(np.array(sums, np.float64), -35, 35))), pa.float64())
            yield pa.RecordBatch.from_arrays([*b.columns, scores], [*b.schema.names, column])

    flat = docs.toDF(*plain_names(docs.columns))
    return map_arrow(flat, run, StructType([*flat.schema.fields, StructField(column, DoubleType())])).toDF(*docs.columns, column)


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted per row of ``docs``."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    scored = score(rows, train(docs, labels)).drop("text")
    held = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 0
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that aren't predicted toxic, unchanged; all of them
    if the labels teach nothing (see above)."""
    model = train(docs, labels)
    if not len(model["at"]):
        return docs
    verdict, = unused(docs.columns, "toxicity")
    return score(docs, model, verdict).where(F.col(verdict) < 0.5).select(*map(quoted, docs.columns))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
