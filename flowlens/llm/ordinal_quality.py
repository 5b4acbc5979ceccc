"""Quality classifier: ordinal cumulative-link regression on graded ratings.

A rating is one of the ordered grades 0..K-1. One weight vector over hashed text
features gives a score s; ordered thresholds t_1 < t_2 < ... cut it into grades by
P(grade >= k) = logistic(s - t_k). All grades share the weights, so a document
scores once and the thresholds give the expected grade (sum of the tail
probabilities) and the tail probability that selection goes by.

Features: the distinct words of a text, the shapes of its words (kinds of
characters, runs collapsed) by their share, and shares of repeated lines and
repeated words, all hashed to ``BITS`` bits. Training is bounded: at most
``TRAIN_ROWS`` rated documents (smallest hash of the id, out of the ids whose
crc32 mod 5 is not 0; one text per id), by Adagrad in one task; thresholds stay ordered because
their gaps are learned as logarithms. Scoring is a map over all rows and whole
texts.

``graded`` turns the two label columns into grades: 0 low quality, 1 good but
toxic, 2 good.

Defined results: a null text counts as empty; without rated documents every grade
is equally likely; repeated rows and null ids keep their rows; repeated labels of a
document count as the largest; an empty table gives an empty result."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import Memo, bounded_sample, labelled, sampled_texts, table, word_hash

BITS = 18
GRADES = 3
TRAIN_ROWS = 10_000
EPOCHS, BATCH, RATE, RIDGE = 12, 128, 0.15, 1e-5
SELECT_FROM = 1           # kept: P(grade >= SELECT_FROM) of at least one half

# kinds of bytes: a lower, A upper, 0 digit, x beyond ASCII, signs stay themselves
_KINDS = bytes(97 if 97 <= b <= 122 else 65 if 65 <= b <= 90 else 48 if 48 <= b <= 57 else b if b < 128 else 120 for b in range(256))
_RUNS = re.compile(rb"(.)\1+")
_MASK = (1 << BITS) - 1


def _describe(word: bytes) -> tuple[int, int]:
    shape = _RUNS.sub(rb"\1", word.translate(_KINDS))[:6] + (b"%d" % min(len(word) // 8, 4))
    return word_hash(b"w" + word.lower()) & _MASK, word_hash(b"s" + shape) & _MASK


def text_features(text: str | None, memo: Memo) -> tuple[np.ndarray, np.ndarray]:
    """(coordinates, values)."""
    words = (text or "").encode().split()
    memo.trim()
    n = len(words)
    pairs = np.array(list(map(memo.__getitem__, words)), np.int64).reshape(n, 2)
    own = np.unique(pairs[:, 0])
    shapes, counts = np.unique(pairs[:, 1], return_counts=True)
    lines = [x for x in (text or "").split("\n") if x.strip()]
    extra = [1 - len(set(lines)) / max(1, len(lines)), 1 - len(own) / max(1, n), 1 / (1 + n / 10)]
    at = np.concatenate([own, shapes, [word_hash(b"e%d" % k) & _MASK for k in range(len(extra))]])
    values = np.concatenate([np.full(len(own), 1 / np.sqrt(max(1, len(own)))), 2 * np.sqrt(counts / max(1, n)), 2 * np.array(extra)])
    return at.astype(np.int32), values.astype(np.float32)


def cut(raw: np.ndarray) -> np.ndarray:
    """Ordered thresholds from the first one and the logarithms of the gaps."""
    return raw[0] + np.concatenate([[0], np.cumsum(np.exp(raw[1:]))])


def tails(s: np.ndarray, thresholds: np.ndarray) -> np.ndarray:
    """[rows, K-1]: P(grade >= k) for k = 1..K-1."""
    return 1 / (1 + np.exp(-np.clip(s[:, None] - thresholds, -35, 35)))


def gradient(s: np.ndarray, y: np.ndarray, thresholds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Log-likelihood per row and its derivatives by s and by the thresholds [rows, K-1]."""
    p = tails(s, thresholds)
    edge = np.column_stack([np.ones(len(s)), p, np.zeros(len(s))])
    slope = np.column_stack([np.zeros(len(s)), p * (1 - p), np.zeros(len(s))])
    rows = np.arange(len(s))
    own = np.maximum(edge[rows, y] - edge[rows, y + 1], 1e-12)
    by_s = (slope[rows, y] - slope[rows, y + 1]) / own
    by_t = np.zeros_like(slope)
    by_t[rows, y] -= slope[rows, y] / own
    by_t[rows, y + 1] += slope[rows, y + 1] / own
    return np.log(own), by_s, by_t[:, 1:-1]


def fit(data: list[tuple[np.ndarray, np.ndarray, int]], grades: int = GRADES, epochs: int = EPOCHS) -> tuple[np.ndarray, np.ndarray]:
    """(weights, thresholds)"""
    w, seen = np.zeros(1 << BITS), np.full(1 << BITS, 1e-3)
    raw, raw_seen = np.concatenate([[-0.5], np.zeros(grades - 2)]), np.full(grades - 1, 1e-3)
    for epoch in range(epochs):
        order = np.random.default_rng(epoch).permutation(len(data))
        for k in range(0, len(order), BATCH):
            some = [data[i] for i in order[k:k + BATCH]]
            at, values = np.concatenate([d[0] for d in some]), np.concatenate([d[1] for d in some])
            row = np.repeat(np.arange(len(some)), [len(d[0]) for d in some])
            s = np.bincount(row, w[at] * values, len(some))
            _, by_s, by_t = gradient(s, np.array([d[2] for d in some]), cut(raw))
            touched, inverse = np.unique(at, return_inverse=True)
            g = np.bincount(inverse, by_s[row] * values) / len(some) - RIDGE * w[touched]
            seen[touched] += g * g
            w[touched] += RATE * g / np.sqrt(seen[touched])
            t = by_t.mean(axis=0)
            g_raw = np.concatenate([[t.sum()], [t[j:].sum() * np.exp(raw[j]) for j in range(1, grades - 1)]])
            raw_seen += g_raw * g_raw
            raw += RATE * g_raw / np.sqrt(raw_seen)
    return w, cut(raw)


def graded(labels: DataFrame) -> DataFrame:
    """(doc_id, grade) from quality and toxic; a missing toxic counts as 0."""
    quality, toxic = labelled(labels, "quality"), labelled(labels, "toxic")
    grade = F.when(F.col("quality") < 1, 0).when(F.coalesce("toxic", F.lit(0)) >= 1, 1).otherwise(2)
    return quality.join(toxic, "doc_id", "left").select("doc_id", grade.alias("grade"))


def _features_task(batches):
    memo = Memo(_describe)
    for b in batches:
        rows = [text_features(t, memo) for t in b.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [b.column("h"), b.column("grade"), pa.array([a for a, _ in rows], pa.list_(pa.int32())), pa.array([v for _, v in rows], pa.list_(pa.float32()))],
            ["h", "grade", "at", "value"])


def _fit_task(batches):
    rows = [(h, a.values.to_numpy(), v.values.to_numpy(), g) for b in batches
            for h, a, v, g in zip(b.column("h").to_pylist(), b.column("at"), b.column("value"), b.column("grade").to_pylist())]
    rows.sort(key=lambda r: (r[0], r[1].tobytes()))
    if not rows:
        return
    w, thresholds = fit([r[1:] for r in rows])
    at = np.flatnonzero(w)
    k = len(thresholds)
    yield pa.RecordBatch.from_arrays([pa.array([*range(-k, 0), *at.tolist()], pa.int32()), pa.array([*thresholds, *w[at]], pa.float64())], ["at", "weight"])


def train(docs: DataFrame, grades: DataFrame, n: int = TRAIN_ROWS) -> dict[str, np.ndarray]:
    usable = grades.where(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) != 0)
    sample = bounded_sample(usable, "doc_id", n)                      # n small rows at most: the bound of the broadcast
    rows = sampled_texts(docs, sample).withColumn("h", F.xxhash64("doc_id"))
    features = rows.mapInArrow(_features_task, "h long, grade int, at array<int>, value array<float>")
    # the bounded sample meets in one task; the scan stays parallel
    model = features.repartition(1).mapInArrow(_fit_task, "at int, weight double").toArrow().to_pydict()
    at, weight = np.array(model["at"], np.int64), np.array(model["weight"])
    if not len(at):      # nothing rated: equal shares for every grade
        equal = np.arange(1, GRADES) / GRADES
        return {"at": at, "weight": weight.astype(np.float32), "thresholds": np.log(equal / (1 - equal))}
    return {"at": at[at >= 0], "weight": weight[at >= 0].astype(np.float32), "thresholds": weight[at < 0]}


def rate(docs: DataFrame, model: dict[str, np.ndarray], select_from: int = SELECT_FROM) -> DataFrame:
    """doc_id, expected_grade, tail_1 .. tail_{K-1}, kept."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)      # at most 2^BITS weights
    names = [f"tail_{k + 1}" for k in range(len(model["thresholds"]))]

    def run(batches):
        m = shipped.value
        dense, memo = np.zeros(1 << BITS), Memo(_describe)
        dense[m["at"]] = m["weight"]
        for b in batches:
            s = np.array([dense[a] @ v for a, v in (text_features(t, memo) for t in b.column(1).to_pylist())], np.float64)
            p = tails(s, m["thresholds"])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(p.sum(axis=1)), *[pa.array(p[:, k]) for k in range(p.shape[1])], pa.array(p[:, select_from - 1] >= 0.5)],
                ["doc_id", "expected_grade", *names, "kept"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, "doc_id long, expected_grade double, " + ", ".join(f"{n} double" for n in names) + ", kept boolean")


def op8_ordinal_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return rate(docs, train(docs, graded(table(spark, sf_dir, "labels"))))
