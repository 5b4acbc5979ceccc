"""Approximate nearest neighbours by cross-polytope hashing.

Vectors are put on the unit sphere so that the inner product decides: stored ones
get one more component sqrt(M^2 - |x|^2) (M: largest norm; left out where all norms
are equal up to rounding) and are divided by M;
queries get 0 there. A pseudo-rotation is three rounds of random signs and a fast
Hadamard transform (dimension padded to a power of two). The hash of a vector is
the signed axis nearest to its rotation. A table concatenates as many of these
hashes as it takes for a bucket to hold ``BUCKET`` vectors on average, so buckets
don't grow with the table: (2 * dimension) ** hashes of them. There are ``TABLES`` tables; a
query looks into the buckets per table whose axes are nearest to its own rotations (multiprobe: ``PROBES``
with one hash, ``MORE`` times as many with every further one, least sum of squared
losses first).

All candidates are ranked by the exact inner product in double precision, summed
in the order of the components. A block keeps the k + 1 best of a query by (score,
smaller id): the matrix product only says which may be among them within its
rounding, ties included, and those are summed exactly.

Equal vectors are indexed once: of each distinct vector only its ``k + 1`` smallest
rows can ever be among k nearest with ties to the smaller id, so this loses nothing.
Buckets are cut into blocks of at most ``BLOCK`` vectors by a hash of the vector
(counted first), queries go to every block of their buckets, and a block is scored
as one matrix product, so a bucket that holds a third of all rows is spread.

Defined results: vectors that are null, empty, zero, or hold null or non-finite
components, or of another length than most, take no part (neither as queries); a
null id neither; rows that share an id are candidates each, also for each other, and one query for
every different vector; with fewer than k candidates all are returned; queries for which the tables gave
fewer than k go through an exact scan in blocks, so none comes out short; an empty
table gives an empty result."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..operators.globalorder import global_rank
from .common import materialize, table

TABLES = 12
PROBES, MORE = 8, 24
BUCKET = 8192             # vectors per bucket that are bearable: past this a table gets a further hash
BLOCK, QUERY_BLOCK = 512, 128   # vectors and queries of a bucket scored together
SEED = 7


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of the rows (length a power of two), scaled to a rotation."""
    n, h = x.shape[1], 1
    while h < n:
        x = x.reshape(-1, n // (2 * h), 2, h)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=2).reshape(-1, n)
        h *= 2
    return x / np.sqrt(n)


def rotate(x: np.ndarray, seed: int) -> np.ndarray:
    width = 1 << max(0, x.shape[1] - 1).bit_length()
    x = np.pad(x, ((0, 0), (0, width - x.shape[1])))
    random = np.random.default_rng(seed)
    for _ in range(3):
        x = hadamard(x * random.choice([-1.0, 1.0], width))
    return x


def _axes(unit: np.ndarray, seed: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``width`` nearest signed axes after a rotation, nearest first, and how
    much less (squared) the vector reaches along each than along the nearest."""
    r = rotate(unit, seed)
    near = np.concatenate([r, -r], axis=1)
    width = min(width, near.shape[1])
    best = np.argpartition(-near, width - 1, axis=1)[:, :width]
    order = np.argsort(np.take_along_axis(-near, best, 1), axis=1, kind="stable")
    best = np.take_along_axis(best, order, 1)
    reach = np.take_along_axis(near, best, 1)
    return best, (reach[:, :1] - reach) ** 2


def buckets(unit: np.ndarray, tables: int, probes: int, hashes: int = 1) -> np.ndarray:
    """[rows, tables, probes]: buckets (of ``hashes`` nearest signed axes each), nearest first."""
    axes = 2 << max(0, unit.shape[1] - 1).bit_length()
    out = np.empty((len(unit), tables, probes), np.int64)
    for t in range(tables):
        code, loss = _axes(unit, SEED * 1000 + t, probes)
        for h in range(1, hashes):
            more, further = _axes(unit, SEED * 1000 + t + 100_000 * h, probes)
            both = (loss[:, :, None] + further[:, None, :]).reshape(len(unit), -1)
            codes = (code[:, :, None].astype(np.int64) * axes + more[:, None, :]).reshape(len(unit), -1)
            width = min(probes, both.shape[1])
            best = np.argpartition(both, width - 1, axis=1)[:, :width]
            best = np.take_along_axis(best, np.argsort(np.take_along_axis(both, best, 1), axis=1, kind="stable"), 1)
            code, loss = np.take_along_axis(codes, best, 1), np.take_along_axis(both, best, 1)
        out[:, t, :code.shape[1]] = code
        out[:, t, code.shape[1]:] = code[:, :1]
    return out


def hashes_for(count: int, dimension: int, bucket: int = BUCKET) -> int:
    """Hashes to concatenate so that ``count`` vectors fill buckets with ``bucket`` each."""
    axes, hashes = 2 << max(0, dimension - 1).bit_length(), 1
    while count > bucket * axes ** hashes:
        hashes += 1
    return hashes


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, v) of the vectors that take part; v keeps its component type."""
    v = F.col("embedding")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).where(
        F.col("vec_id").isNotNull() & F.col("v").isNotNull()
        & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0))
    size = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    rows = rows.where(F.size("v") == (size[0]["d"] if size else 0))
    return rows.groupBy("vec_id", "v").agg(F.count(F.lit(1)).alias("times"))


def _hashed(batches, norm: float, lift: bool, tables: int, probes: int, hashes: int, stored: bool):
    """(id, v) -> a row per table and probe: t, bucket, id, v as double bytes."""
    for b in batches:
        if not len(b):
            continue
        x = b.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(b), -1)
        raw = pa.array([r.tobytes() for r in x], pa.binary())
        unit = x / norm
        if not stored:
            unit = x / np.linalg.norm(x, axis=1, keepdims=True)
        if lift:
            unit = np.column_stack([unit, np.sqrt(np.maximum(0, 1 - (unit * unit).sum(axis=1))) if stored else np.zeros(len(x))])
        h = buckets(unit, tables, probes, hashes)
        rows, t, _ = np.indices(h.shape)
        at = pa.array(rows.ravel())
        yield pa.RecordBatch.from_arrays(
            [pa.array(t.ravel(), pa.int32()), pa.array(h.ravel(), pa.int64()), b.column(0).take(at), raw.take(at)], ["t", "bucket", "id", "v"])


def exact_products(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Inner products of rows, summed one component after the other."""
    out, step = np.zeros(len(x)), max(1, 2_000_000 // max(1, x.shape[1]))
    for k in range(0, len(x), step):
        out[k:k + step] = np.cumsum(x[k:k + step] * y[k:k + step], axis=1)[:, -1] + 0.0
    return out


def best_of_block(q: np.ndarray, qv: np.ndarray, c: np.ndarray, cv: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, candidate, score) of the k best candidates per query by (score, smaller id)."""
    rough = qv @ cv.T
    n = min(k, len(c))
    least = np.partition(rough, len(c) - n, axis=1)[:, len(c) - n]
    # rounding of either sum: far below this share of the product of the norms
    margin = 1e-12 * np.linalg.norm(qv, axis=1) * np.linalg.norm(cv, axis=1).max() + 1e-300
    row, col = np.nonzero(rough >= (least - margin)[:, None])
    score = exact_products(qv[row], cv[col]) if len(row) else np.zeros(0)
    order = np.lexsort((c[col], -score, row))
    row, col, score = row[order], col[order], score[order]
    first = np.searchsorted(row, row)
    kept = np.arange(len(row)) - first < n
    return q[row[kept]], c[col[kept]], score[kept]


def _score(batches, k: int):
    """Block pairs (qids, qvs, cids, cvs) -> (qid, cid, score): the k best of each query there."""
    for b in batches:
        out = []
        for qs, qv, cs, cv in zip(*(b.column(c).to_pylist() for c in ("qids", "qvs", "cids", "cvs"))):
            q, c = np.array(qs, np.int64), np.array(cs, np.int64)
            out.append(best_of_block(q, np.frombuffer(b"".join(qv)).reshape(len(q), -1), c, np.frombuffer(b"".join(cv)).reshape(len(c), -1), k))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*out)], ["qid", "cid", "score"])


def _blocks(rows: DataFrame, key: list[str], size: int, name: str) -> DataFrame:
    """rows(key, id, v) -> (key, block, ids, vs): groups of about ``size`` rows,
    dealt by a hash after counting, so a hot bucket becomes many blocks."""
    counts = rows.groupBy(*key).agg(F.ceil(F.count(F.lit(1)) / size).alias("blocks"))
    dealt = rows.join(counts, key).withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")))
    return dealt.groupBy(*key, "block").agg(F.collect_list("id").alias(f"{name}ids"), F.collect_list("v").alias(f"{name}vs"))


def _candidates(queries: DataFrame, stored: DataFrame, key: list[str], k: int) -> DataFrame:
    """Both (key, id, v) -> distinct (qid, cid, score), the k best per query of every block it meets."""
    q = _blocks(queries, key, QUERY_BLOCK, "q").withColumnRenamed("block", "qblock")
    c = _blocks(stored, key, BLOCK, "c").withColumnRenamed("block", "cblock")
    met = q.join(c, key).select("qids", "qvs", "cids", "cvs").mapInArrow(lambda b: _score(b, k), "qid long, cid long, score double")
    best = met.repartition("qid").groupBy("qid", "cid").agg(F.max("score").alias("score"))
    ordered = best.withColumn("at", F.row_number().over(Window.partitionBy("qid").orderBy(F.desc("score"), "cid")))
    return ordered.where(F.col("at") <= k).select("qid", "cid", "score")


def nearest(vectors: DataFrame, is_query, k: int = 20, tables: int = TABLES, probes: int = PROBES, bucket: int = BUCKET) -> DataFrame:
    """vectors(vec_id, embedding) -> query_id, rank, vec_id, score: the k nearest
    found for each row that fulfils ``is_query`` (a Column over vec_id)."""
    rows = materialize(usable(vectors), "ann-vectors")
    # classes of equal vectors, numbered in the order of their smallest vec_id: ties go by that number
    found = rows.groupBy("v").agg(F.min("vec_id").alias("low"))
    classes = materialize(global_rank(found, [F.col("low").asc(), F.xxhash64("v").asc()], "id").select("v", "id"), "ann-classes")
    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    facts = classes.agg(F.max(length).alias("most"), F.min(length).alias("least"), F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("d")).first()
    norm = facts["most"] or 1.0
    lift = (facts["least"] or norm) < 0.99999 * norm
    hashes = hashes_for(facts["n"], (facts["d"] or 1) + lift, bucket)
    probes *= MORE ** (hashes - 1)
    of = rows.join(classes, "v")
    # of a class its k + 1 first rows, copies of a row one after the other
    each = of.select("id", "vec_id", F.explode(F.sequence(F.lit(1).cast("long"), F.least("times", F.lit(k + 1)))).alias("copy"))
    first = each.withColumn("at", F.row_number().over(Window.partitionBy("id").orderBy("vec_id", "copy"))).where(F.col("at") <= k + 1)
    members = materialize(first.select("id", "vec_id", "copy"), "ann-members")
    queries = materialize(of.where(is_query).select(F.col("vec_id").alias("query_id"), F.col("id").alias("qid")), "ann-queries")
    asked = queries.select(F.col("qid").alias("id")).distinct().join(classes, "id").select("id", "v")

    schema = "t int, bucket long, id long, v binary"
    index = classes.select("id", "v").mapInArrow(lambda b: _hashed(b, norm, lift, tables, 1, hashes, True), schema)
    looked = asked.mapInArrow(lambda b: _hashed(b, norm, lift, tables, probes, hashes, False), schema).dropDuplicates(["t", "bucket", "id"])
    found = materialize(_candidates(looked, index, ["t", "bucket"], k + 1), "ann-found")

    # a query whose buckets hold fewer than k others is answered by all vectors, in blocks
    total = members.count()
    have = found.join(members, found.cid == members.id).groupBy("qid").agg(F.count(F.lit(1)).alias("n"))
    short = materialize(asked.join(have, F.col("id") == F.col("qid"), "left").where(F.coalesce("n", F.lit(0)) < min(k + 1, total))
                        .select("id", "v"), "ann-short")
    if not short.isEmpty():
        parts = max(1, -(-facts["n"] // BLOCK))
        flat = lambda df: df.mapInArrow(lambda b: _hashed(b, norm, lift, 1, 1, 1, True), schema)
        part = F.pmod(F.xxhash64("id"), F.lit(parts))
        every = _candidates(flat(short).withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))).withColumn("part", F.col("part").cast("long")),
                            flat(classes.select("id", "v")).withColumn("part", part), ["part"], k + 1)
        found = found.join(short.select(F.col("id").alias("qid")), "qid", "left_anti").unionByName(every)

    # members of the classes found; the query's own row is its own class's first copy of its id
    near = queries.join(found, "qid").join(members.withColumnRenamed("id", "cid"), "cid").where("not (cid = qid and vec_id = query_id and copy = 1)")
    rank = F.row_number().over(Window.partitionBy("query_id", "qid").orderBy(F.desc("score"), "vec_id"))
    return near.select("query_id", rank.cast("int").alias("rank"), "vec_id", "score").where(F.col("rank") <= k)


def op4_cross_polytope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)
