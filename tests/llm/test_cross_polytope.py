import numpy as np
import pytest
from pyspark.sql import functions as F

from flowlens.llm import cross_polytope as C

SCHEMA = "vec_id long, embedding array<float>, label int, score double, id long, v string"


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 1, 0.0, 1, "x") for i, v in rows], SCHEMA)


def brute(rows, k, modulo):
    """Every different (id, vector) is a query; candidates are all rows but one copy of it."""
    every = []
    for i, v in rows:
        if i is not None and v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v):
            every.append((i, tuple(float(np.float32(x)) for x in v)))
    out = {}
    for q in set(every):
        if q[0] % modulo == 0:
            others = list(every)
            others.remove(q)
            scores = [(-sum(a * b for a, b in zip(q[1], v)), i) for i, v in others]
            out.setdefault(q[0], []).append([(i, -s) for s, i in sorted(scores)[:k]])
    return {q: sorted(x for near in lists for x in near) if len(lists) > 1 else lists[0] for q, lists in out.items()}


def run(spark, rows, k=20, modulo=20, **how):
    out = {}
    for r in sorted(C.nearest(frame(spark, rows), F.col("vec_id") % modulo == 0, k, **how).collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    for q, near in out.items():
        ranks = [n for n, *_ in near]
        several = ranks.count(1)
        assert ranks == sorted(list(range(1, len(ranks) // several + 1)) * several)
        out[q] = [x[1:] for x in near] if several == 1 else sorted(x[1:] for x in near)
    return out


def test_rotation_and_axes():
    x = np.random.default_rng(0).normal(size=(5, 48))
    r = C.rotate(x, 3)
    assert r.shape == (5, 64) and np.allclose((r * r).sum(1), (x * x).sum(1))
    h = C.buckets(x, 2, 4)
    both = np.concatenate([C.rotate(x, C.SEED * 1000), -C.rotate(x, C.SEED * 1000)], axis=1)
    assert (h[:, 0, :] == np.argsort(-both, axis=1)[:, :4]).all()


def test_recall_and_exact_scores(spark):
    r = np.random.default_rng(1)
    centres = r.normal(size=(8, 32))
    rows = [(k, v / np.linalg.norm(v)) for k, v in enumerate(centres[r.integers(0, 8, 1500)] + r.normal(size=(1500, 32)))]
    got, want = run(spark, rows), brute(rows, 20, 20)
    assert got.keys() == want.keys()
    assert np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 20 for q in want]) >= 0.9
    vectors = dict(rows)
    for q, near in got.items():
        assert len(near) == 20 and near == sorted(near, key=lambda x: (-x[1], x[0]))
        for i, s in near:
            assert s == pytest.approx(float(np.dot(vectors[q].astype(np.float32).astype(float), vectors[i].astype(np.float32).astype(float))), abs=1e-12)


def test_odd_vectors_ties_and_copies(spark):
    nan, inf = float("nan"), float("inf")
    same = [1.0, 2.0, 0.0, 0.5]
    rows = [(k, same) for k in range(0, 120, 2)] + [(200 + k, [k % 5, 1.0, -k, 2.0]) for k in range(30)]
    rows += [(301, None), (302, [0.0] * 4), (303, [nan, 1, 1, 1]), (304, [inf, 1, 1, 1]), (305, [None, 1.0, 1.0, 1.0]), (306, [1.0]), (None, same), (2, [9.0, 9.0, 9.0, 9.0]), (2, same)]
    assert run(spark, rows, 20, 20) == brute([r for r in rows if r[0] != 306], 20, 20)


def test_many_ties_keep_the_smallest_ids(spark):
    """Hundreds of different vectors at the same score, in one block and over several."""
    r = np.random.default_rng(5)
    rows = []
    for k in range(700):
        v = r.choice([-1.0, 1.0], 16)
        rows.append((k + 1, [1.0, *v]))
    rows += [(20 * k + 10_000, [1.0] + [0.0] * 16) for k in range(3)]
    rows = [(i, v) for i, v in rows if i % 20 or i >= 10_000]
    assert run(spark, rows, 20, 20) == brute(rows, 20, 20)
    q, qv = np.array([5]), np.ones((1, 4))
    c, cv = np.arange(300)[::-1].copy(), np.ones((300, 4))
    assert C.best_of_block(q, qv, c, cv, 20)[1].tolist() == list(range(20))


def test_concatenated_hashes(spark):
    """Small buckets ask for two hashes per table; recall holds with the probes that go with them."""
    r = np.random.default_rng(6)
    centres = r.normal(size=(8, 32))
    rows = [(k, v / np.linalg.norm(v)) for k, v in enumerate(centres[r.integers(0, 8, 1500)] + r.normal(size=(1500, 32)))]
    assert C.hashes_for(1500, 32, 16) == 2 and C.hashes_for(1500, 32) == 1
    got, want = run(spark, rows, bucket=16), brute(rows, 20, 20)
    assert np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 20 for q in want]) >= 0.9


def test_buckets_of_two_hashes():
    x = np.random.default_rng(0).normal(size=(5, 8))
    h = C.buckets(x, 1, 3, 2)
    one, two = (np.concatenate([C.rotate(x, s), -C.rotate(x, s)], axis=1) for s in (C.SEED * 1000, C.SEED * 1000 + 100_000))
    for k in range(5):
        a, b = np.argsort(-one[k])[:3], np.argsort(-two[k])[:3]
        loss = {int(i) * 16 + int(j): (one[k].max() - one[k][i]) ** 2 + (two[k].max() - two[k][j]) ** 2 for i in a for j in b}
        assert h[k, 0].tolist() == sorted(loss, key=loss.get)[:3]


def test_few_and_no_vectors(spark):
    rows = [(k, [1.0, k]) for k in range(5)]
    assert run(spark, rows, 20, 2) == brute(rows, 20, 2)
    assert run(spark, []) == {} and run(spark, [(1, None)]) == {}


def test_short_queries_are_answered_in_full(spark):
    """One table and one probe leave queries short: the exact scan fills them."""
    r = np.random.default_rng(4)
    rows = [(k, r.normal(size=16)) for k in range(400)]
    got, want = run(spark, rows, tables=1, probes=1), brute(rows, 20, 20)
    assert all(len(got[q]) == 20 for q in want)
