import random
import zlib

import numpy as np

from flowlens.llm import toxicity as T
from flowlens.llm.common import Memo, word_hash

from .helpers import documents, labels, odd_rows


def test_features_are_the_distinct_words_and_pairs():
    memo = Memo(word_hash)
    one, two = T.hashed_features("A b, c", memo), T.hashed_features("a B\nc", memo)
    assert (one == two).all() and len(one) == 3 + 2 + 1
    assert len(T.hashed_features(None, memo)) == 0 and len(T.hashed_features("x", memo)) == 1
    assert set(T.hashed_features("a b", memo)) != set(T.hashed_features("b a", memo))


def test_ftrl_against_the_published_updates():
    r = np.random.default_rng(1)
    model = T.Ftrl(8, l1=0.3, alpha=0.5, beta=1.0, l2=0.1)
    z, n, bz, bn = [0.0] * 8, [0.0] * 8, 0.0, 0.0

    def weight(i):
        if abs(z[i]) <= 0.3:
            return 0.0
        return -(z[i] - np.sign(z[i]) * 0.3) / ((1.0 + n[i] ** 0.5) / 0.5 + 0.1)
    for _ in range(200):
        x, y = np.flatnonzero(r.random(8) < 0.4), int(r.random() < 0.5)
        w = {i: weight(i) for i in x}
        b = -bz / ((1.0 + bn ** 0.5) / 0.5)
        g = 1 / (1 + np.exp(-(sum(w.values()) + b))) - y
        for i in x:
            z[i] += g - ((n[i] + g * g) ** 0.5 - n[i] ** 0.5) / 0.5 * w[i]
            n[i] += g * g
        bz += g - ((bn + g * g) ** 0.5 - bn ** 0.5) / 0.5 * b
        bn += g * g
        model.learn(x, y)
    assert np.allclose(model.z, z) and np.allclose(model.n, n)


def corpus(n=1500):
    r = random.Random(1)
    insults = ["vileword", "nastyword", "meanword"]
    rows, marks = [], []
    for k in range(n):
        words = r.choices([f"w{j}" for j in range(500)], k=40)
        toxic = k % 7 == 0
        if toxic:
            for _ in range(2):
                words[r.randrange(40)] = r.choice(insults)
        rows.append((k, " ".join(words)))
        marks.append((k, 1, int(toxic)))
    return rows, marks


def test_held_out_accuracy_and_sparsity(spark):
    rows, marks = corpus()
    docs, marked = documents(spark, rows), labels(spark, marks)
    model = T.train(docs, marked)
    assert 0 < len(model["at"]) < 2000
    got = T.toxicity(docs, marked).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    held = [r for r in got if r.held_out]
    assert np.mean([r.predicted == int(r.doc_id % 7 == 0) for r in held]) > 0.97
    # labels of held-out rows change nothing
    flipped = labels(spark, [(k, q, 1 - t if zlib.crc32(str(k).encode()) % 5 == 0 else t) for k, q, t in marks])
    assert sorted((r.doc_id, r.score) for r in T.toxicity(docs, flipped).collect()) == sorted((r.doc_id, r.score) for r in got)
    kept = T.keep_clean(docs, marked)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in got if not r.predicted}


def test_odd_rows(spark):
    docs = documents(spark, odd_rows())
    for marks in ([], [(1, 1, 1), (None, 1, 0), (4, 1, None), (5, 0, 0), (5, 0, 1)]):
        got = T.toxicity(docs, labels(spark, marks)).collect()
        assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
        assert len({r.score for r in got if r.doc_id in (1, 2, 3)}) == 1
    empty = documents(spark, [])
    assert T.toxicity(empty, labels(spark, [])).collect() == []


def test_labels_that_teach_nothing_reject_nothing(spark):
    """No labels, or one class only: no verdict, so the corpus stays."""
    docs = documents(spark, corpus(60)[0])
    for marks in ([], [(k, 1, 1) for k in range(60)], [(k, 1, 0) for k in range(60)], [(k, None, None) for k in range(60)]):
        marked = labels(spark, marks)
        assert T.keep_clean(docs, marked).count() == 60
        scores = {r.score for r in T.toxicity(docs, marked).collect()}
        assert len(scores) == 1 and (scores.pop() < 0.5 or marks[0][2] == 1)


def test_sample_is_bounded_by_rows(spark):
    """One id repeated over a third of the rows is one training text; always the same one."""
    rows, marks = corpus(200)
    hot = [(7, f"other text {k} of the repeated id") for k in range(3000)]
    docs = documents(spark, rows + hot)
    for n in (10, 1000):
        sample = T.training_rows(docs, labels(spark, marks), n).collect()
        assert len(sample) <= n and len({r.doc_id for r in sample}) == len(sample)
    assert zlib.crc32(b"7") % 5 and 7 in {r.doc_id for r in sample}
    again = T.training_rows(docs.repartition(13), labels(spark, marks), 1000).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, sample))


def test_columns_of_any_name_stay(spark):
    rows, marks = corpus(300)
    docs = documents(spark, rows).selectExpr("*", "1 as toxicity", "2 as __toxicity", "3 as `a.b`")
    kept = T.keep_clean(docs, labels(spark, marks))
    assert kept.columns == docs.columns and 0 < kept.count() < 300
