import random

import numpy as np

from flowlens.llm import ordinal_quality as O

from .helpers import documents, labels, odd_rows


def test_gradient():
    r = np.random.default_rng(0)
    s, y, t = r.normal(size=20) * 2, r.integers(0, 4, 20), np.array([-1.0, 0.2, 1.1])
    value, by_s, by_t = O.gradient(s, y, t)
    assert np.allclose((O.gradient(s + 1e-6, y, t)[0] - value) / 1e-6, by_s, atol=1e-4)
    for k in range(3):
        t2 = t.copy()
        t2[k] += 1e-6
        assert np.allclose((O.gradient(s, y, t2)[0] - value) / 1e-6, by_t[:, k], atol=1e-4)


def corpus(n=900):
    r = random.Random(3)
    grades = {0: [f"bad{k}###" for k in range(30)], 1: [f"mid{k}" for k in range(30)], 2: [f"fine{k}" for k in range(30)]}
    rows, marks = [], []
    for k in range(n):
        g = k % 3
        rows.append((k, " ".join(r.choices(grades[g], k=6) + r.choices([f"w{j}" for j in range(300)], k=20))))
        marks.append((k, int(g > 0), int(g == 1)))
    return rows, marks


def test_held_out_grades(spark):
    import zlib

    rows, marks = corpus()
    docs, marked = documents(spark, rows), labels(spark, marks)
    got = {r.doc_id: r for r in O.rate(docs, O.train(docs, O.graded(marked))).collect()}
    held = [k for k, _ in rows if zlib.crc32(str(k).encode()) % 5 == 0]
    assert len(got) == len(rows)
    assert all(1 >= r.tail_1 >= r.tail_2 >= 0 and abs(r.expected_grade - r.tail_1 - r.tail_2) < 1e-12 for r in got.values())
    means = [np.mean([got[k].expected_grade for k in held if k % 3 == g]) for g in range(3)]
    assert means[0] + 0.4 < means[1] < means[2] - 0.3
    assert np.mean([got[k].kept == (k % 3 > 0) for k in held]) > 0.95


def test_odd_rows(spark):
    docs = documents(spark, odd_rows())
    nothing = O.rate(docs, O.train(docs, O.graded(labels(spark, [])))).collect()
    assert len(nothing) == docs.count() and all(abs(r.expected_grade - 1) < 1e-9 for r in nothing)
    some = O.rate(docs, O.train(docs, O.graded(labels(spark, [(1, 1, None), (4, 0, 1), (4, 1, 1), (5, None, 1), (None, 1, 1)])))).collect()
    assert len(some) == docs.count() and len({(r.expected_grade) for r in some if r.doc_id in (1, 2)}) == 1
    empty = documents(spark, [])
    assert O.rate(empty, O.train(empty, O.graded(labels(spark, [])))).collect() == []


def test_scores_against_a_plain_loop(spark):
    """Training sample, features, thresholds and tails, recomputed row by row."""
    import re
    import zlib

    from flowlens.llm.common import Memo, word_hash

    rows, marks = corpus(300)
    docs, marked = documents(spark, rows + [(3, "a second text of three"), (3, "a second text of three")]), labels(spark, marks)
    model = O.train(docs, O.graded(marked))
    weight = dict(zip(model["at"].tolist(), model["weight"].tolist()))

    def features(text):
        words = text.encode().split()
        kinds = [re.sub(rb"(.)\1+", rb"\1", re.sub(rb"[A-Z]", b"A", re.sub(rb"[a-z]", b"a", re.sub(rb"[0-9]", b"0", w.replace(b"A", b"B")))).replace(b"B", b"A")) for w in words]
        own = {word_hash(b"w" + w.lower()) % (1 << O.BITS) for w in words}
        out = {}
        for x in own:
            out[x] = out.get(x, 0) + 1 / len(own) ** 0.5
        shapes = [word_hash(b"s" + k[:6] + b"%d" % min(len(w) // 8, 4)) % (1 << O.BITS) for k, w in zip(kinds, words)]
        for x in set(shapes):
            out[x] = out.get(x, 0) + 2 * (shapes.count(x) / len(words)) ** 0.5
        lines = [x for x in text.split("\n") if x.strip()]
        for k, v in enumerate([1 - len(set(lines)) / max(1, len(lines)), 1 - len(own) / max(1, len(words)), 1 / (1 + len(words) / 10)]):
            x = word_hash(b"e%d" % k) % (1 << O.BITS)
            out[x] = out.get(x, 0) + 2 * v
        return out
    got = {}
    for r in O.rate(docs, model).collect():
        got.setdefault(r.doc_id, []).append(r)
    for i, text in rows[:60]:
        if i == 3:
            continue
        s = sum(weight.get(x, 0) * v for x, v in features(text).items())
        tails = [1 / (1 + np.exp(-(s - t))) for t in model["thresholds"]]
        assert abs(got[i][0].tail_1 - tails[0]) < 1e-4 and abs(got[i][0].tail_2 - tails[1]) < 1e-4 and got[i][0].kept == (tails[0] >= 0.5)
    # the model is the one that the same sample gives outside Spark
    memo, usable = Memo(O._describe), [k for k, *_ in marks if zlib.crc32(str(k).encode()) % 5]
    hashes = {r.doc_id: r.h for r in docs.selectExpr("doc_id", "xxhash64(doc_id) as h").collect()}
    texts = dict(rows)
    grade = {k: 0 if q == 0 else 1 if t else 2 for k, q, t in marks}
    second = {r.text: r.h for r in docs.where("doc_id = 3").selectExpr("text", "xxhash64(text) as h").collect()}
    texts[3] = min(second, key=second.get)
    data = [(*O.text_features(texts[k], memo), grade[k]) for k in sorted(usable, key=lambda k: hashes[k])]
    w, thresholds = O.fit(data)
    assert np.allclose(thresholds, model["thresholds"], atol=1e-6)
    assert np.allclose([w[x] for x in model["at"][:200]], model["weight"][:200], atol=1e-4)


def test_sample_is_bounded_by_rows(spark):
    from flowlens.llm.common import bounded_sample, sampled_texts

    rows, marks = corpus(100)
    docs = documents(spark, rows + [(4, f"text {k}") for k in range(2000)])
    sample = bounded_sample(O.graded(labels(spark, marks)), "doc_id", 50)
    texts = sampled_texts(docs, sample).collect()
    assert len(texts) == 50 == len({r.doc_id for r in texts})
