import random

import numpy as np
import pytest

from flowlens.llm import ngram_join as J
from flowlens.llm.common import Memo, word_hash
from flowlens.llm.components import components

from .helpers import documents, odd_rows


def shingles(text, size):
    import re
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return set()
    return {tuple(words)} if len(words) < size else {tuple(words[k:k + size]) for k in range(len(words) - size + 1)}


def brute(rows, size, percent):
    sets = [shingles(t, size) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                parent[find(i)] = find(j)
    out = []
    for i, (doc, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        out.append((doc, len(sets[i]), min(ids, default=None) if sets[i] else doc))
    return sorted(out, key=str)


def corpus(seed, n=60):
    r = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(400)]
    passage = r.choices(vocabulary, k=30)
    rows = []
    for k in range(n):
        words = r.choices(vocabulary, k=r.choice([1, 2, 3, 8, 40, 90]))
        if k % 3 == 0:
            words = passage + words
        if rows and k % 2:
            words = (rows[r.randrange(len(rows))][1] or "x").split()
            for _ in range(r.choice([0, 0, 1, 1, 2, 5])):
                if words:
                    words[r.randrange(len(words))] = r.choice(vocabulary)
        rows.append((r.choice([k, k, k + 1000]), " ".join(words)))
    return rows


@pytest.mark.parametrize("size,percent,seed", [(3, 90, 1), (5, 80, 2), (3, 60, 3)])
def test_against_all_pairs(spark, size, percent, seed):
    rows = corpus(seed)
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in J.jaccard_classes(documents(spark, rows), size, percent).collect()), key=str)
    assert got == brute(rows, size, percent)


def test_large_group_of_near_copies(spark, monkeypatch):
    """One original and many copies with a few words changed: rounds, heads and differences."""
    r = random.Random(5)
    base = [f"b{k}" for k in range(120)]
    rows = []
    for k in range(150):
        words = list(base)
        for _ in range(r.randrange(5)):
            words[r.randrange(len(words))] = f"e{r.randrange(10 ** 6)}"
        rows.append((k, " ".join(words)))
    monkeypatch.setattr(J, "FINISH", 0.01)          # leader rounds too
    got = sorted(((x.doc_id, x.n_shingles, x.component_id) for x in J.jaccard_classes(documents(spark, rows), 3, 90).collect()), key=str)
    assert got == brute(rows, 3, 90)


def test_odd_rows(spark):
    rows = odd_rows([(9, "ONE"), (10, "one two"), (11, "One\ttwo"), (None, "no id here at all")])
    got = sorted(((x.doc_id, x.n_shingles, x.component_id) for x in J.jaccard_classes(documents(spark, rows), 3, 90).collect()), key=str)
    assert got == brute(rows, 3, 90)
    kept = J.keep_one(documents(spark, rows), 3, 90)
    assert kept.columns == documents(spark, rows).columns
    assert sorted((str(x.doc_id) for x in kept.collect())) == sorted(["1", "2", "3", "4", "5", "6", "10", "None"])


def test_no_documents(spark):
    assert J.jaccard_classes(documents(spark, []), 3, 90).collect() == []
    assert J.keep_one(documents(spark, [(1, None)]), 3, 90).count() == 1


def test_sketch_bounds_the_intersection():
    memo = Memo(word_hash)
    for seed in range(40):
        r = random.Random(seed)
        make = lambda n: J.shingle_set(" ".join(f"w{r.randrange(300)}" for _ in range(n)), 2, memo)
        a, b = make(r.choice([3, 50, 2000])), make(r.choice([3, 50, 2000]))
        assert J.most_shared(J.sketch(a), J.sketch(b)) >= len(np.intersect1d(a, b))
        assert J.most_shared(J.sketch(a), J.sketch(a)) == len(a)


def test_prefix_choice():
    assert J.choose_prefix(100, np.zeros(0, np.int64), 100, 90) == 1
    assert J.choose_prefix(2, np.full(98, 1000), 100, 90) > 1


def test_components(spark):
    r = random.Random(3)
    edges = [(r.randrange(200), r.randrange(200)) for _ in range(150)] + [(500 + k, 501 + k) for k in range(40)] + [(None, 1), (7, 7)]
    got = {x.node: x.root for x in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x
    for a, b in edges:
        if a is not None and a != b:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    assert got == {x: find(x) for x in root if find(x) != x}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
