import random

import numpy as np
import pytest

from flowlens.llm import line_dedup as L

from .helpers import documents, odd_rows


def brute(rows):
    """[(doc_id, n_lines, n_dropped, text)], by the definition."""
    def key(line):
        k = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))
        return k if len(k) >= 10 else None
    order = lambda i: (i is None, i)
    holders = {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            if key(line) is not None:
                holders.setdefault(key(line), set()).add(order(i))
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if key(x) is None or len(holders[key(x)]) < 2 or min(holders[key(x)]) == order(i)]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def corpus(n=60, seed=3):
    r = random.Random(seed)
    pool = [f"Shared line number {k} of all" for k in range(40)] + ["short", "tiny é", "", "   ", "ÄÖÜ shared é line", "日本語の行です、共有"]
    rows = []
    for i in range(n):
        lines = [r.choice(["", "\t ", " "]) + (x.upper() if r.random() < 0.2 and x.isascii() else x) + r.choice(["", " \r", "\x0b"]) for x in r.choices(pool, k=r.randrange(6))]
        rows.append((i, "\n".join([*lines, f"own line of document {i}", *(["common to every document"] if i % 3 else [])])))
    return rows


def result(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_lines", "n_dropped", "text").collect()), key=str)


def test_against_brute_force(spark):
    rows = corpus() + odd_rows([(70, "common to every document\n" * 5), (3, "another row of three\nCommon to every document  ")])
    docs = documents(spark, rows)
    index = L.build(docs)
    assert result(L.dedup(index, docs)) == brute(rows)


def test_incremental_and_reversible(spark):
    rows = corpus(90)
    first, second = rows[30:], rows[:30]          # the later batch has the smaller ids: owners change
    index = L.insert(L.build(documents(spark, first)), documents(spark, second))
    everything = documents(spark, rows)
    assert result(L.dedup(index, everything)) == brute(rows)
    gone = [(k,) for k in range(0, 90, 4)]
    index = L.delete(index, spark.createDataFrame(gone, "doc_id long"))
    left = [r for r in rows if (r[0],) not in gone]
    assert result(L.dedup(index, documents(spark, left))) == brute(left)
    # what is in the exact tables is what a fresh index would hold, and the filters answer for it
    fresh = L.build(documents(spark, left))
    exact = lambda i: sorted(tuple(r) for r in i.refs.select("k1", "k2", "n", "owner", "last").collect())
    assert exact(index) == exact(fresh)
    filters = {r.shard: L.Cuckoo.read(r.slots, r.rest) for r in index.filters.collect()}
    total = 0
    for k1, k2, _, owner, last in exact(index):
        copies = 1 + (owner < last)
        total += copies
        assert filters[k2 % index.shards].count(np.array([k1]))[0] >= copies
    assert sum(int((f.slots != 0).sum()) + len(f.rest) for f in filters.values()) == total
    # and back: inserting the removed documents again gives the first state
    back = L.insert(index, documents(spark, [r for r in rows if (r[0],) in gone]))
    assert result(L.dedup(back, everything)) == brute(rows)


def test_more_shards_when_outgrown(spark, monkeypatch):
    monkeypatch.setattr(L, "SHARD_KEYS", 16)
    rows = corpus(80)
    index = L.build(documents(spark, rows[:10]))
    grown = L.insert(index, documents(spark, rows[10:]))
    assert grown.shards > index.shards and grown.filters.count() > 1
    assert result(L.dedup(grown, documents(spark, rows))) == brute(rows)


def test_empty_tables(spark):
    empty = documents(spark, [])
    index = L.build(empty)
    assert L.dedup(index, empty).collect() == []
    index = L.insert(index, documents(spark, corpus(5)))
    assert result(L.dedup(index, documents(spark, corpus(5)))) == brute(corpus(5))
    index = L.delete(index, spark.createDataFrame([(k,) for k in range(5)], "doc_id long"))
    assert index.refs.isEmpty() and index.postings.isEmpty()


@pytest.mark.parametrize("copies", [1, 3, 12])
def test_cuckoo_filter(copies):
    """Nothing is lost at any fill; what finds no place is kept beside it."""
    r = np.random.default_rng(copies)
    keys = r.integers(-2**63, 2**63, 3000)
    own = L.Cuckoo.sized(len(keys))
    for _ in range(copies):
        own.add(keys)
    own = L.Cuckoo.read(*own.written())
    assert (own.count(keys) >= copies).all()
    assert int((own.slots != 0).sum()) + len(own.rest) == copies * len(keys)
    strangers = r.integers(-2**63, 2**63, 20000)
    if copies == 1:
        assert (own.count(strangers) > 0).mean() < 0.001 and not len(own.rest)
    own.remove(np.repeat(keys[:1000], copies))
    assert (own.count(keys[1000:]) >= copies).all() and (own.count(keys[:1000]) > 0).mean() < 0.05
    with pytest.raises(ValueError):
        L.Cuckoo.sized(10).remove(keys[:1])
