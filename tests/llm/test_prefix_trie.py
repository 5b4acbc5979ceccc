import hashlib
import random
import zlib

import pytest

from flowlens.llm import prefix_trie as P

ROWS = "conv_id long, turn long, role string, text string, node long, depth string, t0 int"


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 2) for r in rows], ROWS)


def brute_sequences(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            own.setdefault(c, []).append(((turn is not None, turn or 0), hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest(), role, text))
    own = {c: [(r, t) for *_, r, t in sorted(v)] for c, v in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - c % 5 if c >= 0 else c + (-c) % 5
        out[c] = own.get(base, [])[:h] + turns[h:]
    return out


def brute(sequences):
    nodes = {}
    for c, turns in sequences.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(c)
    kids = {}
    for p in nodes:
        if p:
            kids.setdefault(p[:-1], []).append(p)

    def sums(p):
        got = [0 if kids.get(p) else 1, (len(nodes[p]) - 1) * len(p[-1][1].encode()) if p else 0]
        for k in kids.get(p, ()):
            got = [x + y for x, y in zip(got, totals[k])]
        return got
    totals = {}
    for p in sorted(nodes, key=len, reverse=True):
        totals[p] = sums(p)
    return sorted(((min(m), len(p), min(nodes[p[:-1]]) if p else None, len(m), len(kids.get(p, ())), *totals[p],
                    hashlib.sha256(",".join(str(c) for c in sorted(m) if len(sequences[c]) == len(p)).encode()).hexdigest()) for p, m in nodes.items()), key=str)


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def trie(spark, rows):
    return P.trie(*P.rebuilt(P.numbered_turns(table(spark, rows))))


def conversation(c, texts):
    return [(c, k, "user" if k % 2 == 0 else "assistant", t) for k, t in enumerate(texts)]


def test_against_brute_force(spark):
    r = random.Random(4)
    rows = []
    for c in range(120):
        long = r.random() < 0.15
        rows += conversation(c, [r.choice(["a", "bb", "ccc é", ""]) if k < 3 or not long else f"{r.randrange(3)}" for k in range(r.randrange(25, 60) if long else r.randrange(1, 9))])
    r.shuffle(rows)
    assert result(trie(spark, rows)) == brute(brute_sequences(rows))


def test_long_shared_prefixes_and_copies(spark):
    """Sequences that agree over several blocks, end inside and at the edge of blocks, and come many times."""
    base = [f"t{k}" for k in range(40)]
    sequences = {}
    for c, (n, tail) in enumerate([(40, []), (40, []), (40, ["x"]), (8, []), (16, []), (16, ["y"] * 10), (16, ["y"] * 10), (17, ["z"]), (24, ["q"] * 30), (0, []), (0, []), (3, []), (24, ["q"] * 30)]):
        sequences[100 + c] = [("user", t) for t in base[:n] + tail]
    turns = spark.createDataFrame([(c, k + 1, f"{r}|{t}".encode(), len(t)) for c, s in sequences.items() for k, (r, t) in enumerate(s)], "conv_id long, pos long, id binary, bytes long")
    convs = spark.createDataFrame([(c,) for c in sequences], "conv_id long")
    assert result(P.trie(turns, convs)) == brute(sequences)


@pytest.mark.parametrize("rows", [
    [(None, 1, "user", "x"), (1, None, "user", None), (1, 1, None, "é" * 300), (1, 1, None, "é" * 300), (5, 2, "user", ""), (-7, 1, "user", "x"), (-7, 2, "user", "x" * 200_000)],
    [(3, 1, "user", "only")],
    [(c, k, "user", "same") for c in range(30) for k in range(3)],
])
def test_odd_rows(spark, rows):
    assert result(trie(spark, rows)) == brute(brute_sequences(rows))


def test_empty_table_and_turnless_conversations(spark):
    assert trie(spark, []).collect() == []
    turnless = P.trie(spark.createDataFrame([], "conv_id long, pos long, id binary, bytes long"), spark.createDataFrame([(4,), (2,)], "conv_id long"))
    assert result(turnless) == brute({4: [], 2: []})
