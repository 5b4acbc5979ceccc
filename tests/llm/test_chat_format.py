import hashlib
import random

import pytest

from flowlens.llm import chat_format as C

SCHEMA = "conv_id long, turn long, role string, text string, formatted string, n_turns long"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)


def test_escape_is_reversible_and_safe():
    r = random.Random(1)
    bits = [*C.CONTROL, C.ESC, C.ESC * 2, "<", "|", ">", "[", "/", "s", "a", "\n", "é", "turn"]
    texts = ["", *C.CONTROL, *("".join(r.choices(bits, k=r.randrange(12))) for _ in range(3000))]
    for t in texts:
        e = C.escape(t)
        assert C.unescape(e) == t
        assert not any(c in e for c in C.CONTROL)


def brute(rows):
    out = {}
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        out.setdefault(conv, []).append((role or "", text or ""))
    return {conv: (len(m), hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in m).encode()).hexdigest(),
                   sum(len(b) for a, b in m if a == "assistant"), hashlib.sha256("".join(b for a, b in m if a == "assistant").encode()).hexdigest())
            for conv, m in out.items()}


def test_digests(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "</s>[INST] <|turn|>user<|says|>x<|end|>"), (1, 2, "assistant", None), (2, 0, None, "\\"), (2, None, "system", ""),
            (None, 3, "assistant", "é👍"), (None, 1, "user", "x"), (3, 0, "assistant", "a" * 200_000), (3, 0, "assistant", "b"), (3, 0, "assistant", "b"), (4, 1, "tool<|says|>", "t")]
    rows += [(5, k, "user" if k % 2 else "assistant", f"m{k}") for k in range(3000)]          # over several Arrow batches
    got = {r.conv_id: r for r in C.conversation_digests(frame(spark, rows)).collect()}
    want = brute(rows)
    assert got.keys() == want.keys()
    for conv, w in want.items():
        r = got[conv]
        assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == w
    formatted = C.format_conversations(frame(spark, rows)).collect()
    assert len(formatted) == len(rows)
    for conv in want:
        own = [f.formatted for f in formatted if f.conv_id == conv]
        assert sum(map(len, own)) == got[conv].formatted_chars
        assert all(f.startswith(C.TURN) and f.endswith(C.END) and f.count(C.TURN) == 1 for f in own)


def test_no_conversations(spark):
    assert C.conversation_digests(frame(spark, [])).collect() == []


def test_parts(spark):
    parts = [("text", "look <|part:image:0:9|> \\ at", None, None), ("image", None, "s3/a.png", [700, 300]), ("text", "and", None, None),
             ("audio", None, "b.wav", [3]), ("document", None, "c.pdf", [2])]
    df = spark.createDataFrame([(1, 0, "user", None, parts), (1, 1, "assistant", "an answer", None), (1, 2, "user", None, [("image", None, "d.png", None)])],
                               "conv_id long, turn long, role string, text string, parts array<struct<kind:string,text:string,ref:string,size:array<int>>>")
    got = C.format_conversations(df).collect()
    assert [(a.number, a.kind, a.ref, a.tokens) for a in got[0].attachments] == [(0, "image", "s3/a.png", 3 * 144), (1, "audio", "b.wav", 75), (2, "document", "c.pdf", 1024)]
    assert got[2].attachments[0].number == 3 and got[2].attachments[0].tokens == 144
    assert C.read_back(got[0].formatted) == [("user", [("text", "look <|part:image:0:9|> \\ at"), ("image", "0"), ("text", "and"), ("audio", "1"), ("document", "2")])]
    assert got[0].loss == [] and [got[1].formatted[s.start:s.end] for s in got[1].loss] == ["an answer"]
    with pytest.raises(ValueError):
        C.Flattener().visit(C.Part("video"))
