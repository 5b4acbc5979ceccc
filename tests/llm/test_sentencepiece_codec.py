import random
import struct

import numpy as np
import pytest

from flowlens.llm import sentencepiece_codec as S

from .helpers import documents, odd_rows

TEXTS = ["", " ", "a  b", " lead", "trail ", "plain words only here", "é ü ß 日本 👍🏽", "tab\there\nline", "\x00\x01", "a▁b", "▁", "x" * 5000, "don't  stop -- 12,345.67", "   ", "\r\n"]


@pytest.fixture(scope="module")
def reference():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=S.model_path())


def test_parity_and_round_trip(reference):
    r = random.Random(1)
    letters = "abcdefghij ABCDE  éüß日本👍\n\t.,;#12345▁"
    texts = TEXTS + ["".join(r.choices(letters, k=r.randrange(200))) for _ in range(400)]
    codec = S.Codec(S.model_path())
    assert codec.separable
    for t, ids in zip(texts, codec.encode(texts)):
        expected = reference.encode(t)
        assert np.frombuffer(ids, "<u4").tolist() == expected
        assert codec.decode(ids) == reference.decode(expected)
        assert "▁" in t or codec.decode(ids) == t
        assert codec.tokenizer.decode(expected) == reference.decode(expected)


def test_round_trip_by_words_equals_decoding(reference):
    """The decoded text put together from words is what decoding the ids gives,
    also after the memo was emptied, and for words that don't decode to themselves."""
    r = random.Random(2)
    letters = "abcdefghij ABCDE  éüß日本👍\n\t.,;#12345▁"
    codec = S.Codec(S.model_path())
    for _ in range(3):
        texts = TEXTS + ["".join(r.choices(letters, k=r.randrange(80))) for _ in range(200)]
        ids, back = codec.round_trip(texts)
        assert ids == codec.encode(texts) and back == [codec.decode(i) for i in ids]
        codec.memo.clear()
    codec.bytes_of[reference.encode("here")[-1]] = b"?"      # a table that doesn't decode alike
    codec.memo.clear()
    ids, back = codec.round_trip(["plain words only here", "plain words"])
    assert back == [codec.decode(i) for i in ids] and back[0] != "plain words only here" and back[1] == "plain words"
    assert codec.odd and S.Codec(S.model_path()).same_pieces(reference)


def message(*items):
    def varint(n):
        out = b""
        while n > 127:
            out, n = out + bytes([n & 127 | 128]), n >> 7
        return out + bytes([n])
    out = b""
    for number, value in items:
        if isinstance(value, bytes):
            out += varint(number << 3 | 2) + varint(len(value)) + value
        elif isinstance(value, float):
            out += varint(number << 3 | 5) + struct.pack("<f", value)
        else:
            out += varint(number << 3) + varint(value)
    return out


def test_unigram_model(tmp_path, reference):
    """A small unigram model with byte fallback, written by wire format, gives the library's ids."""
    import sentencepiece

    pieces = [("<unk>", 0.0, S.UNKNOWN), ("<s>", 0.0, S.CONTROL), ("</s>", 0.0, S.CONTROL)]
    pieces += [(f"<0x{b:02X}>", 0.0, S.BYTE) for b in range(256)]
    pieces += [(p, s, S.NORMAL) for p, s in (("▁", -3.0), ("▁the", -2.0), ("he", -4.5), ("t", -5.0), ("h", -5.1), ("e", -5.2), ("▁th", -3.5), ("a", -4.0), ("▁a", -2.5), ("n", -5.0), ("an", -4.2))]
    data = b"".join(message((1, message((1, p.encode()), (2, s), (3, k)))) for p, s, k in pieces)
    data += message((2, message((3, S.UNIGRAM), (35, 1), (40, 0), (41, 1), (42, 2))), (3, message((1, b"identity"), (3, 1), (4, 0), (5, 1))))
    path = tmp_path / "unigram.model"
    path.write_bytes(data)
    own, library = S.Codec(str(path)), sentencepiece.SentencePieceProcessor(model_file=str(path))
    for t in ["the hen", "a than thé", "", "  the", "aaa nnn", "日"]:
        assert np.frombuffer(own.encode([t])[0], "<u4").tolist() == library.encode(t)
        assert own.decode(own.encode([t])[0]) == library.decode(library.encode(t)) == t


def test_documents(spark):
    rows = odd_rows([(10 + k, t) for k, t in enumerate(TEXTS)])
    out = S.encode_documents(documents(spark, rows), verify=1, with_ids=True)
    got = out.collect()
    assert len(got) == len(rows) and all(r.verified for r in got)
    back = S.decode_documents(out).collect()
    texts = sorted((str(i), t or "") for i, t in rows if "▁" not in (t or ""))
    assert sorted((str(r.doc_id), r.text) for r in back if r.doc_id not in (19, 20)) == [x for x in texts if x[0] not in ("19", "20")]
    assert S.encode_documents(documents(spark, [])).collect() == []


def test_every_text_is_verified(spark):
    rows = odd_rows([(100 + k, f"text {k} of many") for k in range(100)])
    got = S.encode_documents(documents(spark, rows)).collect()
    assert len(got) == len(rows) and all(r.verified for r in got)


def test_a_failed_check_gives_the_librarys_ids(spark, tmp_path):
    """A user-defined piece is always kept whole by the library, but not by the rebuilt tokenizer."""
    import sentencepiece

    pieces = [("<unk>", 0.0, S.UNKNOWN), ("<s>", 0.0, S.CONTROL), ("</s>", 0.0, S.CONTROL)]
    pieces += [(p, s, S.NORMAL) for p, s in (("▁", -1.0), ("a", -1.0), ("b", -1.0), ("c", -1.0), ("▁abc", -2.0))] + [("bc", -9.0, S.USER)]
    data = b"".join(message((1, message((1, p.encode()), (2, s), (3, k)))) for p, s, k in pieces)
    data += message((2, message((3, S.UNIGRAM), (40, 0), (41, 1), (42, 2))), (3, message((1, b"identity"), (3, 1), (4, 0), (5, 1))))
    path = tmp_path / "user.model"
    path.write_bytes(data)
    library = sentencepiece.SentencePieceProcessor(model_file=str(path))
    rows = [(1, "abc"), (2, "a b"), (3, "abc abc"), (4, "")]
    assert np.frombuffer(S.Codec(str(path)).encode(["abc"])[0], "<u4").tolist() != library.encode("abc")
    got = S.encode_documents(documents(spark, rows), path=str(path), with_ids=True).collect()
    assert {r.doc_id: r.verified for r in got} == {1: False, 2: True, 3: False, 4: True}
    assert all(np.frombuffer(r.ids, "<u4").tolist() == library.encode(t) and r.n_tokens == len(library.encode(t)) for r, (_, t) in zip(sorted(got), rows))
