import itertools
import random
import zlib

import numpy as np
import pytest

from flowlens.llm import packing as P

from .helpers import documents, odd_rows


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(P.vocabulary_path())


def test_best_fill_against_all_subsets():
    r = random.Random(1)
    for _ in range(200):
        lengths = [r.randrange(1, 30) for _ in range(r.randrange(9))]
        capacity = r.randrange(0, 60)
        counts = {n: lengths.count(n) for n in lengths}
        best = max(sum(c) for k in range(len(lengths) + 1) for c in itertools.combinations(lengths, k) if sum(c) <= capacity)
        chosen = P.best_fill(counts, capacity)
        assert sum(n * k for n, k in chosen.items()) == best
        assert all(k <= counts[n] for n, k in chosen.items())


def test_block_holds_each_piece_once():
    r = random.Random(2)
    lengths = [r.randrange(1, 2048) for _ in range(500)]
    for final in (False, True):
        windows, back = P.pack_block(lengths, 2048, final)
        own = {}
        for k, start, n in [p for w in windows for p in w] + back:
            own.setdefault(k, []).append((start, n))
        assert sorted(own) == list(range(500))
        for k, parts in own.items():
            assert [s for s, _ in sorted(parts)] == [sum(n for _, n in sorted(parts)[:i]) for i in range(len(parts))] and sum(n for _, n in parts) == lengths[k]
        assert all(sum(n for *_, n in w) <= 2048 for w in windows)
        assert not (back and final) and sum(n for *_, n in back) < 2048
    assert sum(lengths) / (2048 * len(windows)) > 0.97


@pytest.mark.parametrize("lengths", [[1200] * 3000, [1100 + k % 201 for k in range(3000)], [1025] * 500, [2047, 2] * 300, [2048 - 33] * 100, [7] * 5])
def test_runs_of_similar_lengths_leave_little_padding(lengths):
    """Over several blocks, as a task packs them."""
    waiting, full, sizes = [], 0, []
    for at in range(0, len(lengths), 256):
        block = waiting + lengths[at:at + 256]
        windows, back = P.pack_block(block, 2048, at + 256 >= len(lengths))
        sizes += [sum(n for *_, n in w) for w in windows]
        waiting = [n for *_, n in back]
        assert sum(waiting) < 2048
    assert sum(sizes) == sum(lengths) and all(s <= 2048 for s in sizes)
    assert sum(s < 2048 - 2048 // P.SLACK for s in sizes) <= 1                  # the very last window
    assert len(sizes) == 1 or sum(sizes) / (2048 * len(sizes)) > 0.95


def test_pieces_equal_whole_texts(tokenizer):
    r = random.Random(3)
    letters = "abcdef ABC  éüß日本👍\n\t.,;#123'st"
    texts = ["", " ", "a  b", " x", "x ", "a\n b", "a \nb", "x \t y", "don't  we'll", " a  b", "a  b", "w. x, y.. z.,", "é. 日,", "<|endoftext|> a"]
    texts += ["".join(r.choices(letters, k=r.randrange(120))) for _ in range(3000)]
    tokenizer.encode_special_tokens = True
    expected = [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    encoder = P.PieceEncoder(P.vocabulary_path())
    for _ in range(2):          # the second time from the memo
        assert [np.frombuffer(x, "<u4").tolist() for x in encoder.batch(texts)] == expected


def test_documents(spark, tokenizer):
    r = random.Random(4)
    rows = odd_rows([(100 + k, " ".join(r.choices(["alpha", "beta", "gamma.", "Delta,"], k=r.randrange(1500)))) for k in range(150)])
    got = P.pack(documents(spark, rows), block=64).collect()
    ids = {}
    for i, t in rows:
        ids.setdefault(i, [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1])
    pieces, sequences = {}, {}
    for p in got:
        own = ids[p.doc_id][p.start:p.start + p.length]
        assert p.length == len(own) > 0 and p.doc_tokens == len(ids[p.doc_id])
        assert p.ids_crc32 == zlib.crc32(np.array(own, "<u4").tobytes())
        pieces.setdefault(p.doc_id, []).append((p.start, p.length))
        sequences.setdefault(p.sequence_id, []).append((p.offset, p.length))
    copies = {i: sum(x == i for x, _ in rows) for i, _ in rows}
    assert pieces.keys() == copies.keys()
    for i, own in pieces.items():
        at = 0
        for start, length in sorted(set(own)):
            assert start == at and own.count((start, length)) == copies[i]
            at += length
        assert at == len(ids[i])
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 2048
    assert sum(x for own in pieces.values() for _, x in own) / (2048 * len(sequences)) > 0.9
    assert P.pack(documents(spark, [])).collect() == []


def test_many_pieces_in_one_call(tokenizer):
    """Pieces are learned together without signs between them: each keeps its own ids."""
    r = random.Random(5)
    pieces = {"".join(r.choices("abcéß日AZ019.,;'\n_-#", k=r.randrange(1, 12))) for _ in range(4000)} | {"\u0120", "\u0120a", "a\u00a0b", "a\u2003b", "x\ny"}
    encoder, calls = P.PieceEncoder(P.vocabulary_path()), []
    encode = encoder._encode
    encoder._encode = lambda texts: calls.append(texts) or encode(texts)
    encoder._learn(pieces)
    assert not any("\t" in t for texts in calls for t in texts)
    assert max(t.count(" ") for texts in calls for t in texts) > 1000
    tokenizer.encode_special_tokens = True
    for p in pieces:
        assert np.frombuffer(encoder.after_space[p], "<u4").tolist() == tokenizer.encode(" " + p, add_special_tokens=False).ids


def test_pieces_of_one_batch_only_leave_the_memo(tokenizer):
    """The memo holds what comes again, not every piece that ever came up."""
    encoder = P.PieceEncoder(P.vocabulary_path(), memo=50)
    tokenizer.encode_special_tokens = True
    for k in range(12):
        texts = [" ".join(["first", *(f"x{k}y{n}" for n in range(200)), "\todd", *(f"common{n}" for n in range(20))])]
        assert [np.frombuffer(x, "<u4").tolist() for x in encoder.batch(texts)] == [tokenizer.encode(texts[0], add_special_tokens=False).ids]
        assert len(encoder.after_space) <= 21 + 2 * k          # and a few by clashes of hashes
    assert {f"common{n}" for n in range(20)} <= encoder.after_space.keys()


def test_full_memo_keeps_what_its_batch_needs():
    encoder = P.PieceEncoder(P.vocabulary_path(), memo=100)
    old, now = [f"old{n}" for n in range(300)], [f"now{n}" for n in range(60)]
    for _ in range(2):
        encoder.batch([" ".join(["first", *old, *now])])
    assert len(encoder.after_space) == 360
    learned, learn = [], encoder._learn
    encoder._learn = lambda pieces: learned.extend(pieces) or learn(pieces)
    encoder.batch([" ".join(["first", *now, "new"])])
    assert encoder.after_space.keys() == set(now) and learned == ["new"]
