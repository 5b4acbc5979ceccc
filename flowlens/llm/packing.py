"""Packing into fixed windows by minimum bin slack.

Every document is its token ids plus one end id. Documents longer than a window
give whole windows first; what remains of each is packed by minimum bin slack:
the largest remaining length opens a window, and a subset-sum over bitsets picks,
from the multiset of the other remaining lengths, the one that fills the window
closest to its capacity. Bit t of a bitset says that length t can be reached; each
length is added with its multiplicity split in powers of two, the bitset before
every step is kept, and walking the steps backwards from the highest reachable
bit yields how many pieces of each length are taken.

Each task packs its own rows in blocks of ``BLOCK`` remainders (all lengths of
a block meet in one dynamic programme; nothing crosses tasks, so there is no
shuffle and a lost task is simply run again). A window that no choice of remainders
fills up to ``window // SLACK`` is completed by cutting the longest remainder left (a run of
equal long documents has no two that fit together); what is left of it is packed
on. If none is left the window goes back into the next block, so only the
last window of a task may stay short. ``sequence_id`` is the task number and a
counter.

Words are tokenized once per worker: the byte-level pre-tokenizer always starts a
new piece at a space that follows a character other than white space and
precedes one, so texts are cut there and each distinct piece of a batch is encoded
once. A bounded memo keeps them; once it is half full only those that came up in two
batches, since most come up in one only. Texts with longer runs of white space are
encoded whole.

Defined results: a null or empty text is one piece holding the end id; repeated
rows are packed each; a null doc_id stays null; an empty table gives an empty
result; other columns aren't read. Very long texts are cut into windows."""

from __future__ import annotations

import sys
import zlib
from bisect import bisect_left, bisect_right, insort
from itertools import islice
from types import ModuleType

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import map_arrow, table

WINDOW = 2048
END_ID = 1
BLOCK = 4096              # remainders packed together
SLACK = 64                # a window may stay short by this part of its length without a cut
TEXTS = 1000              # texts cut into pieces at a time
MEMO_PIECES = 1_000_000   # distinct pieces kept by a worker (about 200 bytes each)
SEEN_SLOTS = 1 << 23      # hashed marks (a byte each) of the pieces that came up before
SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long, sequence_tokens long")


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class PieceEncoder:
    """text -> little-endian uint32 ids, equal to encoding the whole text."""

    def __init__(self, path: str, memo: int = MEMO_PIECES):
        from tokenizers import Tokenizer

        self.limit = memo

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True    # their strings are ordinary text
        vocabulary = self.tokenizer.get_vocab()
        self.opens = np.zeros(max(vocabulary.values()) + 1, bool)      # tokens that begin with a space
        self.opens[[i for word, i in vocabulary.items() if word.startswith("\u0120")]] = True
        self.after_space: dict[str, bytes] = {}        # piece -> ids of " " + piece
        self.seen, self.marks = np.zeros(SEEN_SLOTS, bool), 0
        self.spaced: set[str] = set()                  # pieces that begin with white space: their texts are encoded whole

    def _encode(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)] if texts else []

    def _learn(self, pieces: set[str]) -> None:
        """Encodes many pieces in a few calls: they hold no space themselves, so
        the tokens that begin with one are the pieces' first."""
        memo = self.after_space
        words = set(filter(str.isalnum, pieces))       # neither white space nor signs: nothing to look at
        others = pieces - words
        odd = {p for p in others if p.strip() != p or "\t" in p}
        self.spaced.update(p for p in odd if p[:1].isspace())
        # full stops and commas after a letter or digit are tokens of their own
        cores = {p: c for p in others - odd if (c := p.rstrip(".,")) != p and c[-1:].isalnum()}
        words.update(set(cores.values()).difference(memo), others.difference(odd, cores))
        plain, failed = list(words), list(odd)
        for i in range(0, len(plain), 2000):
            some = plain[i:i + 2000]
            raw = self._encode([" " + " ".join(some)])[0]
            starts = (np.flatnonzero(self.opens[np.frombuffer(raw, "<u4")]) * 4).tolist()
            if len(starts) == len(some):
                memo.update(zip(some, [raw[x:y] for x, y in zip(starts, [*starts[1:], len(raw)])]))
            else:
                failed += some
        memo.update(zip(failed, self._encode([" " + p for p in failed])))
        tails = {p: p[len(c):] for p, c in cores.items()}
        ends_with = dict(zip(set(tails.values()), self._encode(list(set(tails.values())))))
        memo.update((p, memo[cores[p]] + ends_with[tail]) for p, tail in tails.items())

    def _passing(self, pieces: set[str]) -> list[str]:
        """Those of ``pieces`` that came up for the first time (by their marks:
        a clash of hashes keeps a piece, no more than that)."""
        if self.marks > SEEN_SLOTS // 4:
            self.seen[:], self.marks = False, 0
        some = list(pieces)
        at = np.fromiter(map(hash, some), np.int64, len(some)) & (SEEN_SLOTS - 1)
        fresh = np.flatnonzero(~self.seen[at])
        self.seen[at] = True
        self.marks += len(fresh)
        return [some[k] for k in fresh.tolist()]

    def batch(self, texts: list[str]) -> list[bytes]:
        cut = [None if "  " in t or t[:1] == " " or t[-1:] == " " else t.split(" ") for t in texts]
        first = iter(self._encode([p[0] for p in cut if p]))
        # the batch's distinct pieces that aren't known yet are learned together
        distinct: set[str] = set()
        for p in cut:
            if p:
                distinct.update(islice(p, 1, None))
        if len(self.after_space) > self.limit:       # what this batch needs stays
            self.after_space = {p: self.after_space[p] for p in distinct.intersection(self.after_space)}
            self.spaced &= distinct
        memo = self.after_space
        unknown = distinct.difference(memo)
        self._learn(unknown)
        odd = self.spaced & distinct
        done, whole, get = [], [], memo.__getitem__
        for k, p in enumerate(cut):
            head = next(first) if p else b""
            if p and (not odd or odd.isdisjoint(p)):
                done.append(head + b"".join(map(get, islice(p, 1, None))))
            else:
                done.append(b"")
                whole.append(k)
        for k, ids in zip(whole, self._encode([texts[k] for k in whole])):
            done[k] = ids
        passing = self._passing(unknown)
        if len(memo) > self.limit // 2:
            for p in passing:
                del memo[p]
            self.spaced.difference_update(passing)
        return done


def worker_encoder(path: str, memo: int = MEMO_PIECES) -> PieceEncoder:
    """The encoder of this Python worker: tasks that follow each other in one
    worker share its memo (a cache only; any task can start without it)."""
    shared = sys.modules.setdefault("_piece_encoders", ModuleType("_piece_encoders"))
    if path not in shared.__dict__:
        shared.__dict__[path] = PieceEncoder(path)
    shared.__dict__[path].limit = memo
    return shared.__dict__[path]


def best_fill(counts: dict[int, int], capacity: int, order: list[int] | None = None) -> dict[int, int]:
    """The multiset of lengths (at most ``counts`` of each) whose sum is as
    near to ``capacity`` as possible from below: length -> how many. ``order``:
    the lengths, ascending, if known."""
    full = (1 << (capacity + 1)) - 1
    reach, steps = 1, []          # steps: (bitset before, length, copies added by this step)
    order = sorted(counts) if order is None else order
    for at in range(bisect_right(order, capacity) - 1, -1, -1):
        length = order[at]
        left, copies = min(counts[length], capacity // length), 1
        while left and not reach >> capacity & 1:
            take = min(copies, left)
            after = (reach | reach << (length * take)) & full
            if after != reach:
                steps.append((reach, length, take))
                reach = after
            left -= take
            copies *= 2
        if reach >> capacity & 1:
            break
    at, chosen = reach.bit_length() - 1, {}
    for before, length, take in reversed(steps):
        if not before >> at & 1:      # only reachable through this step
            at -= length * take
            chosen[length] = chosen.get(length, 0) + take
    return chosen


def pack_block(lengths: list[int], window: int, final: bool) -> tuple[list[list[tuple[int, int, int]]], list[tuple[int, int, int]]]:
    """Pieces (index of ``lengths``, start in it, length) grouped into windows,
    and the pieces left for the next block (none if ``final``)."""
    stacks: dict[int, list[tuple[int, int]]] = {}
    for k, n in enumerate(lengths):
        stacks.setdefault(n, []).append((k, 0))
    counts = {n: len(s) for n, s in stacks.items()}
    order = sorted(counts)

    def push(n: int, k: int, start: int) -> None:
        if n not in counts:
            counts[n] = 0
            insort(order, n)
        stacks.setdefault(n, []).append((k, start))
        counts[n] += 1

    def pop(n: int) -> tuple[int, int, int]:
        counts[n] -= 1
        if not counts[n]:
            del counts[n], order[bisect_left(order, n)]
        return (*stacks[n].pop(), n)

    windows, back = [], []
    while counts:
        largest = order[-1]
        own = [pop(largest)]
        for n, times in best_fill(counts, window - largest, order).items():
            own += [pop(n) for _ in range(times)]
        slack = window - sum(n for *_, n in own)
        if slack > window // SLACK and counts:        # whatever is left is longer than the slack
            k, start, n = pop(order[-1])
            own.append((k, start, slack))
            push(n - slack, k, start + slack)
        elif slack > window // SLACK and not final:   # the rest of the block: wait for more lengths
            back += own
            continue
        windows.append(own)
    return windows, back


def _pack(batches, path: str, window: int, end_id: int, block: int, memo: int = MEMO_PIECES):
    from pyspark import TaskContext

    encoder, tail = worker_encoder(path, memo), np.array([end_id], "<u4").tobytes()
    sequence = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 36
    waiting: list[tuple] = []     # (doc_id, start, ids, doc_tokens)
    out: list[tuple] = []

    def close(final: bool):
        nonlocal sequence, waiting
        windows, back = pack_block([len(w[2]) // 4 for w in waiting], window, final)
        for own in windows:
            offset, total = 0, sum(n for *_, n in own)
            for k, at, n in own:
                doc, start, ids, tokens = waiting[k]
                out.append((doc, start + at, n, zlib.crc32(ids[4 * at:4 * (at + n)]), tokens, sequence, offset, total))
                offset += n
            sequence += 1
        waiting = [(waiting[k][0], waiting[k][1] + at, waiting[k][2][4 * at:4 * (at + n)], waiting[k][3]) for k, at, n in back]

    def flush():
        rows, out[:] = list(out), []
        columns = list(zip(*rows)) or [()] * 8
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], [c.split()[0] for c in SCHEMA.split(", ")])

    for b in (b.slice(at, TEXTS) for b in batches for at in range(0, b.num_rows, TEXTS)):
        texts = [t or "" for t in b.column(1).to_pylist()]
        for doc, ids in zip(b.column(0).to_pylist(), encoder.batch(texts)):
            ids += tail
            total = len(ids) // 4
            whole = total // window
            for i in range(whole):
                part = ids[4 * i * window:4 * (i + 1) * window]
                out.append((doc, i * window, window, zlib.crc32(part), total, sequence, 0, window))
                sequence += 1
            if total % window:
                waiting.append((doc, whole * window, ids[4 * whole * window:], total))
            if len(waiting) >= block:
                close(False)
        yield flush()
    close(True)
    yield flush()


def pack(docs: DataFrame, path: str | None = None, window: int = WINDOW, end_id: int = END_ID, block: int = BLOCK,
         memo: int = MEMO_PIECES) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset, sequence_tokens. ``memo``: pieces a worker remembers."""
    path = path or vocabulary_path()
    return map_arrow(docs.selectExpr("cast(doc_id as long) as doc_id", "cast(text as string) as text"),
                     lambda batches: _pack(batches, path, window, end_id, block, memo), SCHEMA, keep="_piece_encoders")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
