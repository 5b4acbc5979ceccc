"""SentencePiece encoding and decoding with the tokenizers library.

The model file is a protobuf; its few fields are read here by wire format: the
pieces with scores and types, the model type, the byte fallback flag and the
normaliser settings. From them an equal tokenizer is rebuilt: character map,
metaspace marker (a dummy prefix if the model has one, spaces become U+2581), and
either a unigram model on the piece scores or, for a BPE model, the merges that
the scores imply (every split of a piece into two pieces, best score first), both
with byte fallback.

Batches are encoded by the library's threads. If no piece holds a marker after
another character (checked), pieces never cross a space, so texts are cut there
and each distinct word is encoded once per worker; other models, and texts with
runs of spaces, are encoded whole. Parity with the sentencepiece library is
verified on every text by its ids; where they differ, the library's ids and its
decoded text count, and ``verified`` is false. Equal ids decode alike because the
two piece tables are compared id by id when a worker reads the model.

Decoding joins the bytes of the pieces, so a text of words that each decode to
themselves decodes to itself: the round trip is tried once per distinct word, and on the whole
text where a word differs or the text was encoded whole. Defined results: a null or empty text has
no tokens and decodes to the empty text; repeated rows and null ids keep their
rows; an empty table gives an empty result; other columns aren't read; texts are
encoded whole, however long."""

from __future__ import annotations

import os
import struct
import sys
import zlib
from itertools import filterfalse
from types import ModuleType

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import table

SPACE = "▁"
VERIFY = 1                # every text; n: by hash, each n-th
THREADS = 2               # library threads per Python worker: the cores of a task slot
MEMO_WORDS = 500_000
# field numbers of the public model protobuf
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = range(1, 7)
UNIGRAM, BPE = 1, 2


def fields(data: bytes):
    """(number, value) of a protobuf message; nested messages and strings as bytes."""
    at = 0

    def varint():
        nonlocal at
        value = shift = 0
        while True:
            b = data[at]
            at += 1
            value |= (b & 127) << shift
            shift += 7
            if b < 128:
                return value

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
        elif kind == 1:
            at += 8
            yield key >> 3, struct.unpack("<d", data[at - 8:at])[0]
        elif kind == 2:
            n = varint()
            at += n
            yield key >> 3, data[at - n:at]
        elif kind == 5:
            at += 4
            yield key >> 3, struct.unpack("<f", data[at - 4:at])[0]
        else:
            raise ValueError(f"unknown wire type {kind}")


def parse(data: bytes) -> dict:
    """Pieces (text, score, type), model type, byte fallback, unknown id and
    normaliser settings of a model file."""
    model = {"pieces": [], "type": UNIGRAM, "byte_fallback": False, "unk_id": 0, "charsmap": b"", "dummy_prefix": True,
             "remove_extra": True, "escape": True, "suffix": False}
    for number, value in fields(data):
        if number == 1:
            f = dict(fields(value))
            model["pieces"].append((f.get(1, b"").decode(), f.get(2, 0.0), f.get(3, NORMAL)))
        elif number == 2:
            f = dict(fields(value))
            model |= {"type": f.get(3, UNIGRAM), "byte_fallback": bool(f.get(35, 0)), "unk_id": f.get(40, 0), "suffix": bool(f.get(24, 0))}
        elif number == 3:
            f = dict(fields(value))
            model |= {"charsmap": f.get(2, b""), "dummy_prefix": bool(f.get(3, 1)), "remove_extra": bool(f.get(4, 1)), "escape": bool(f.get(5, 1))}
    return model


def implied_merges(pieces: list[tuple[str, float, int]]) -> list[tuple[str, str]]:
    """Merges of a BPE model: each piece from any two pieces it consists of, by
    falling score of the result; ties by the ids of the parts."""
    ids = {p: k for k, (p, _, kind) in enumerate(pieces) if kind in (NORMAL, USER, UNUSED)}
    out = []
    for whole, score, kind in pieces:
        if kind not in (NORMAL, USER):
            continue
        splits = [(whole[:k], whole[k:]) for k in range(1, len(whole)) if whole[:k] in ids and whole[k:] in ids]
        out += [(-score, ids[a], ids[b], a, b) for a, b in splits]
    return [(a, b) for *_, a, b in sorted(out, key=lambda x: x[:3])]


def build(model: dict):
    """The tokenizers.Tokenizer equal to a parsed model."""
    from tokenizers import Regex, Tokenizer, decoders, models, normalizers

    if model["suffix"]:
        raise ValueError("models with the marker behind words aren't supported")
    pieces = model["pieces"]
    if model["type"] == UNIGRAM:
        core = models.Unigram([(p, s) for p, s, _ in pieces], unk_id=model["unk_id"], byte_fallback=model["byte_fallback"])
    elif model["type"] == BPE:
        core = models.BPE({p: k for k, (p, _, _) in enumerate(pieces)}, implied_merges(pieces), unk_token=pieces[model["unk_id"]][0],
                          fuse_unk=True, byte_fallback=model["byte_fallback"])
    else:
        raise ValueError("only unigram and BPE models are supported")
    t = Tokenizer(core)
    steps = []
    if model["charsmap"]:
        steps.append(normalizers.Precompiled(model["charsmap"]))
    if model["remove_extra"]:
        steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
    if model["dummy_prefix"]:
        steps.append(normalizers.Prepend(SPACE))
    if model["escape"]:
        steps.append(normalizers.Replace(" ", SPACE))
    t.normalizer = normalizers.Sequence(steps)
    t.decoder = decoders.Sequence([decoders.Replace(SPACE, " "), decoders.ByteFallback(), decoders.Fuse()]
                                  + ([decoders.Strip(" ", 1, 0)] if model["dummy_prefix"] else []))
    return t


class Codec:
    """text <-> ids (little-endian uint32 bytes)."""

    def __init__(self, path: str, threads: int = THREADS):
        os.environ.setdefault("RAYON_NUM_THREADS", str(threads))
        os.environ["TOKENIZERS_PARALLELISM"] = "true"
        with open(path, "rb") as f:
            model = parse(f.read())
        self.model, self.tokenizer = model, build(model)
        plain = model["dummy_prefix"] and model["escape"] and not model["charsmap"] and not model["remove_extra"]
        self.separable = plain and not any(SPACE in p.lstrip(SPACE) for p, _, _ in model["pieces"])
        self.memo: dict[str, bytes] = {}
        self.odd: set[str] = set()                     # words of the memo that don't decode to themselves
        self.bytes_of = [bytes([int(p[1:-1], 16)]) if kind == BYTE else b"" if kind in (CONTROL, UNKNOWN) else p.replace(SPACE, " ").encode()
                         for p, _, kind in model["pieces"]]

    def _encode(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)] if texts else []

    def same_pieces(self, other) -> bool:
        """Whether a sentencepiece processor has the same piece and kind at every id."""
        pieces = self.model["pieces"]
        return other.get_piece_size() == len(pieces) and all(
            other.id_to_piece(k) == p and other.is_byte(k) == (kind == BYTE) and other.is_control(k) == (kind == CONTROL)
            and other.is_unknown(k) == (kind == UNKNOWN) for k, (p, _, kind) in enumerate(pieces))

    def encode(self, texts: list[str]) -> list[bytes]:
        return self._encode_cut(texts)[0]

    def round_trip(self, texts: list[str]) -> tuple[list[bytes], list[str]]:
        """Ids and decoded text of every text."""
        ids, cut = self._encode_cut(texts)
        return ids, [t if words and (not self.odd or self.odd.isdisjoint(words)) else self.decode(i) for t, i, words in zip(texts, ids, cut)]

    def _pieces(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))

    def _encode_cut(self, texts: list[str]) -> tuple[list[bytes], list[list[str] | None]]:
        """Ids per text, and the words it was put together from (None: encoded whole)."""
        if len(self.memo) > MEMO_WORDS:
            self.memo.clear()
            self.odd.clear()
        # a word after a space is encoded like a text of its own: the dummy prefix is that space.
        # Marks standing in the text itself, and runs of spaces, would join into other pieces.
        cut = [t.split(" ") if self.separable and t and "  " not in t and SPACE not in t and t[0] != " " and t[-1] != " " else None for t in texts]
        missing: set[str] = set()
        for words in cut:
            if words:
                missing.update(filterfalse(self.memo.__contains__, words))
        new = list(missing)
        found = self._encode(new)
        self.memo.update(zip(new, found))
        self.odd.update(w for w, ids in zip(new, found) if self._pieces(ids) != b" " + w.encode())
        whole = iter(self._encode([t for t, words in zip(texts, cut) if words is None]))
        get = self.memo.__getitem__
        return [b"".join(map(get, words)) if words else next(whole) for words in cut], cut

    def decode(self, ids: bytes) -> str:
        raw = self._pieces(ids).decode(errors="replace")
        return raw[1:] if self.model["dummy_prefix"] and raw[:1] == " " else raw


def worker_codec(path: str) -> Codec:
    """One codec per Python worker; its memo is only a cache."""
    shared = sys.modules.setdefault("_sentencepiece_codecs", ModuleType("_sentencepiece_codecs"))
    if path not in shared.__dict__:
        shared.__dict__[path] = Codec(path)
    return shared.__dict__[path]


def model_path(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def encode_documents(docs: DataFrame, path: str | None = None, verify: int = VERIFY, with_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_crc32, round_trip (decoding gives the text back),
    verified (parity with sentencepiece; null where not tried, and where false
    the row has the library's ids)[, ids binary]."""
    path = path or model_path()

    def run(batches):
        import sentencepiece

        codec = worker_codec(path)
        reference = sentencepiece.SentencePieceProcessor(model_file=path)
        if verify and not codec.same_pieces(reference):
            raise ValueError("the rebuilt piece table isn't the library's")
        for b in batches:
            texts = [t or "" for t in b.column(1).to_pylist()]
            ids, back = codec.round_trip(texts)
            tried = [k for k, t in enumerate(texts) if verify and zlib.crc32(t.encode()) % verify == 0]
            parity: list = [None] * len(texts)
            expected = reference.encode_as_numpy([texts[k] for k in tried], num_threads=1) if tried else []
            for k, e in zip(tried, expected):
                theirs = e.astype("<u4").tobytes()
                parity[k] = theirs == ids[k]
                if not parity[k]:
                    ids[k], back[k] = theirs, reference.decode(e)
            cols = [b.column(0), pa.array([len(i) // 4 for i in ids], pa.int64()), pa.array([zlib.crc32(i) for i in ids], pa.int64()),
                    pa.array([t == x for t, x in zip(texts, back)], pa.bool_()), pa.array(parity, pa.bool_())]
            names = ["doc_id", "n_tokens", "ids_crc32", "round_trip", "verified"]
            yield pa.RecordBatch.from_arrays(cols + ([pa.array(ids, pa.binary())] if with_ids else []), names + (["ids"] if with_ids else []))

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, "doc_id long, n_tokens long, ids_crc32 long, round_trip boolean, verified boolean" + (", ids binary" if with_ids else ""))


def decode_documents(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """encoded(doc_id, ids binary) -> doc_id, text."""
    path = path or model_path()

    def run(batches):
        codec = worker_codec(path)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([codec.decode(i or b"") for i in b.column(1).to_pylist()], pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(table(spark, sf_dir, "documents"))
