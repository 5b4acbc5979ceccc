"""Secret scan: base patterns plus a linear-chain conditional random field.

Tokens are the single characters ``:`` and ``=`` and the runs between them and
white space. Each token is tagged B (begins a secret), I (inside) or O. Its score
for a tag adds weights of its own shape (length, kinds of characters, changes of
kind), of the words around it (two before, one after, hashed), and of the file
(share of tokens with digits, share of assignments); neighbouring tags add
transition weights. The best tagging is found by Viterbi.

Viterbi is exact but mostly not needed: if O beats B and I at a token by more than
any choice of neighbouring tags can make up for (a bound from the transition
weights alone), the best tagging has O there. Such tokens cut the text into short
independent stretches, and only those are decoded.

Training needs no hand labels: a parallel pass over all texts finds those with a
base hit, and two bounded samples of distinct texts are taken (``TRAIN_ROWS`` with
a hit and as many without, smallest hash of the text), so however rare hits are,
the field learns from them. The base patterns label stretches of ``LENGTH`` tokens
around hits and a few others; the log-likelihood is maximised by Adam with exact
forward-backward gradients over ``EPOCHS`` passes (more if the sample is small) in batches of ``BATCH`` stretches, in one
task. In a share of the stretches (``BLIND``, drawn anew each time) every token gets the neighbouring words and the
file features of some other, ordinary token, so that shapes learn to tell a secret on their own and the field finds values that
follow none of the patterns' key words.

The base spans always stay; the field adds spans of kind ``crf``. Texts are
scanned whole, without a shuffle.

Defined results: a null or empty text has no spans; repeated rows and null ids
keep their rows; without any hit in the corpus the field tags nothing; an empty
table gives an empty result; other columns are neither read nor changed."""

from __future__ import annotations

import hashlib
import heapq
import pickle
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import Memo, map_arrow, materialize, plain_names, table

TRAIN_ROWS = 2000         # texts with a base hit, and texts without, that the training stretches are taken from
LENGTH = 24               # tokens of a stretch
PER_DOC = 4               # stretches around hits and others taken from one document
EPOCHS, STEPS = 12, 300   # passes over the stretches, and steps, at least
BATCH, RATE, RIDGE = 512, 0.05, 0.002
BLIND = 0.4               # share of the stretches that are learned in the surroundings of ordinary tokens
WORDS, SHAPES, FILES = 4096, 2048, 64
KINDS = ("assign", "access", "hex", "crf")

TOKEN = re.compile(r"[:=]|[^\s:=]+")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LONG_HEX = re.compile(r"[0-9a-f]{16}")
KEY = re.compile(r"password|passwd|secret|token|api_?key", re.IGNORECASE | re.ASCII)
# Spark's filter before base_spans(): every text with a base hit passes, and few others
MAYBE = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]{12}|AKIA[A-Z0-9]{14}|[0-9a-f]{16}"""
PUNCT = "\"'`()[]{}<>,;.!?*#$%&|"
# classes of bytes: lower, upper, digit, sign, other
_CLASS = bytes(ord("a") if 97 <= b <= 122 else ord("A") if 65 <= b <= 90 else ord("0") if 48 <= b <= 57 else ord("+") if b < 128 else ord("x") for b in range(256))
_RUNS = re.compile(rb"(.)\1+")
_HEXES = re.compile(r"[0-9a-f]+|[0-9A-F]+")
B_HIT, SIGN, DIGIT = 1, 2, 4


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the base patterns: leftmost, non-overlapping per kind."""
    out = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    out += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    out += [("hex", m.start(), m.end()) for m in HEX.finditer(text) if m.end() - m.start() >= 16]
    return out


def _describe(token: str) -> tuple[int, int, int]:
    """(shape, hashed word, flags) of a token."""
    core = token.strip(PUNCT) or token
    word = zlib.crc32(core.lower().encode()) % (WORDS - 2) + 2       # 0 and 1: before the start, after the end
    n = len(core)
    if n < 16 and core.isalpha():
        flags = B_HIT if KEY.search(token) or "AKIA" in token else 0
        return (1 if core.islower() else 2 if core[1:].islower() else 3) + 4 * (n > 8), word, flags
    kinds = core.encode().translate(_CLASS)
    changes = len(_RUNS.sub(rb"\1", kinds))
    has = [kinds.count(k) > 0 for k in (b"a", b"A", b"0", b"+", b"x")]
    size = sum(n >= x for x in (4, 8, 12, 16, 20, 32, 64))
    shape = size
    for h in (*has, bool(_HEXES.fullmatch(core))):
        shape = shape * 2 + h
    shape = 16 + shape * 3 + (changes > 2) + (changes > 6)
    flags = (B_HIT if KEY.search(token) or "AKIA" in token or LONG_HEX.search(token) else 0) | (SIGN if token in ":=" else 0) | (DIGIT if has[2] else 0)
    return shape, word, flags


class Reader:
    """text -> token arrays, describing each distinct token once."""

    def __init__(self, limit: int = 250_000):
        self.memo = Memo(self._add, limit)
        self._reset()

    def _reset(self):
        self.known, self.table = 0, np.zeros((4096, 3), np.int32)

    def _add(self, token: str) -> int:
        if self.known == len(self.table):
            self.table = np.concatenate([self.table, np.zeros_like(self.table)])
        self.table[self.known] = _describe(token)
        self.known += 1
        return self.known - 1

    def read(self, text: str) -> np.ndarray:
        """[tokens, 3]: shape, word, flags."""
        if len(self.memo) > self.memo.limit:
            self.memo.clear()
            self._reset()
        tokens = TOKEN.findall(text)
        at = np.fromiter(map(self.memo.__getitem__, tokens), np.int64, len(tokens))
        return self.table[at]


def _file(flags: np.ndarray) -> int:
    """0..63 from the shares of tokens with digits and of assignments."""
    if not len(flags):
        return 0
    level = lambda share: int(min(7, np.floor(np.log2(1 + 256 * share))))
    return 8 * level(np.mean(flags & DIGIT > 0)) + level(np.mean(flags & SIGN > 0))


def _around(words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words two before, one before and one after each token."""
    padded = np.concatenate([[0, 0], words, [1]])
    return padded[:-3], padded[1:-2], padded[3:]


def _emissions(rows: np.ndarray, w: dict) -> np.ndarray:
    two, one, nxt = _around(rows[:, 1])
    return w["shape"][rows[:, 0]] + w["two"][two] + w["one"][one] + w["next"][nxt] + w["file"][_file(rows[:, 2])]


def viterbi(e: np.ndarray, move: np.ndarray, first: np.ndarray) -> list[int]:
    """Best tags of one stretch: emissions [n, 3], transitions, scores before the first token."""
    score, back = first + e[0], []
    for k in range(1, len(e)):
        options = score[:, None] + move
        back.append(options.argmax(axis=0))
        score = options.max(axis=0) + e[k]
    tags = [int(score.argmax())]
    for b in reversed(back):
        tags.append(int(b[tags[-1]]))
    return tags[::-1]


def decode(e: np.ndarray, move: np.ndarray, first: np.ndarray) -> list[tuple[int, int]]:
    """(token, tag) of the tokens tagged other than O in the best tagging."""
    n = len(e)
    if not n:
        return []
    # what the transitions can gain at most by another tag than O (from any tag or the start, to any tag or the end)
    ways = np.concatenate([move, first[None, :]])
    gain_in = (ways - ways[:, :1]).max(axis=0)
    gain_out = np.maximum((move - move[:1]).max(axis=1), 0)
    free = np.flatnonzero((e[:, 1:] + (gain_in + gain_out)[1:] >= e[:, :1] - 1e-4).any(axis=1))
    out = []
    if len(free):
        cuts = np.flatnonzero(np.diff(free) > 1) + 1
        for run in np.split(free, cuts):
            a, b = int(run[0]), int(run[-1]) + 1
            start = first if a == 0 else move[0]         # the token before is O
            part = e[a:b]
            if b < n:                                    # the token after is O
                part = part.copy()
                part[-1] += move[:, 0]
            out += [(a + k, t) for k, t in enumerate(viterbi(part, move, start)) if t]
    return out


def crf_spans(text: str, rows: np.ndarray, w: dict) -> list[tuple[str, int, int]]:
    tagged = decode(_emissions(rows, w), w["move"], w["first"])
    if not tagged:
        return []
    wanted, spans, last = dict(tagged), [], -2
    for k, m in enumerate(TOKEN.finditer(text)):
        tag = wanted.get(k)
        if tag is None:
            continue
        core = m[0].strip(PUNCT)
        start = m.start() + (m[0].find(core) if core else 0)
        end = start + len(core) if core else m.end()
        if tag == 2 and last == k - 1 and spans:
            spans[-1] = ("crf", spans[-1][1], end)
        else:
            spans.append(("crf", start, end))
        last = k
        if len(wanted) == 1:
            break
    return spans


def scan(text: str | None, reader: Reader, w: dict) -> tuple[list, list]:
    """(base spans, all spans), each ordered by start, then kind as listed."""
    text = text or ""
    rows = reader.read(text)
    order = lambda s: (s[1], KINDS.index(s[0]), s[2])
    # any base match lies on a token with a key word, AKIA or a long hex run
    base = base_spans(text) if (rows[:, 2] & B_HIT).any() else []
    return sorted(base, key=order), sorted(base + crf_spans(text, rows, w), key=order)


# --- training ---------------------------------------------------------------

def _smallest(batches, n: int):
    """The ``n`` smallest distinct hashes of this task's texts with a base hit
    (null texts: the filter found none), and the ``n`` smallest of the others."""
    kept: dict[bool, set[int]] = {True: set(), False: set()}
    for b in batches:
        for h, text in zip(b.column("h").to_pylist(), b.column("text").to_pylist()):
            kept[text is not None and bool(base_spans(text))].add(h)
        for hit, own in kept.items():
            if len(own) > n:
                kept[hit] = set(heapq.nsmallest(n, own))
    for hit, own in kept.items():
        yield pa.RecordBatch.from_arrays([pa.array(sorted(own), pa.int64()), pa.array([hit] * len(own), pa.bool_())], ["h", "hit"])


def _stretches(batches):
    """Labelled stretches: shape, three neighbours, file, tag (-1: past the end)."""
    reader = Reader()
    for b in batches:
        out = []
        for h, text in zip(b.column("h").to_pylist(), b.column("text").to_pylist()):
            rows = reader.read(text or "")
            n = len(rows)
            if not n:
                continue
            tags = np.zeros(n, np.int32)
            spans = base_spans(text) if (rows[:, 2] & B_HIT).any() else []
            if spans:
                parts = [(m.start(), m.end()) for m in TOKEN.finditer(text)]
                values = [(m.start(2), m.end(2)) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
                values += [s[1:] for s in spans if s[0] != "assign"]
                starts = np.array([p[0] for p in parts])
                ends = np.array([p[1] for p in parts])
                for x, y in sorted(values, key=lambda v: (v[0], -v[1])):
                    hit = np.flatnonzero((starts < y) & (ends > x))
                    if len(hit) and not tags[hit].any():
                        tags[hit] = 2
                        tags[hit[0]] = 1
            two, one, nxt = _around(rows[:, 1])
            hits = np.flatnonzero(tags == 1)[:PER_DOC]
            random = np.random.default_rng(h & 0x7FFFFFFF)
            begins = {max(0, int(k) - LENGTH // 2) for k in hits} | {int(k) for k in random.integers(0, max(1, n - LENGTH + 1), PER_DOC)}
            # tokens with digits or of odd shape are what the field must leave alone elsewhere
            odd = np.flatnonzero((rows[:, 0] >= 16) & (tags == 0))
            begins |= {max(0, int(k) - LENGTH // 2) for k in (random.choice(odd, PER_DOC) if len(odd) else [])}
            for a in sorted(begins):
                pad = lambda x, fill=0: np.pad(x[a:a + LENGTH], (0, max(0, LENGTH - len(x[a:a + LENGTH]))), constant_values=fill).tolist()
                out.append((h, pad(rows[:, 0]), pad(two), pad(one), pad(nxt), _file(rows[:, 2]), pad(tags, -1)))
        if out:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c) if isinstance(c[0], int) else pa.array(c, pa.list_(pa.int32())) for c in map(list, zip(*out))],
                ["h", "shape", "two", "one", "next", "file", "tags"]).cast(pa.schema([
                    ("h", pa.int64()), ("shape", pa.list_(pa.int32())), ("two", pa.list_(pa.int32())), ("one", pa.list_(pa.int32())),
                    ("next", pa.list_(pa.int32())), ("file", pa.int32()), ("tags", pa.list_(pa.int32()))]))


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def likelihood_gradient(e: np.ndarray, valid: np.ndarray, tags: np.ndarray, move: np.ndarray, first: np.ndarray):
    """Mean log-likelihood over stretches and its gradients by emission [N, L, 3],
    transition and start. ``valid`` marks real tokens (a prefix of each row)."""
    n, length, k = e.shape
    alpha, beta = np.zeros_like(e), np.zeros_like(e)
    alpha[:, 0] = first + e[:, 0]
    for t in range(1, length):
        step = _logsum(alpha[:, t - 1, :, None] + move, 1) + e[:, t]
        alpha[:, t] = np.where(valid[:, t, None], step, alpha[:, t - 1])
    for t in range(length - 2, -1, -1):
        step = _logsum(move + (e[:, t + 1] + beta[:, t + 1])[:, None, :], 2)
        beta[:, t] = np.where(valid[:, t + 1, None], step, 0)
    z = _logsum(alpha[:, -1], 1)
    gold = np.where(valid, tags, 0)
    hot = np.eye(k)[gold] * valid[..., None]
    g_e = hot - np.exp(alpha + beta - z[:, None, None]) * valid[..., None]
    g_first = g_e[:, 0].mean(axis=0)
    g_move = np.zeros((k, k))
    value = (first[gold[:, 0]] + (e * hot).sum(axis=(1, 2)) - z)
    for t in range(1, length):
        on = valid[:, t]
        joint = alpha[:, t - 1, :, None] + move + (e[:, t] + beta[:, t])[:, None, :] - z[:, None, None]
        g_move -= (np.exp(joint) * on[:, None, None]).sum(axis=0)
        np.add.at(g_move, (gold[on, t - 1], gold[on, t]), 1)
        value += np.where(on, move[gold[:, t - 1], gold[:, t]], 0)
    return value.mean(), g_e / n, g_move / n, g_first


def fit(data: dict[str, np.ndarray], epochs: int = EPOCHS) -> dict[str, np.ndarray]:
    """Weights; every stretch is used in every pass, in a fixed random order."""
    sizes = {"shape": SHAPES, "two": WORDS, "one": WORDS, "next": WORDS, "file": FILES}
    w = {k: np.zeros((n, 3)) for k, n in sizes.items()} | {"move": np.zeros((3, 3)), "first": np.zeros(3)}
    every = {k: data[k] for k in ("shape", "two", "one", "next")} | {"file": np.repeat(data["file"][:, None], LENGTH, 1)}
    m, v = {k: np.zeros_like(x) for k, x in w.items()}, {k: np.zeros_like(x) for k, x in w.items()}
    step, n = 0, len(data["tags"])
    batches = max(1, -(-n // BATCH))
    for epoch in range(max(epochs, -(-STEPS // batches))):
        random = np.random.default_rng(epoch)
        order = random.permutation(n)
        for some in np.array_split(order, batches):
            step += 1
            at, tags = {k: x[some] for k, x in every.items()}, data["tags"][some]
            blind = np.flatnonzero(random.random(len(some)) < BLIND)
            row, col = np.nonzero(tags == 0)
            if len(blind) and len(row):               # surroundings of tokens drawn from ordinary text
                drawn = random.integers(0, len(row), (len(blind), LENGTH))
                for k in ("two", "one", "next", "file"):
                    at[k][blind] = every[k][some][row[drawn], col[drawn]]
            e = sum(w[k][at[k]] for k in sizes)
            _, g_e, g_move, g_first = likelihood_gradient(e, tags >= 0, tags, w["move"], w["first"])
            grads = {"move": g_move, "first": g_first}
            for k, size in sizes.items():
                flat = at[k].ravel()
                grads[k] = np.stack([np.bincount(flat, g_e[..., y].ravel(), size) for y in range(3)], axis=1)
            for k, x in w.items():
                g = grads[k] * LENGTH - RIDGE * x
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.99 * v[k] + 0.01 * g * g
                x += RATE * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.99 ** step)) + 1e-6)
            w["move"] = np.clip(w["move"], -3, 3)     # keeps the bound of decode() narrow
            w["first"] = np.clip(w["first"], -3, 3)
    return {k: x.astype(np.float32) for k, x in w.items()}


def nothing() -> dict[str, np.ndarray]:
    """Weights that tag O everywhere."""
    w = {k: np.zeros((n, 3), np.float32) for k, n in (("shape", SHAPES), ("two", WORDS), ("one", WORDS), ("next", WORDS), ("file", FILES))}
    w["shape"][:, 0] = 9
    return w | {"move": np.zeros((3, 3), np.float32), "first": np.zeros(3, np.float32)}


def _fit_task(batches):
    some = [b for b in batches if b.num_rows]
    if not some:
        return
    rows = pa.Table.from_batches(some).combine_chunks()
    flat = lambda k: np.concatenate([c.flatten().to_numpy() for c in rows.column(k).chunks]).reshape(-1, LENGTH)
    data = {k: flat(k) for k in ("shape", "two", "one", "next", "tags")} | {"file": rows.column("file").to_numpy()}
    if not (data["tags"] > 0).any():
        return
    # by h, shape, two, one, tags: the last key is the first to count
    order = np.lexsort([*[c for k in ("tags", "one", "two", "shape") for c in data[k].T[::-1]], rows.column("h").to_numpy()])
    data = {k: x[order] for k, x in data.items()}
    yield pa.RecordBatch.from_pydict({"model": pa.array([pickle.dumps(fit(data))], pa.binary())})


def training_texts(docs: DataFrame, n: int = TRAIN_ROWS) -> DataFrame:
    """(h, text): at most ``n`` distinct texts with a base hit and ``n`` without."""
    texts = docs.select("text").where("text is not null").withColumn("h", F.xxhash64(F.lit("sample"), "text"))
    maybe = texts.select("h", F.when(F.col("text").rlike(MAYBE), F.col("text")).alias("text"))
    found = materialize(map_arrow(maybe, lambda batches: _smallest(batches, n), "h long, hit boolean"), "secret-scan-sample")
    pick = lambda rows: rows.select("h").distinct().orderBy("h").limit(n)
    sample = pick(found.where("hit")).union(pick(found.where("not hit")))     # 2 n hashes at most
    # copies of a text meet per task first: one row of each reaches the next step
    return texts.join(F.broadcast(sample), "h").groupBy("h").agg(F.min("text").alias("text"))


def train(docs: DataFrame, n: int = TRAIN_ROWS) -> dict[str, np.ndarray]:
    schema = "h long, shape array<int>, two array<int>, one array<int>, next array<int>, file int, tags array<int>"
    # stretches of 2 n texts at most meet in one task
    found = map_arrow(map_arrow(training_texts(docs, n), _stretches, schema).repartition(1), _fit_task, "model binary").collect()
    return pickle.loads(found[0]["model"]) if found else nothing()


# --- application ------------------------------------------------------------

def _joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def scan_documents(docs: DataFrame, w: dict) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, n_crf, base_sha256, spans."""
    weights = docs.sparkSession.sparkContext.broadcast(w)     # fixed size, about 0.2 MB

    def run(batches):
        reader, model = Reader(), weights.value
        for b in batches:
            rows = [scan(t, reader, model) for t in b.column(1).to_pylist()]
            count = lambda kind: pa.array([sum(s[0] == kind for s in every) for _, every in rows], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *[count(k) for k in KINDS], pa.array([hashlib.sha256(_joined(base).encode()).hexdigest() for base, _ in rows], pa.string()),
                 pa.array([_joined(every) for _, every in rows], pa.string())],
                ["doc_id", "n_assign", "n_access", "n_hex", "n_crf", "base_sha256", "spans"])

    return map_arrow(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")),
        run, "doc_id long, n_assign long, n_access long, n_hex long, n_crf long, base_sha256 string, spans string")


def redact(text: str | None, spans: list[tuple[str, int, int]], mark: str = "[SECRET]") -> str | None:
    """Every stretch covered by spans becomes ``mark``."""
    if not spans:
        return text
    out, at = [], 0
    for _, a, b in sorted(spans, key=lambda s: s[1:]):
        if a >= at:
            out += [text[at:a], mark]
        at = max(at, b)
    return "".join([*out, text[at:]])


def redact_documents(docs: DataFrame, w: dict) -> DataFrame:
    """All columns of ``docs``, the text with its secrets replaced; n_chars, if
    there, follows the new text."""
    weights = docs.sparkSession.sparkContext.broadcast(w)

    def run(batches):
        reader, model = Reader(), weights.value
        for b in batches:
            texts = [redact(t, scan(t, reader, model)[1]) for t in b.column("text").to_pylist()]
            yield b.set_column(b.schema.get_field_index("text"), "text", pa.array(texts, pa.string()))

    flat = docs.toDF(*plain_names(docs.columns))
    done = map_arrow(flat, run, flat.schema).toDF(*docs.columns)
    return done.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else done


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return scan_documents(docs, train(docs))
