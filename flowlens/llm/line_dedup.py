"""Line dedup that can be taken back: sharded cuckoo filters backed by exact
reference-count tables.

A line's key is the line without ASCII white space at both ends, A-Z in lower
case; keys of at least ``KEY_CHARS`` code points count. A key that at least two
documents hold is *shared*: its lines stay in the document of smallest id (the
owner) and go everywhere else.

The index has three written tables:

* ``postings``: one row per row of the corpus and distinct key (doc_id, row hash,
  128-bit key);
* ``refs``: the exact counts, one row per key: rows that hold it, owner, largest id;
* ``filters``: one cuckoo filter per shard of the key space. A filter holds the
  16-bit fingerprint of a key once if one document holds it and twice if more do,
  each in one of two buckets of four. So it answers "is this key new" and "may it
  be shared" without a look at the exact table, and takes deletions. What finds no
  bucket goes to an exact list beside it. Its size is bounded: there are as many shards as
  it takes for ``SHARD_KEYS`` keys each (the shards are built anew when the corpus outgrows them).

``insert`` asks the filters which keys of the new rows may be known, reads the
exact counts of those only, and adds; ``delete`` removes documents: their postings
go, the keys they held are counted again from the postings left (so the next
document becomes owner, and its lines come back), and the filters lose the copies.
``dedup`` asks the filters for keys that may be shared, confirms them in the
exact table and rewrites the texts; a wrong yes of a filter therefore costs a
look-up and never a line.

Keys are counted before they are shuffled (a line that a third of all documents hold
is one row per map task), filters see each distinct key once, and shared keys meet
the postings in an equi-join that adaptive execution can split.

Defined results: a null or empty text is one empty line; repeated rows are one
document (same id) and keep their rows; a null doc_id counts as one more
document after all others (as id 2^63 - 1); an empty table gives an empty result;
other columns aren't read."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import map_arrow, materialize, splitmix, table

KEY_CHARS = 10            # shorter keys never go
SHARD_KEYS = 1 << 15      # keys per filter: 256 KB at most
BUCKET = 4                # fingerprints per bucket
FILL = 0.8                # of the places of a filter when it is built
KICKS = 200               # rounds of moving fingerprints before one goes to the list
NO_ID = (1 << 63) - 1     # stands for a null doc_id


def key_of(line: bytes) -> bytes | None:
    """The key of a lower-cased line, or None if it is too short."""
    key = line.strip()                # bytes: exactly the ASCII white space
    n = len(key)
    if n < KEY_CHARS or (n < 4 * KEY_CHARS and not key.isascii() and len(key.decode(errors="replace")) < KEY_CHARS):
        return None
    return key


def keyed_lines(text: str | None) -> list[bytes | None]:
    """128-bit hash of the key per line (None: too short)."""
    import xxhash

    digest = xxhash.xxh3_128_digest
    return [digest(k) if (k := key_of(line)) is not None else None for line in (text or "").encode().lower().split(b"\n")]


class Cuckoo:
    """Cuckoo filter over 64-bit keys: ``slots[bucket, 4]`` of 16-bit
    fingerprints (0: free) and a list of those that found no place."""

    def __init__(self, slots: np.ndarray, rest: np.ndarray):
        self.slots, self.rest = slots, rest

    @classmethod
    def sized(cls, copies: int) -> Cuckoo:
        buckets = 16
        while buckets * BUCKET * FILL < copies:
            buckets *= 2
        return cls(np.zeros((buckets, BUCKET), np.uint16), np.zeros(0, np.uint64))

    @classmethod
    def read(cls, slots: bytes, rest: list[int]) -> Cuckoo:
        return cls(np.frombuffer(slots, "<u2").reshape(-1, BUCKET).copy(), np.array(rest, np.int64).view(np.uint64))

    def written(self) -> tuple[bytes, list[int]]:
        return self.slots.astype("<u2").tobytes(), self.rest.view(np.int64).tolist()

    def _other(self, bucket: np.ndarray, print_: np.ndarray) -> np.ndarray:
        return bucket ^ (splitmix(print_.astype(np.uint64)) & np.uint64(len(self.slots) - 1)).astype(np.int64)

    def _places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        keys = keys.view(np.uint64)
        print_ = np.maximum(keys & np.uint64(0xFFFF), np.uint64(1)).astype(np.uint16)
        one = ((keys >> np.uint64(16)) & np.uint64(len(self.slots) - 1)).astype(np.int64)
        return print_, one, self._other(one, print_)

    @staticmethod
    def _code(print_, one, two):
        """A fingerprint and its pair of buckets as one number."""
        return (np.minimum(one, two).astype(np.uint64) << np.uint64(16)) | print_.astype(np.uint64)

    def _put(self, print_: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Puts fingerprints into free places of their buckets; which found none."""
        order = np.argsort(at, kind="stable")
        bucket = at[order]
        first = np.searchsorted(bucket, bucket)              # rank among those of the same bucket
        rank = np.arange(len(bucket)) - first
        free = self.slots[bucket] == 0
        fits = rank < free.sum(axis=1)
        nth = (np.cumsum(free, axis=1) == rank[:, None] + 1) & free
        self.slots[bucket[fits], nth[fits].argmax(axis=1)] = print_[order][fits]
        left = np.ones(len(at), bool)
        left[order[fits]] = False
        return left

    def add(self, keys: np.ndarray) -> None:
        """One copy of each key."""
        print_, at, two = self._places(keys)
        left = self._put(print_, at)
        print_, at = print_[left], two[left]
        left = self._put(print_, at)
        print_, at = print_[left], at[left]
        random = np.random.default_rng(len(keys))
        for _ in range(KICKS):
            if not len(print_):
                return
            # one newcomer per bucket takes a place there; whoever had it moves to its other bucket
            _, chosen = np.unique(at, return_index=True)
            slot = random.integers(0, BUCKET, len(chosen))
            evicted = self.slots[at[chosen], slot].copy()
            self.slots[at[chosen], slot] = print_[chosen]
            moved = self._other(at[chosen], evicted)
            keep = np.ones(len(print_), bool)
            keep[chosen] = False
            print_, at = np.concatenate([print_[keep], evicted]), np.concatenate([at[keep], moved])
            taken = print_ == 0                              # a place was free after all
            print_, at = print_[~taken], at[~taken]
            left = self._put(print_, at)
            print_, at = print_[left], at[left]
        self.rest = np.sort(np.concatenate([self.rest, self._code(print_, at, self._other(at, print_))]))

    def count(self, keys: np.ndarray) -> np.ndarray:
        """Copies that may be of each key: never fewer than were added and not removed."""
        print_, one, two = self._places(keys)
        found = (self.slots[one] == print_[:, None]).sum(axis=1)
        found += np.where(one == two, 0, (self.slots[two] == print_[:, None]).sum(axis=1))
        code = self._code(print_, one, two)
        return found + np.searchsorted(self.rest, code, "right") - np.searchsorted(self.rest, code, "left")

    def remove(self, keys: np.ndarray) -> None:
        """One copy of each key, all of which must have been added."""
        print_, one, two = self._places(keys)
        for p, x, y, code in zip(print_, one, two, self._code(print_, one, two)):
            for bucket in (x, y):
                hit = np.flatnonzero(self.slots[bucket] == p)
                if len(hit):
                    self.slots[bucket, hit[0]] = 0
                    break
            else:
                at = np.searchsorted(self.rest, code)
                if at == len(self.rest) or self.rest[at] != code:
                    raise ValueError("a key to remove isn't in the filter")
                self.rest = np.delete(self.rest, at)


class LineIndex(NamedTuple):
    postings: DataFrame       # doc bigint, row bigint, k1 bigint, k2 bigint
    refs: DataFrame           # k1, k2, n bigint, owner bigint, last bigint
    filters: DataFrame        # shard bigint, slots binary, rest array<bigint>
    shards: int


_FILTER = "shard long, slots binary, rest array<long>"


def _postings_task(batches):
    for b in batches:
        docs, rows, keys = [], [], []
        for doc, row, text in zip(*(c.to_pylist() for c in b.columns)):
            own = {k for k in keyed_lines(text) if k is not None}
            docs += [doc] * len(own)
            rows += [row] * len(own)
            keys += own
        k = np.frombuffer(b"".join(keys), "<i8").reshape(-1, 2)
        yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(rows, pa.int64()), pa.array(k[:, 0]), pa.array(k[:, 1])],
                                         ["doc", "row", "k1", "k2"])


def _named(docs: DataFrame) -> DataFrame:
    """(doc, row, text): row tells rows of one id with different texts apart."""
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"),
                       F.xxhash64(F.col("text").cast("string")).alias("row"), F.col("text").cast("string").alias("text"))


def postings_of(docs: DataFrame) -> DataFrame:
    return materialize(map_arrow(_named(docs), _postings_task, "doc long, row long, k1 long, k2 long"), "lines-postings")


def _counted(postings: DataFrame) -> DataFrame:
    return postings.groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("n"), F.min("doc").alias("owner"), F.max("doc").alias("last"))


def _copies():
    """Fingerprints of a key in its filter: one, or two if it is shared."""
    return F.lit(1) + (F.col("owner") < F.col("last")).cast("int")


def _shard(shards: int):
    return F.pmod("k2", F.lit(shards)).alias("shard")


def _build_filters(refs: DataFrame, shards: int) -> DataFrame:
    def build(key, rows):
        k, copies = rows.column("k1").to_numpy(), rows.column("copies").to_numpy()
        own = Cuckoo.sized(max(int(copies.sum()), SHARD_KEYS))
        own.add(np.concatenate([k, k[copies > 1]]))
        slots, rest = own.written()
        return pa.table({"shard": pa.array([key[0].as_py()], pa.int64()), "slots": pa.array([slots], pa.binary()), "rest": pa.array([rest], pa.list_(pa.int64()))})

    # a shard has about SHARD_KEYS keys, by their hash
    return materialize(refs.select(_shard(shards), "k1", _copies().alias("copies")).groupBy("shard").applyInArrow(build, _FILTER), "lines-filters")


def _probe(keys: DataFrame, index: LineIndex, least: int) -> DataFrame:
    """The rows of keys (k1, k2 once each) of which the filters may hold ``least`` copies or more."""
    def probe(_, rows, filters):
        if not len(filters) or not len(rows):
            return rows.slice(0, 0)
        own = Cuckoo.read(filters.column("slots")[0].as_py(), filters.column("rest")[0].as_py())
        return rows.filter(pa.array(own.count(rows.column("k1").to_numpy()) >= least))

    sharded = keys.select(_shard(index.shards), *keys.columns)
    kinds = ", ".join(f"{c} {t}" for c, t in sharded.dtypes)
    return sharded.groupBy("shard").cogroup(index.filters.groupBy("shard")).applyInArrow(probe, kinds).drop("shard")


def _change(changes: DataFrame, index: LineIndex) -> DataFrame:
    """The filters after ``changes`` (k1, k2, copies: added, or removed if negative)."""
    def change(key, rows, filters):
        k, by = rows.column("k1").to_numpy(), rows.column("copies").to_numpy()
        own = Cuckoo.read(filters.column("slots")[0].as_py(), filters.column("rest")[0].as_py()) if len(filters) else Cuckoo.sized(SHARD_KEYS)
        own.remove(np.repeat(k, np.maximum(-by, 0)))
        own.add(np.repeat(k, np.maximum(by, 0)))
        slots, rest = own.written()
        return pa.table({"shard": pa.array([key[0].as_py()], pa.int64()), "slots": pa.array([slots], pa.binary()), "rest": pa.array([rest], pa.list_(pa.int64()))})

    return materialize(changes.select(_shard(index.shards), "k1", "copies").groupBy("shard")
                       .cogroup(index.filters.groupBy("shard")).applyInArrow(change, _FILTER), "lines-filters")


def _shards_for(keys: int) -> int:
    shards = 1
    while shards * SHARD_KEYS < keys:
        shards *= 2
    return shards


def build(docs: DataFrame) -> LineIndex:
    """The index of a first set of documents."""
    postings = postings_of(docs)
    refs = materialize(_counted(postings), "lines-refs")
    shards = _shards_for(refs.count())
    return LineIndex(postings, refs, _build_filters(refs, shards), shards)


def insert(index: LineIndex, docs: DataFrame) -> LineIndex:
    """The index with further documents (further rows of known ids, too)."""
    new = postings_of(docs)
    counted = materialize(_counted(new), "lines-new")
    # only keys that the filters may know are looked up in the exact counts
    known = materialize(_probe(counted.select("k1", "k2"), index, 1).join(index.refs, ["k1", "k2"]), "lines-known")
    old = known.select("k1", "k2", F.col("n").alias("n0"), F.col("owner").alias("owner0"), F.col("last").alias("last0"))
    both = materialize(counted.join(old, ["k1", "k2"], "left").select(
        "k1", "k2", (F.col("n") + F.coalesce("n0", F.lit(0))).alias("n"), F.least("owner", "owner0").alias("owner"), F.greatest("last", "last0").alias("last"),
        F.coalesce(F.lit(1) + (F.col("owner0") < F.col("last0")).cast("int"), F.lit(0)).alias("had")), "lines-changed")
    refs = materialize(index.refs.join(known.select("k1", "k2"), ["k1", "k2"], "left_anti").unionByName(both.drop("had")), "lines-refs")
    postings = materialize(index.postings.unionByName(new), "lines-postings")
    shards = _shards_for(refs.count())
    if shards > index.shards:         # outgrown: filters of the new number of shards, from the exact counts
        return LineIndex(postings, refs, _build_filters(refs, shards), shards)
    changes = both.select("k1", "k2", (_copies() - F.col("had")).alias("copies"))
    return LineIndex(postings, refs, _change(changes, index), index.shards)


def delete(index: LineIndex, ids: DataFrame) -> LineIndex:
    """The index without the documents whose ids stand in ids(doc_id)."""
    gone = ids.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc")).distinct()
    keys = materialize(index.postings.join(gone, "doc", "left_semi").select("k1", "k2").distinct(), "lines-touched")
    postings = materialize(index.postings.join(gone, "doc", "left_anti"), "lines-postings")
    after = materialize(_counted(postings.join(keys, ["k1", "k2"], "left_semi")), "lines-changed")
    before = index.refs.join(keys, ["k1", "k2"], "left_semi").select("k1", "k2", _copies().alias("had"))
    changes = before.join(after, ["k1", "k2"], "left").select("k1", "k2", (F.coalesce(_copies(), F.lit(0)) - F.col("had")).alias("copies"))
    refs = materialize(index.refs.join(keys, ["k1", "k2"], "left_anti").unionByName(after), "lines-refs")
    return LineIndex(postings, refs, _change(changes, index), index.shards)


def _rewrite(batches):
    for b in batches:
        out = {"doc_id": b.column(0), "n_lines": [], "n_dropped": [], "text": []}
        for text, gone in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
            text = text or ""
            if gone is None:
                kept, n = text, text.count("\n") + 1
                out["n_dropped"].append(0)
            else:
                drop = {np.array([g["k1"], g["k2"]], "<i8").tobytes() for g in gone}
                lines, keys = text.split("\n"), keyed_lines(text)
                left = [line for line, k in zip(lines, keys) if k is None or k not in drop]
                kept, n = "\n".join(left), len(lines)
                out["n_dropped"].append(n - len(left))
            out["n_lines"].append(n)
            out["text"].append(kept)
        yield pa.RecordBatch.from_arrays(
            [out["doc_id"], pa.array(out["n_lines"], pa.int64()), pa.array(out["n_dropped"], pa.int64()), pa.array(out["text"], pa.string())],
            ["doc_id", "n_lines", "n_dropped", "text"])


def dedup(index: LineIndex, docs: DataFrame, postings: DataFrame | None = None) -> DataFrame:
    """doc_id, n_lines, n_dropped, text (the lines that stay) per row of
    ``docs``, rows that the index holds. ``postings``: those of docs, if known."""
    postings = postings_of(docs) if postings is None else postings
    asked = postings.select("k1", "k2").distinct()
    shared = materialize(_probe(asked, index, 2).join(index.refs.where("owner < last"), ["k1", "k2"]).select("k1", "k2", "owner"), "lines-shared")
    gone = postings.join(shared, ["k1", "k2"]).where("doc <> owner").select("doc", "row", F.struct("k1", "k2").alias("key"))
    # keys of one text, once each; grouped by other keys than the join's, so its hot keys may be split
    lists = gone.groupBy("doc", "row").agg(F.collect_set("key").alias("gone"))
    named = _named(docs).withColumn("doc_id", F.col("doc"))
    met = named.join(lists, ["doc", "row"], "left").select(F.nullif("doc_id", F.lit(NO_ID)).alias("doc_id"), "text", "gone")
    return map_arrow(met, _rewrite, "doc_id long, n_lines long, n_dropped long, text string")


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    index = build(docs)
    return dedup(index, docs, index.postings).select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))
