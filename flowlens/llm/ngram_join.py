"""N-gram Jaccard join with adaptive multi-match prefixes.

A document is the set of its distinct word shingles (as 64-bit hashes); two
documents link when ``100 * |A n B| >= percent * |A u B|``. The result is one
row per document with its class: the connected component of the links.

Method. All sets are sorted by one global order: estimated document frequency,
then hash. Linked sets share at least ``ceil(percent * |A|)`` shingles, so for
every m they share at least m shingles among the first
``|A| - ceil(percent * |A|) + m`` of both (the m-prefixes). Each document
chooses its own m: a longer prefix reads more posting entries but lets a
candidate through only after m shared prefix shingles; the m of least estimated
cost (entries read plus verification of the candidates expected) is taken. Two
documents must then share at least min(m_A, m_B) prefix shingles, whatever the
other one chose, before their whole sets are intersected. (Ahead of that a
sketch of bucket counts gives an upper bound of the intersection, which spares
shipping the sets of most pairs that merely share a passage.)

Equal sets are collapsed first (128-bit digest). Then the pairs of each posting
are worked off without emitting all of them:

1. Every member meets the head of the posting (the member made most of frequent
   shingles, so usually the original of a group of copies). Members near the
   head are kept with their difference D from it (shingles in one of the two
   sets only). For two of them |A x B| (the size of the symmetric difference) is
   |D_A| + |D_B| - 2 |D_A n D_B|, and a link needs it to be at most
   c (|A| + |B|), c = (100 - percent) / (100 + percent). With a = |D| - c |set|
   the differences of a linked pair share at least (a_A + a_B) / 2 shingles. If
   that is not positive both link to the head (its a is -c |head|), so they are
   in one class; otherwise the prefix filter on the differences finds the pair.
   Differences are small and mostly unlike, so a large group of near copies
   yields few candidates.
2. What is left are pairs of a posting that aren't both near its head. Only
   links between *different* classes matter, so these go in rounds: if the
   untested pairs across classes are few (at most ``FINISH`` per posting entry)
   all are tried and the join is complete; else a few members of the smallest
   classes are compared with all others and leave the posting.

Nothing is capped: it ends when no untested pair across classes is left.

The estimated frequencies only order the shingles, so an error there costs time
and never a link. They are counted per chunk of rows (shingles seen at least
twice in a chunk, so every shingle of more documents than there are chunks is
found), summed over the corpus, and the ``FREQUENT`` highest are shipped to the
tasks (16 bytes each: the bound of that broadcast). Posting entries of those shingles go on as they
are; the others are shuffled once, by shingle, and an entry stays if a neighbour in
the sorted order has the same shingle. So nothing of the size of the corpus is broadcast, and the shingles
that share a task by their hash are rare ones.

Defined results: documents without words (or null) have n_shingles 0 and are
linked with nothing: their component_id is their own id; repeated rows are
linked with each other and each get a row; a null doc_id takes part and counts
as no id (a component of such rows only has a null component_id); an empty table
gives an empty result; further columns are not read."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..functions.names import unused
from .common import Memo, map_arrow, materialize, splitmix, table, word_hash
from .components import components

FREQUENT = 1 << 18        # shingles whose estimated frequency is shipped to the tasks
CHUNK = 2_000_000         # shingles counted together by a task
LONGEST = 8               # largest m of the m-prefixes
NEAR = 25                 # a head's differences are used for sets within so many percent below the threshold
LEADERS = 8               # members per posting compared with the rest in round two; doubled from round to round
FINISH = 4                # all remaining pairs are tried once they are this few per posting entry
SLOTS = 1 << 20           # slots of the broadcast that picks the documents whose whole sets are needed


def shingle_set(text: str | None, size: int, memo: Memo) -> np.ndarray:
    """Sorted distinct shingle hashes. Words are runs of bytes other than
    ASCII white space after lower-casing A-Z; a shorter text is one shingle."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    memo.trim()
    h = np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))
    k = min(size, len(h))
    rows = len(h) - k + 1
    acc = np.full(rows, k, np.uint64)
    for j in range(k):
        acc = splitmix(acc * np.uint64(0x9E3779B97F4A7C15) + h[j:j + rows])
    return np.unique(acc)


def digest(s: np.ndarray) -> bytes:
    import xxhash

    return xxhash.xxh3_128_digest(s.tobytes())


def least_overlap(n: int, percent: int) -> int:
    """Shingles that a set of n shares at least with any set it links to."""
    return -(-percent * n // 100)


def choose_prefix(rare: int, frequency: np.ndarray, n: int, percent: int) -> int:
    """The m of least estimated cost. In the global order come ``rare``
    shingles of (estimated) frequency 1, then those of ``frequency``."""
    t = least_overlap(n, percent)
    top = min(LONGEST, t)
    if n - t + 1 <= rare:
        return 1             # nothing frequent in the shortest prefix: no cost to save
    others = np.concatenate([[0], np.cumsum(frequency - 1)])
    best, cost = 1, math.inf
    for m in range(1, top + 1):
        entries = float(others[max(0, min(n, n - t + m) - rare)])
        # at most entries / m documents can share m of these shingles
        c = entries + entries / m * n / 50
        if c < cost:
            best, cost = m, c
    return best


def sketch(s: np.ndarray) -> bytes:
    """Counts of the shingles by hash, in 64, 128, ... buckets (about four per
    bucket): an upper bound of any intersection, see ``most_shared``."""
    buckets = 64
    while buckets * 4 < len(s):
        buckets *= 2
    while True:
        counts = np.bincount((s & np.uint64(buckets - 1)).astype(np.int64), minlength=buckets)
        if counts.max() < 256:
            return counts.astype(np.uint8).tobytes()
        buckets *= 2


def most_shared(x: bytes, y: bytes) -> int:
    """Upper bound of the intersection of two sets from their sketches."""
    a, b = np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)
    if len(a) < len(b):
        a, b = b, a
    if len(a) > len(b):      # buckets are the low bits: fold the finer one
        a = a.reshape(-1, len(b)).sum(axis=0, dtype=np.int64)
    return int(np.minimum(a, b).sum(dtype=np.int64))


def _frequent(batches, size: int):
    """Shingles found in two or more different sets of a chunk, with counts."""
    memo, held, seen, total = Memo(word_hash), [], set(), 0

    def flush():
        values, counts = np.unique(np.concatenate(held), return_counts=True)
        keep = counts > 1
        return pa.RecordBatch.from_arrays([pa.array(values[keep].view(np.int64)), pa.array(counts[keep])], ["token", "c"])

    for b in batches:
        for t in b.column(0).to_pylist():
            s = shingle_set(t, size, memo)
            d = digest(s)
            if len(s) and d not in seen:
                seen.add(d)
                held.append(s)
                total += len(s)
            if total >= CHUNK:
                yield flush()
                held, seen, total = [], set(), 0
    if held:
        yield flush()


def frequencies(docs: DataFrame, size: int) -> dict[str, np.ndarray]:
    """The FREQUENT most frequent shingles by estimated document frequency."""
    counts = map_arrow(docs.select("text"), lambda b: _frequent(b, size), "token long, c long") \
        .groupBy("token").agg(F.sum("c").alias("c")).where("c >= 3") \
        .orderBy(F.desc("c"), "token").limit(FREQUENT).toArrow()
    token = counts.column("token").to_numpy().view(np.uint64)
    order = np.argsort(token)
    return {"token": token[order], "c": counts.column("c").to_numpy()[order]}


def lists(arrays: list[np.ndarray], kind=np.int64) -> pa.ListArray:
    offsets = np.zeros(len(arrays) + 1, np.int32)
    np.cumsum([len(a) for a in arrays], out=offsets[1:])
    values = np.concatenate(arrays) if arrays else np.zeros(0, kind)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.view(kind)))


def _prefixes(batches, frequent, size: int, percent: int):
    """Per row: digest of its set, size, m, rank (small: shares most with
    others), sketch, the m-prefix, and how many shingles of it (the first ones)
    aren't among the frequent ones."""
    token, count = frequent.value["token"], frequent.value["c"]
    maybe = np.zeros(1 << 22, bool)              # spares most look-ups
    low = np.uint64(len(maybe) - 1)
    maybe[token & low] = True
    memo = Memo(word_hash)
    for b in batches:
        digests, sizes, ms, ranks, sketches, prefixes, rares = [], [], [], [], [], [], []
        for t in b.column(1).to_pylist():
            s = shingle_set(t, size, memo)
            n = len(s)
            sizes.append(n)
            if not n:
                digests.append(None), ms.append(0), ranks.append(0), sketches.append(None), prefixes.append(s), rares.append(0)
                continue
            hit = np.flatnonzero(maybe[s & low])
            at = np.minimum(np.searchsorted(token, s[hit]), max(len(token) - 1, 0))
            hit, at = (hit[token[at] == s[hit]], at[token[at] == s[hit]]) if len(token) else (hit[:0], at[:0])
            f = count[at]
            order = np.argsort(f, kind="stable")         # s is sorted: ties by hash
            rare = np.ones(n, bool)
            rare[hit] = False
            m = choose_prefix(n - len(hit), f[order], n, percent)
            p = min(n, n - least_overlap(n, percent) + m)
            first = s[rare][:p]
            digests.append(digest(s)), ms.append(m), sketches.append(sketch(s)), rares.append(len(first))
            ranks.append(int(1_000_000 * (n - len(hit)) / n))
            prefixes.append(first if len(first) == p else np.concatenate([first, s[hit[order][:p - len(first)]]]))
        yield pa.RecordBatch.from_arrays(
            [b.column(0), b.column(2), pa.array(digests, pa.binary()), pa.array(sizes, pa.int64()), pa.array(ms, pa.int32()),
             pa.array(ranks, pa.int32()), pa.array(sketches, pa.binary()), lists(prefixes), pa.array(rares, pa.int32())],
            ["doc_id", "text_hash", "digest", "n", "m", "rank", "sketch", "prefix", "n_rare"])


def _sets(batches, size: int):
    memo = Memo(word_hash)
    for b in batches:
        sets = [s for s in (shingle_set(t, size, memo) for t in b.column(0).to_pylist()) if len(s)]
        if sets:
            yield pa.RecordBatch.from_arrays([pa.array([digest(s) for s in sets], pa.binary()), lists(sets)], ["digest", "tokens"])


def _may_reach(batches, percent: int):
    """pairs (a, b, n_a, n_b, sketch_a, sketch_b) whose sketches allow ``percent``."""
    for b in batches:
        shared = np.array([most_shared(x, y) for x, y in zip(b.column(4).to_pylist(), b.column(5).to_pylist())], np.int64)
        n = b.column(2).to_numpy() + b.column(3).to_numpy()
        keep = pa.array(100 * shared >= percent * (n - shared))
        yield pa.RecordBatch.from_arrays([c.filter(keep) for c in b.columns[:4]], b.schema.names[:4])


def _slot():
    return F.pmod(F.xxhash64("doc_id"), F.lit(SLOTS)).cast("int")


def _compatible(percent: int):
    """Sizes that allow a link at all."""
    return 100 * F.least("n", "n2") >= percent * F.greatest("n", "n2")


def _side(t: DataFrame, k: str) -> DataFrame:
    return t.select(F.col("nid").alias(k), *[F.col(c).alias(f"{c}_{k}") for c in t.columns if c != "nid"])


def _allowed(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """pairs(a, b) -> (a, b, n_a, n_b) that the sketches allow to reach ``percent``."""
    light = nodes.select("nid", "n", "sketch")
    both = pairs.join(_side(light, "a"), "a").join(_side(light, "b"), "b").select("a", "b", "n_a", "n_b", "sketch_a", "sketch_b")
    return map_arrow(both, lambda b: _may_reach(b, percent), "a long, b long, n_a long, n_b long")


def _whole(pairs: DataFrame, nodes: DataFrame, src: DataFrame, size: int) -> DataFrame:
    """(nid, tokens) of every node in pairs(a, b). Rows are picked by a hash of
    their id in SLOTS slots (so the broadcast is bounded), then exactly by digest."""
    chosen = pairs.select(F.col("a").alias("nid")).union(pairs.select("b")).distinct().join(nodes.select("nid", "digest", "doc_id"), "nid")
    slots = chosen.select(_slot().alias("slot")).distinct()
    texts = src.withColumn("slot", _slot()).join(F.broadcast(slots), "slot", "left_semi").select("text")
    return materialize(map_arrow(texts, lambda b: _sets(b, size), "digest binary, tokens array<long>").dropDuplicates(["digest"])
                       .join(chosen.select("nid", "digest"), "digest").select("nid", "tokens"), "ngram-sets")


def _verified(pairs: DataFrame, nodes: DataFrame, src: DataFrame, size: int, percent: int) -> DataFrame:
    """pairs(a, b) -> linked pairs (a, b): the sketches, the multi-match test on
    the prefixes, then the whole sets."""
    light = nodes.select("nid", "m", "prefix")
    met = materialize(
        _allowed(pairs, nodes, percent).join(_side(light, "a"), "a").join(_side(light, "b"), "b")
        .where(F.size(F.array_intersect("prefix_a", "prefix_b")) >= F.least("m_a", "m_b")).select("a", "b", "n_a", "n_b"), "ngram-met")
    sets = _whole(met, nodes, src, size)
    whole = met.join(_side(sets, "a"), "a").join(_side(sets, "b"), "b") \
        .select("a", "b", "n_a", "n_b", F.size(F.array_intersect("tokens_a", "tokens_b")).alias("shared"))
    return whole.where(100 * F.col("shared") >= percent * (F.col("n_a") + F.col("n_b") - F.col("shared"))).select("a", "b")


def _near(led: DataFrame, nodes: DataFrame, src: DataFrame, size: int, percent: int) -> DataFrame:
    """led(a: member, b: head) -> the pairs whose similarity is at least percent -
    NEAR: nid, n, h, n_h, linked, delta (shingles of one of the two only)."""
    close = max(percent - NEAR, 1)
    led = materialize(_allowed(led, nodes, close), "ngram-led")
    sets = _whole(led, nodes, src, size)
    both = led.join(_side(sets, "b"), "b").join(_side(sets, "a"), "a")
    both = both.select("*", F.size(F.array_intersect("tokens_a", "tokens_b")).alias("shared"))
    reaches = lambda p: 100 * F.col("shared") >= p * (F.col("n_a") + F.col("n_b") - F.col("shared"))
    return both.where(reaches(close)).select(
        F.col("a").alias("nid"), F.col("n_a").alias("n"), F.col("b").alias("h"), F.col("n_b").alias("n_h"), reaches(percent).alias("linked"),
        F.concat(F.array_except("tokens_a", "tokens_b"), F.array_except("tokens_b", "tokens_a")).alias("delta"))


def _linked_by_differences(near: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between members near one head that aren't both linked to
    it: unlinked with unlinked members, and unlinked with linked ones. Each kind
    has its own least number of shared differences, hence its own prefixes."""
    c = (100 - percent) / (100 + percent)
    a = near.select("nid", "h", "n", "linked", (F.size("delta") - c * F.col("n")).alias("a"))
    lowest = a.groupBy("h").agg(F.min(F.when(F.col("linked"), F.col("a"))).alias("low_linked"),
                                F.min(F.when(~F.col("linked"), F.col("a"))).alias("low_other")).where("low_other is not null")
    lowest = materialize(lowest, "ngram-lowest")         # its real size decides the joins: a large head's members stay spread
    least = lambda low: F.greatest(F.lit(1), F.ceil((F.col("a") + low) / 2 - 1e-6))
    a = a.join(lowest, "h").select(
        "h", "nid", "n", "linked", F.when(~F.col("linked"), least(F.col("low_other"))).alias("own"),
        least(F.when(F.col("linked"), F.col("low_other")).otherwise(F.col("low_linked"))).alias("across"),
        F.col("low_linked").isNotNull().alias("mixed"))
    entries = near.join(lowest.select("h"), "h").select("nid", "h", F.explode("delta").alias("token"))
    # differences that two members have at all, rare ones first; the others would stand before them in
    # the order, so a prefix of d - least + 1 differences holds (shared ones) - least + 1 of these
    twice = entries.groupBy("h", "token").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    order = entries.join(twice, ["h", "token"]).groupBy("h", "nid").agg(F.array_sort(F.collect_list(F.struct("c", "token"))).alias("order"))
    ordered = order.join(a, ["h", "nid"])

    def prefix(which: DataFrame, bound: str) -> DataFrame:
        front = F.size("order") - F.col(bound) + 1
        return which.where(front > 0).select("h", "nid", "n", F.explode(F.slice("order", F.lit(1), front.cast("int"))).alias("o")) \
            .select("h", "nid", "n", "o.token")

    def meet(one: DataFrame, two: DataFrame, extra) -> DataFrame:
        second = two.select("h", "token", F.col("nid").alias("nid2"), F.col("n").alias("n2"))
        return one.join(second, ["h", "token"]).where(extra & _compatible(percent)).select("h", "nid", "nid2").distinct()

    own = prefix(ordered.where(~F.col("linked")), "own")
    pairs = meet(own, own, F.col("nid") < F.col("nid2")).union(
        meet(prefix(ordered.where(~F.col("linked") & F.col("mixed")), "across"), prefix(ordered.where("linked"), "across"), F.lit(True)))
    one = near.select("h", "nid", "n", "delta")
    two = near.select("h", F.col("nid").alias("nid2"), F.col("n").alias("n2"), F.col("delta").alias("delta2"))
    apart = F.size("delta") + F.size("delta2") - 2 * F.size(F.array_intersect("delta", "delta2"))
    both = pairs.join(one, ["h", "nid"]).join(two, ["h", "nid2"]).select(
        F.col("nid").alias("a"), F.col("nid2").alias("b"), "n", "n2", ((F.col("n") + F.col("n2") - apart) / 2).alias("shared"))
    return both.where(100 * F.col("shared") >= percent * (F.col("n") + F.col("n2") - F.col("shared"))).select("a", "b")


def jaccard_classes(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """docs(doc_id, text, ...) -> one row per row of docs: doc_id, text_hash,
    n_shingles, component_id (smallest doc_id of the class), leader_hash (the
    text_hash of the row that stands for the class: smallest doc_id, then hash)."""
    spark = docs.sparkSession
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    frequent = spark.sparkContext.broadcast(frequencies(src, size))
    rows = materialize(map_arrow(
        src.select("doc_id", "text", F.xxhash64("text").alias("text_hash")), lambda b: _prefixes(b, frequent, size, percent),
        "doc_id long, text_hash long, digest binary, n long, m int, rank int, sketch binary, prefix array<long>, n_rare int"), "ngram-rows")
    own = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")     # null ids last
    nodes = materialize(
        rows.where("digest is not null").groupBy("digest").agg(
            F.min(own).alias("best"), F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("m").alias("m"), F.first("rank").alias("rank"),
            F.first("sketch").alias("sketch"), F.first("prefix").alias("prefix"), F.first("n_rare").alias("n_rare"))
        .withColumn("nid", F.monotonically_increasing_id()), "ngram-nodes")

    # posting entries of the shingles that stand in two or more prefixes: the frequent ones as they are, the
    # others (nearly all of which stand alone) sorted by shingle, where an equal neighbour tells
    often = nodes.select("nid", F.explode(F.expr("slice(prefix, n_rare + 1, size(prefix))")).alias("token"))
    rare = nodes.select("nid", F.explode(F.expr("slice(prefix, 1, n_rare)")).alias("token"))
    posting = Window.partitionBy("token").orderBy("nid")
    rare = rare.select("*", F.coalesce(F.lag("nid").over(posting), F.lead("nid").over(posting)).alias("other")).where("other is not null").drop("other")
    active = materialize(often.unionByName(rare).join(nodes.select("nid", "n", "rank"), "nid"), "ngram-postings")
    # round one: each posting's most central member against the others, and the others among themselves
    # through their differences from it
    heads = materialize(active.groupBy("token").agg(F.min(F.struct("rank", "nid", "n")).alias("head"))
                        .select("token", F.col("head.nid").alias("h"), F.col("head.n").alias("n2")), "ngram-heads")
    led = active.join(heads, "token").where((F.col("nid") != F.col("h")) & _compatible(max(percent - NEAR, 1))).select(F.col("nid").alias("a"), F.col("h").alias("b")).distinct()
    near = materialize(_near(led, nodes, src, size, percent), "ngram-near")
    edges = materialize(near.where("linked").select(F.col("h").alias("a"), F.col("nid").alias("b"))
                        .union(_linked_by_differences(near, percent)), "ngram-links")
    classes = components(edges)
    # pairs of a posting that are both near its head are settled: they share a home
    close = near.select("nid", "h", F.lit(True).alias("near"))
    active = materialize(
        active.join(heads.drop("n2"), "token").join(close, ["nid", "h"], "left")
        .select("token", "nid", "n", "rank", F.when(F.col("near") | (F.col("nid") == F.col("h")), F.col("h")).otherwise(F.col("nid")).alias("home")),
        "ngram-postings")

    leaders_each = LEADERS
    while True:
        now = active.join(classes.withColumnRenamed("node", "nid"), "nid", "left").withColumn("root", F.coalesce("root", "nid"))
        # postings that may still hold an untested pair across classes
        square = lambda key: now.groupBy("token", key).agg(F.count(F.lit(1)).alias("s")).groupBy("token").agg(
            F.sum("s").alias(f"k_{key}"), F.sum(F.col("s") * F.col("s")).alias(f"q_{key}"))
        open_ = square("root").join(square("home"), "token").select(
            "token", F.col("k_root").alias("k"), F.greatest("q_root", "q_home").alias("q")).where("k * k > q")
        now = materialize(now.join(open_.select("token", "k", "q"), "token"), "ngram-open")
        left = now.agg(F.coalesce(F.sum(F.expr("(k * k - q) / (2 * k)")), F.lit(0.0)).alias("pairs"),
                       F.count(F.lit(1)).alias("entries")).first()
        if not left["entries"]:
            break
        last = left["pairs"] <= FINISH * left["entries"]
        other = now.select("token", F.col("nid").alias("nid2"), F.col("n").alias("n2"), F.col("root").alias("root2"),
                           F.col("home").alias("home2"), F.col("rank").alias("rank2"))
        if last:
            met = now.join(other, "token").where("nid < nid2")
        else:
            of_class = now.select("nid", "root").distinct().groupBy("root").agg(F.count(F.lit(1)).alias("members"))
            ranked = other.join(of_class.withColumnRenamed("root", "root2"), "root2")
            leaders = materialize(_smallest(ranked, F.struct("members", "rank2", "nid2"), leaders_each), "ngram-leaders")
            met = now.join(leaders, "token").where("nid <> nid2")
        pairs = met.where((F.col("root") != F.col("root2")) & (F.col("home") != F.col("home2")) & _compatible(percent)) \
            .select(F.least("nid", "nid2").alias("a"), F.greatest("nid", "nid2").alias("b")).distinct()
        edges = edges.union(materialize(_verified(pairs, nodes, src, size, percent), "ngram-links"))
        classes = components(edges)
        if last:
            break
        active = now.drop("root", "k", "q").join(leaders.select("token", F.col("nid2").alias("nid")), ["token", "nid"], "left_anti")
        leaders_each *= 2

    known = nodes.select("nid", "digest", "best").join(classes.withColumnRenamed("node", "nid"), "nid", "left") \
        .withColumn("root", F.coalesce("root", "nid"))
    leader = known.groupBy("root").agg(F.min("best").alias("leader"))
    of = rows.select("doc_id", "text_hash", "digest", "n").join(known.join(leader, "root").select("digest", "leader"), "digest", "left")
    return of.select("doc_id", "text_hash", F.col("n").alias("n_shingles"),
                     F.when(F.col("leader").isNull(), F.col("doc_id")).otherwise(F.col("leader.doc_id")).alias("component_id"),
                     F.when(F.col("leader").isNull(), F.col("text_hash")).otherwise(F.col("leader.text_hash")).alias("leader_hash"))


def _smallest(entries: DataFrame, by, k: int) -> DataFrame:
    """The k smallest entries of each token (a group limit before the shuffle)."""
    ordered = entries.withColumn("at", F.row_number().over(Window.partitionBy("token").orderBy(by)))
    return ordered.where(F.col("at") <= k).select("token", "nid2", "n2", "root2", "home2")


def keep_one(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that stand for their class (smallest doc_id, then
    hash of the text), unchanged; of rows equal in id and text one stays.
    Documents without words are no copies of each other and all stay."""
    classes = materialize(jaccard_classes(docs, size, percent), "ngram-classes")
    stands = classes.where("n_shingles = 0 or (doc_id <=> component_id and text_hash = leader_hash)")
    mark = materialize(stands.groupBy("doc_id", "text_hash").agg(
        F.count(F.lit(1)).alias("rows"), F.max("n_shingles").alias("n")), "ngram-kept")
    of_id, of_hash = unused(docs.columns, "mark_id", "mark_hash")
    key = lambda: [F.col("doc_id").cast("long").eqNullSafe(F.col(of_id)), F.xxhash64(F.col("text").cast("string")) == F.col(of_hash)]
    named = lambda rows: rows.select(F.col("doc_id").alias(of_id), F.col("text_hash").alias(of_hash))
    # a row that comes once (or has no words) needs no look at its equals
    once = docs.join(named(mark.where("rows = 1 or n = 0")), key(), "left_semi")
    again = named(mark.where("rows > 1 and n > 0"))
    if again.isEmpty():
        return once
    return once.unionByName(docs.join(again, key(), "left_semi").dropDuplicates(["doc_id", "text"]))


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_classes(table(spark, sf_dir, "documents"), size=3, percent=90).select("doc_id", "n_shingles", "component_id")
