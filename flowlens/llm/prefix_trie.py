"""Prefix trie of conversations by ROLLUP over positional turn columns.

A conversation is the sequence of its turns (role, text); a node of the trie is a
distinct sequence of the first d turns of at least one conversation, from the textless root
(d = 0). Every conversation that begins with it is a member.

Method. Each turn is named by a 128-bit digest of role and text. A *block* lays ``BLOCK``
successive turns of a conversation side by side in columns t0..t7, and one
``GROUP BY node, ROLLUP(t0, .., t7)`` aggregates all prefixes of the block together;
``grouping_id`` tells how many turns a group holds. ``node`` is the node that the block
starts from, named by its smallest member, so a further block only meets conversations
that agree on everything before it. Blocks follow as long as two different
conversations share a node; the turns that only one conversation has left are a plain chain
and become nodes directly, whatever their number.

Sums over subtrees are ROLLUP sums as well: leaves are childless nodes, each the end of one
distinct sequence, so a node's leaves are the ones among its members. The saving of a
node, (members - 1) * bytes of its last turn, is credited to its smallest member; a subtree's sum
is what its members hold in credits, without those that its smallest member earned above it (a running
sum along that one conversation).

Equal conversations are collapsed first (an order-proof digest of the turns, added up in
partial aggregates) and counted with their number. Turns are numbered by
``global_rank``, so a conversation that holds a third of all rows is cut into many
ranges. Two steps stream one conversation or one group of equal conversations through a task, in bounded memory: the
running sum along a shared chain, and the digest of the ids that end in a node (SHA-256 is sequential; ids only).

Defined results: rows are ordered by turn (null first), ties by the digest of role and text;
null role or text is empty; repeated rows are turns of their own; rows without a conv_id belong to no
conversation; an empty table gives an empty result (no root); other columns aren't read."""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..operators.globalorder import global_rank
from .common import map_arrow, materialize, table

BLOCK = 8                 # positional columns of one ROLLUP
GROUP = 5                 # conversations that share an opening in the derived corpus
T, Y = [f"t{k}" for k in range(BLOCK)], [f"y{k}" for k in range(BLOCK)]
NODE = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
        "ends_sha256 string")
NO_IDS = hashlib.sha256(b"").hexdigest()


def turn_digest(role: Column, text: Column) -> Column:
    return F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)))


def numbered_turns(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) -> conv_id, pos (1, 2, ..), id, bytes of the text, n (turns of the conversation)."""
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    light = rows.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        turn_digest(role, text).alias("id"), F.octet_length(text).cast("long").alias("bytes"))
    ranked = global_rank(light, [F.col("conv_id").asc(), F.col("turn").asc_nulls_first(), F.col("id").asc()], "at")
    start = ranked.groupBy("conv_id").agg((F.min("at") - 1).alias("before"), F.count(F.lit(1)).alias("n"))
    return ranked.join(start, "conv_id").select("conv_id", (F.col("at") - F.col("before")).alias("pos"), "id", "bytes", "n")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The derived corpus: conversation c begins with the first h turns of
    c - c % 5 (h = crc32 of its number, mod 9) and goes on with its own after its first
    h. -> (conv_id, pos, id, bytes), (conv_id) of every conversation."""
    convs = turns.where("pos = 1").select(
        "conv_id", "n", (F.col("conv_id") - F.col("conv_id") % GROUP).alias("base"), F.pmod(F.crc32(F.col("conv_id").cast("string")), F.lit(9)).alias("h"))
    lengths = convs.select(F.col("conv_id").alias("base"), F.col("n").alias("n_base"))
    convs = materialize(convs.join(lengths, "base", "left").withColumn("taken", F.least("h", F.coalesce("n_base", F.lit(0)))), "trie-convs")
    opening = turns.where("pos <= 8").select(F.col("conv_id").alias("base"), "pos", "id", "bytes")
    heads = convs.select("conv_id", "base", "taken").join(opening, "base").where("pos <= taken").select("conv_id", "pos", "id", "bytes")
    own = turns.drop("n").join(convs.select("conv_id", "h", "taken"), "conv_id").where("pos > h") \
        .select("conv_id", (F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), "id", "bytes")
    return materialize(heads.unionByName(own), "trie-turns"), convs.select("conv_id")


def _path(depth: Column | None = None) -> Column:
    """Key of a prefix inside a block: of the first ``depth`` columns, or of all that aren't null."""
    parts = [F.hex(t) if depth is None else F.when(depth > k, F.hex(t)) for k, t in enumerate(T)]
    return F.md5(F.concat_ws("|", F.col("node").cast("string"), *parts))


def _rolled(block: DataFrame, sums: str) -> DataFrame:
    """All prefixes of a block: node, t0.., depth (inside the block), conv_id (smallest member) and ``sums``."""
    grouped = block.sparkSession.sql(
        f"SELECT node, {', '.join(T)}, grouping_id() AS gid, min(conv_id) AS conv_id, {sums} FROM {{block}} "
        f"GROUP BY node, ROLLUP({', '.join(T)})", block=block)
    # one bit per column that is rolled up; a prefix ends with a turn, not behind the end of the members
    depth = BLOCK - F.bit_count(F.col("gid"))
    return grouped.withColumn("depth", depth).where(F.get(F.array(*T), F.col("depth") - 1).isNotNull()).drop("gid")


def _id_digests(batches):
    """(rep, conv_id), sorted -> (rep, SHA-256 of the ids, comma-joined)."""
    last, digest, reps, out = None, None, [], []
    for b in batches:
        for rep, conv in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            if digest is None or rep != last:
                if digest is not None:
                    reps.append(last), out.append(digest.hexdigest())
                last, digest = rep, hashlib.sha256(str(conv).encode())
            else:
                digest.update(b",%d" % conv)
        yield pa.RecordBatch.from_arrays([pa.array(reps, pa.int64()), pa.array(out, pa.string())], ["rep", "ends_sha256"])
        reps, out = [], []
    if digest is not None:
        yield pa.RecordBatch.from_arrays([pa.array([last], pa.int64()), pa.array([digest.hexdigest()], pa.string())], ["rep", "ends_sha256"])


def distinct_sequences(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """rep (smallest conversation of the sequence), len, m (how many have it), ends_sha256."""
    word = lambda k: F.coalesce(F.bit_xor(F.xxhash64(F.lit(k), "pos", "id")), F.lit(0))
    digests = turns.groupBy("conv_id").agg(word(1).alias("x1"), word(2).alias("x2"), F.count(F.lit(1)).alias("len"))
    digests = materialize(convs.join(digests, "conv_id", "left").select("conv_id", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("x1", "x2", "len")]), "trie-digests")
    key = ["len", "x1", "x2"]
    reps = materialize(digests.groupBy(*key).agg(F.min("conv_id").alias("rep"), F.count(F.lit(1)).alias("m")), "trie-reps")
    many = digests.join(reps.where("m > 1"), key).select("rep", "conv_id")
    hashed = map_arrow(many.repartition("rep").sortWithinPartitions("rep", "conv_id"), _id_digests, "rep long, ends_sha256 string")
    return materialize(reps.join(hashed, "rep", "left").select(
        "rep", "len", "m", F.coalesce("ends_sha256", F.sha2(F.col("rep").cast("string"), 256)).alias("ends_sha256")), "trie-sequences")


def trie(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """turns(conv_id, pos, id, bytes), convs(conv_id) -> one row per node: conv_id
    (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    sequences = distinct_sequences(turns, convs)
    root = sequences.agg(F.min("rep").alias("conv_id"), F.sum("m").alias("n_convs")).first()      # one row
    if root["conv_id"] is None:
        return turns.sparkSession.createDataFrame([], NODE)
    own = turns.join(sequences.select(F.col("rep").alias("conv_id"), "len", "m"), "conv_id")
    slot = (F.col("pos") - 1) % BLOCK
    wide = materialize(own.groupBy("conv_id", "len", "m", F.expr(f"(pos - 1) div {BLOCK}").alias("block")).agg(
        *[F.max(F.when(slot == k, F.col("id"))).alias(T[k]) for k in range(BLOCK)],
        *[F.max(F.when(slot == k, F.col("bytes"))).alias(Y[k]) for k in range(BLOCK)]), "trie-blocks")

    long = lambda v: F.lit(v).cast("long")
    active = sequences.where("len > 0").select(F.col("rep").alias("conv_id"), long(root["conv_id"]).alias("node"))
    blocks, nodes, ends, tails, number = [], [], [], [], 0
    while not active.isEmpty():
        base = number * BLOCK
        block = materialize(wide.where(F.col("block") == number).join(active, "conv_id"), "trie-block")
        found = _rolled(block, "sum(m) AS n_convs, " + ", ".join(f"max({y}) AS {y}" for y in Y))
        found = materialize(found.select(
            _path().alias("path"), _path(F.col("depth") - 1).alias("above"), "node", "conv_id", "depth", "n_convs",
            F.get(F.array(*Y), F.col("depth") - 1).alias("bytes")), "trie-found")
        parents = found.select(F.col("path").alias("above"), F.col("conv_id").alias("parent"))
        nodes.append(materialize(found.join(parents, "above", "left").select(
            (F.col("depth") + long(base)).alias("depth"), "conv_id", F.when(F.col("depth") == 1, F.col("node")).otherwise(F.col("parent")).alias("parent_conv_id"),
            "n_convs", "bytes"), "trie-nodes"))
        # where each conversation stands at the end of the block: in the node of all its columns
        at = materialize(block.select("conv_id", "len", _path().alias("path")).join(
            found.select("path", F.col("conv_id").alias("node")), "path").select("conv_id", "len", "node"), "trie-at")
        ends.append(at.where(F.col("len") <= base + BLOCK).select(F.col("conv_id").alias("rep"), F.col("len").alias("depth"), F.col("node").alias("conv_id")))
        blocks.append(block)
        on = at.where(F.col("len") > base + BLOCK)
        alone = on.groupBy("node").agg(F.count(F.lit(1)).alias("c")).where("c = 1").select("node")
        tails.append(on.join(alone, "node", "left_semi").select("conv_id", F.lit(base + BLOCK).cast("long").alias("from"), "node"))
        active = materialize(on.join(alone, "node", "left_anti").select("conv_id", "node"), "trie-active")
        number += 1
    if not blocks:            # every conversation is turnless
        return sequences.select(long(root["conv_id"]).alias("conv_id"), long(0).alias("depth"), long(None).alias("parent_conv_id"), long(root["n_convs"]).alias("n_convs"),
                                long(0).alias("n_children"), long(1).alias("n_leaves"), long(0).alias("saved_tokens"), "ends_sha256")

    shared, tail = materialize(_union(nodes), "trie-shared"), materialize(_union(tails), "trie-tails")
    # chains: the turns of one sequence alone
    chain = materialize(own.join(tail, "conv_id").where(F.col("pos") > F.col("from")).select(
        F.col("pos").alias("depth"), "conv_id", F.when(F.col("pos") == F.col("from") + 1, F.col("node")).otherwise(F.col("conv_id")).alias("parent_conv_id"),
        F.col("m").alias("n_convs"), "bytes", (F.col("pos") < F.col("len")).cast("long").alias("n_children"),
        (F.col("pos") == F.col("from") + 1).alias("first")), "trie-chains")
    ended = _union([*ends, tail.join(sequences.select(F.col("rep").alias("conv_id"), "len"), "conv_id").select(
        F.col("conv_id").alias("rep"), F.col("len").alias("depth"), "conv_id")])
    ended = ended.join(sequences.select("rep", "ends_sha256"), "rep")

    # children; a chain's first node is a child of a shared one
    children = materialize(shared.select("depth", "parent_conv_id").union(chain.where("first").select("depth", "parent_conv_id"))
                           .groupBy((F.col("depth") - 1).alias("depth"), F.col("parent_conv_id").alias("conv_id")).agg(F.count(F.lit(1)).alias("n_children")), "trie-children")
    shared = materialize(shared.join(children, ["depth", "conv_id"], "left").fillna(0, ["n_children"]), "trie-shared")

    # credits per sequence: whether it ends in a leaf, and the savings of the nodes it is the smallest member of
    value = (F.col("n_convs") - 1) * F.col("bytes")
    leaf = ended.join(shared.where("n_children > 0").select("depth", "conv_id"), ["depth", "conv_id"], "left_anti").select(F.col("rep").alias("conv_id"), F.lit(1).alias("leaf"))
    earned = shared.select("conv_id", value.alias("v")).union(chain.where("n_convs > 1").select("conv_id", value)).groupBy("conv_id").agg(F.sum("v").alias("credit"))
    credits = materialize(sequences.select(F.col("rep").alias("conv_id"), "len").join(leaf, "conv_id", "left").join(earned, "conv_id", "left")
                          .select("conv_id", "len", F.coalesce("leaf", F.lit(0)).alias("leaf"), F.coalesce("credit", F.lit(0)).alias("credit")), "trie-credits")
    sums = _union([_rolled(block.drop("len").join(credits.drop("len"), "conv_id"), "sum(leaf) AS n_leaves, sum(credit) AS total").select(
        (F.col("depth") + long(k * BLOCK)).alias("depth"), "conv_id", "n_leaves", "total") for k, block in enumerate(blocks)])
    along = Window.partitionBy("conv_id").orderBy("depth")
    earlier = F.coalesce(F.sum("v").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # a chain of several equal conversations: what follows in it; its own credits before it stand in shared nodes
    many = chain.where("n_convs > 1")
    upward = Window.partitionBy("conv_id").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    chain = chain.where("n_convs = 1").withColumn("saved_tokens", F.lit(0).cast("long")).unionByName(
        many.withColumn("saved_tokens", F.sum(value).over(upward)))
    before = shared.select("*", value.alias("v")).select("*", earlier.alias("earlier"))
    inner = before.join(sums, ["depth", "conv_id"]).select(
        "depth", "conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves", (F.col("total") - F.col("earlier")).alias("saved_tokens"))
    whole = credits.agg(F.sum("leaf").alias("n_leaves"), F.sum("credit").alias("saved_tokens"))
    openings = children.where("depth = 0").agg(F.coalesce(F.sum("n_children"), long(0))).first()[0]
    top = whole.select(long(0).alias("depth"), long(root["conv_id"]).alias("conv_id"), long(None).alias("parent_conv_id"), long(root["n_convs"]).alias("n_convs"),
                       long(openings).alias("n_children"), "n_leaves", "saved_tokens")
    every = _union([top, inner, chain.select("depth", "conv_id", "parent_conv_id", "n_convs", "n_children", long(1).alias("n_leaves"), "saved_tokens")])
    # sequences that end in a node; the textless one ends in the root
    ended = ended.select("depth", "conv_id", "ends_sha256").union(
        sequences.where("len = 0").select(long(0), long(root["conv_id"]), "ends_sha256"))
    return every.join(ended, ["depth", "conv_id"], "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(NO_IDS)).alias("ends_sha256"))


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns, convs = rebuilt(materialize(numbered_turns(table(spark, sf_dir, "conversations")), "trie-numbered"))
    return trie(turns, convs)
