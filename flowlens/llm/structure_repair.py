"""Repair of conversation structure over a suffix-shared automaton.

A conversation should read ``(system? (user assistant)+)?``. Rows may be kept (0),
given the role user or assistant (Rerole, 3), deleted (4; the only way for blank rows
and duplicates), and empty user or assistant rows may be inserted anywhere (3); a truncated
row that stays costs 3 more. The audit is the initials (K, R, D, I) of the cheapest edits, ties
to the ASCII-least one.

Method. A conversation is reduced to its *signature*: one character per row for role
initial and fault (must go; or s, u, a, other, in capitals if truncated). Signatures of all conversations
are made distinct, range partitioned and sorted by their reverse, and each task runs through its range with a stack:
signatures that follow each other share their longest common suffix, which is one path of the automaton
minimised from the end, and only the rows in front of it become new nodes. A node
holds, for every grammar state (nothing yet, after system, after user, after assistant), the cost to go
and the best audit suffix, stored as its first edit and a link to the rest. In a
state each edit leads to one next state, so the cheapest suffix is found by comparing costs, ties by the first edit alone. The
work is done once per node and state, whatever the number of conversations that
go through it. A stack is as deep as one signature is long.

Rows equal in conversation, turn, role and text are counted in partial aggregates and carried as
one row with their number. Conversations are read as streams: hash partitioned by conversation,
sorted (Spark spills), one Arrow batch at a time, once for signatures and once to write the repaired text; a task
holds of a conversation one character per row (the audit is a column of the result) and running digests.

Defined results: null role or text is one space (a null turn too in the damage's hash);
rows are ordered by turn (null first), ties by role, then text; a null conv_id is a
conversation of its own; an empty table gives an empty result; other columns aren't read."""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import map_arrow, materialize, table

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 3, 4, 3, 3
START, SYSTEM, USER, ASSISTANT = range(4)          # grammar states
WANTS = (("user", "u", USER), ("user", "u", USER), ("assistant", "a", ASSISTANT), ("user", "u", USER))
GONE = "d"                                         # blank or duplicate: must go
_INK = re.compile(r"[^\x20\x09-\x0D]")
_SPACE = "\x20\x09\x0a\x0b\x0c\x0d"
BUFFER = 512


class Node:
    """Per grammar state the cost to go, the first edit and where it leads: (node, state)."""
    __slots__ = ("cost", "edit", "link")

    def __init__(self):
        self.cost, self.edit, self.link = [0] * 4, [""] * 4, [None] * 4

    def _insertions(self, best: list) -> None:
        """best: (cost, edit, link) per state without an insertion first. An
        insertion leads to the wanted role's state; two of them in a row lead back."""
        after = list(best)
        for state in (USER, ASSISTANT, START, SYSTEM):
            to = WANTS[state][2]
            onward = best[to] if state in (USER, ASSISTANT) else after[to]
            after[state] = min(best[state], (onward[0] + INSERT_COST, INSERT, (self, to)), key=lambda x: x[:2])
        for state, (cost, edit, link) in enumerate(after):
            self.cost[state], self.edit[state], self.link[state] = cost, edit, link


def last_node() -> Node:
    """The end of every conversation: nothing at all, or after an assistant."""
    node, never = Node(), 1 << 60
    node._insertions([(0, "", None), (never, "", None), (never, "", None), (0, "", None)])
    return node


def node_before(symbol: str, follows: Node) -> Node:
    """The node of a row with ``symbol`` in front of ``follows``."""
    best = []
    for state, (_, initial, to) in enumerate(WANTS):
        ways = [(follows.cost[state] + DELETE_COST, DELETE, (follows, state))]
        if symbol != GONE:
            role, more = symbol.lower(), TRUNCATED_COST if symbol.isupper() else 0
            if role == initial:
                ways.append((follows.cost[to] + more, KEEP, (follows, to)))
            elif role == "s" and state == START:
                ways.append((follows.cost[SYSTEM] + more, KEEP, (follows, SYSTEM)))
            ways.append((follows.cost[to] + more + REROLE_COST, REROLE, (follows, to)))
        best.append(min(ways, key=lambda x: x[:2]))
    node = Node()
    node._insertions(best)
    return node


def audit_of(node: Node) -> str:
    out, state = [], START
    while node.edit[state]:
        out.append(node.edit[state])
        node, state = node.link[state]
    return "".join(out)


class Automaton:
    """Runs through signatures whose reverses are sorted; ``made`` counts nodes."""

    def __init__(self):
        self.stack, self.before, self.made = [last_node()], "", 1

    def solve(self, signature: str) -> tuple[int, str]:
        """(cost, audit)"""
        reverse, shared = signature[::-1], 0
        for x, y in zip(reverse, self.before):
            if x != y:
                break
            shared += 1
        del self.stack[shared + 1:]
        for symbol in reverse[shared:]:
            self.stack.append(node_before(symbol, self.stack[-1]))
            self.made += 1
        self.before = reverse
        return self.stack[-1].cost[START], audit_of(self.stack[-1])


def _solve_task(batches):
    automaton = Automaton()
    for b in batches:
        signatures = b.column(0).to_pylist()
        solved = [automaton.solve(s) for s in signatures]
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array([c for c, _ in solved], pa.int64()), pa.array([a for _, a in solved], pa.string())],
                                         ["signature", "cost", "audit"])


def damaged(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text after the damage that crc32(`conv_id:turn`) % 20 names."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.pmod(F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn"))), F.lit(20))
    return rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                       text("role").alias("role"), text("text").alias("text"), kind.alias("kind")).where("kind <> 0").select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.when(F.col("kind") == 3, 2).otherwise(1).cast("long").alias("times"))


def with_earlier(rows: DataFrame) -> DataFrame:
    """Equal rows as one (``times``), and ``seen``: an earlier turn of the
    conversation has the same role and text."""
    rows = rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("times").alias("times"))
    rows = materialize(rows.select("*", F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")).alias("said")), "repair-rows")
    at = F.struct(F.col("turn").isNotNull().alias("given"), F.col("turn"))
    again = rows.groupBy("conv_id", "said").agg(F.min(at).alias("first"), F.count(F.lit(1)).alias("c")).where("c > 1")
    again = again.select(F.col("conv_id").alias("c"), F.col("said").alias("s"), "first")
    return rows.join(again, rows.conv_id.eqNullSafe(again.c) & (rows.said == again.s), "left").select(
        "conv_id", "turn", "role", "text", "times", F.coalesce(at > F.col("first"), F.lit(False)).alias("seen"))


def _stream(rows: DataFrame) -> DataFrame:
    keys = [F.col("conv_id").asc(), F.col("part").asc(), F.col("turn").asc_nulls_first(), F.col("role").asc(), F.col("text").asc()]
    return rows.repartition("conv_id").sortWithinPartitions(*keys)


def symbol_of(role: str, text: str, seen: bool) -> tuple[str, str]:
    """(signature character, fault) of a row's first copy."""
    if not _INK.search(text):
        return GONE, "blank"
    if seen:
        return GONE, "duplicate"
    role = role[:1] if role[:1] in ("s", "u", "a") else "x"
    if text.rstrip(_SPACE)[-1] not in ".!?":
        return role.upper(), "truncated"
    return role, ""


_REPORT = pa.schema([("conv_id", pa.int64()), ("gaps", pa.int64()), ("blank", pa.int64()), ("duplicate", pa.int64()), ("truncated", pa.int64()),
                     ("illegal", pa.int64()), ("signature", pa.string())])
LEGAL = ("su", "ua", "au")


def _signatures(batches):
    current, marks, turns, first, last, before = None, [], 0, None, None, None

    def done():
        return current | {"gaps": last - first + 1 - turns if turns else 0, "signature": "".join(marks)}

    out = []
    for b in batches:
        cols = [b.column(n).to_pylist() for n in ("conv_id", "turn", "role", "text", "times", "seen")]
        for conv, turn, role, text, times, seen in zip(*cols):
            if current is None or current["conv_id"] != conv:
                if current is not None:
                    out.append(done())
                current = {"conv_id": conv, "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0}
                marks, turns, first, last, before = [], 0, None, None, None
            if turn is not None and (last is None or turn != last):
                turns, first, last = turns + 1, turn if first is None else first, turn
            mark, fault = symbol_of(role, text, seen)
            if fault:
                current[fault] += 1
            current["blank" if fault == "blank" else "duplicate"] += times - 1
            marks.append(mark + GONE * (times - 1))
            initial = role[:1]
            current["illegal"] += (before is not None and before + initial not in LEGAL) + times - 1
            before = initial
        if len(out) >= BUFFER:
            yield pa.RecordBatch.from_pylist(out, _REPORT)
            out = []
    if current is not None:
        out.append(done())
    if out:
        yield pa.RecordBatch.from_pylist(out, _REPORT)


def _repaired(batches):
    """Per conversation its audit (part 0), then its rows (part 1) -> the pieces
    of the repaired text, one per row of it."""
    audit, at, state, conv, fresh = "", 0, START, None, True
    held: list[tuple] = []

    def inserted():
        nonlocal at, state
        while at < len(audit) and audit[at] == INSERT:
            yield f"{WANTS[state][0]}:"
            state, at = WANTS[state][2], at + 1

    for b in batches:
        for c, part, role, text, times in zip(*(b.column(n).to_pylist() for n in ("conv_id", "part", "role", "text", "times"))):
            if part == 0:
                if not fresh:
                    held += [(conv, x) for x in inserted()]
                audit, at, state, conv, fresh = text, 0, START, c, False
                held.append((conv, None))
                continue
            for _ in range(times):
                held += [(conv, x) for x in inserted()]
                edit, at = audit[at], at + 1
                if edit == KEEP:
                    held.append((conv, f"{role}:{text}"))
                    state = SYSTEM if state == START and role[:1] == "s" else WANTS[state][2]
                elif edit == REROLE:
                    held.append((conv, f"{WANTS[state][0]}:{text}"))
                    state = WANTS[state][2]
        yield from held
        held = []
    if not fresh:
        yield from ((conv, x) for x in inserted())


def _texts(batches):
    """Pieces as rows (conv_id, line); the first of a conversation is null."""
    held = []
    for piece in _repaired(batches):
        held.append(piece)
        if len(held) == BUFFER:
            yield _pieces(held)
            held = []
    if held:
        yield _pieces(held)


def _pieces(held):
    return pa.RecordBatch.from_arrays([pa.array([c for c, _ in held], pa.int64()), pa.array([x for _, x in held], pa.string())], ["conv_id", "line"])


def _digests(batches):
    current, digest, empty, out = None, None, True, []
    for conv, piece in _repaired(batches):
        if piece is None:
            if digest is not None:
                out.append((current, digest.hexdigest()))
            current, digest, empty = conv, hashlib.sha256(), True
        else:
            digest.update((piece if empty else "\n" + piece).encode())
            empty = False
        if len(out) == BUFFER:
            yield _hashed(out)
            out = []
    if digest is not None:
        out.append((current, digest.hexdigest()))
    if out:
        yield _hashed(out)


def _hashed(out):
    return pa.RecordBatch.from_arrays([pa.array([c for c, _ in out], pa.int64()), pa.array([x for _, x in out], pa.string())], ["conv_id", "repaired_sha256"])


def report(rows: DataFrame) -> DataFrame:
    """rows of ``with_earlier`` -> per conversation gaps, blank, duplicate, truncated, illegal, cost, audit."""
    read = materialize(map_arrow(_stream(rows.withColumn("part", F.lit(1))), _signatures,
                                 "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, signature string"), "repair-signatures")
    backward = F.reverse("signature")
    ranges = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = read.select("signature").distinct().repartitionByRange(ranges, backward).sortWithinPartitions(backward)
    solved = map_arrow(ordered, _solve_task, "signature string, cost long, audit string")
    return materialize(read.join(solved, "signature").drop("signature"), "repair-report")


def _audited(rows: DataFrame, reports: DataFrame) -> DataFrame:
    audits = reports.select("conv_id", F.lit(0).alias("part"), F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"), F.col("audit").alias("text"),
                            F.lit(1).cast("long").alias("times"))
    return _stream(rows.select("conv_id", F.lit(1).alias("part"), "turn", "role", "text", "times").unionByName(audits))


def repaired_rows(rows: DataFrame, reports: DataFrame) -> DataFrame:
    """conv_id, line (``role:text``) of the repaired conversations, their rows following each other."""
    return map_arrow(_audited(rows, reports), _texts, "conv_id long, line string").where("line is not null")


def repair(conversations: DataFrame, rows: DataFrame) -> DataFrame:
    """One row per conversation of ``conversations``; ``rows`` (conv_id, turn,
    role, text, times) is what is to be repaired."""
    rows = materialize(with_earlier(rows), "repair-seen")
    reports = report(rows)
    digests = map_arrow(_audited(rows, reports), _digests, "conv_id long, repaired_sha256 string")
    both = reports.join(digests.withColumnRenamed("conv_id", "c"), F.col("conv_id").eqNullSafe(F.col("c"))).drop("c")
    every = conversations.select(F.col("conv_id").cast("long").alias("c")).distinct()
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    return every.join(both, F.col("c").eqNullSafe(F.col("conv_id")), "left").select(
        F.col("c").alias("conv_id"), *[zero(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))


def op13_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return repair(rows, damaged(rows))
