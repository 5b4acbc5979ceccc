import hashlib
import itertools
import random
import re
import zlib

import pytest

from flowlens.llm import structure_repair as R

ROWS = "conv_id long, turn long, role string, text string, part int, seen string, cost int"


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 2) for r in rows], ROWS)


def brute_damage(rows):
    out = []
    for c, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind:
            out += [(c, turn, "user" if kind == 4 else role, "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text)] * (2 if kind == 3 else 1)
    return out


def brute(rows):
    """All edit scripts by dynamic programming over (row, text so far's state), with whole audits compared."""
    damaged, out = brute_damage(rows), []
    for c in {r[0] for r in rows}:
        own = sorted((r[1:] for r in damaged if r[0] == c), key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        faults, seen = [], set()
        for _, role, text in own:
            ink = text.rstrip(" \t\n\x0b\x0c\r")
            blank = not text.strip(" \t\n\x0b\x0c\r")
            faults.append("blank" if blank else "duplicate" if (role, text) in seen else "truncated" if ink[-1] not in ".!?" else "")
            seen.add((role, text))
        turns = [r[0] for r in own if r[0] is not None]
        pairs = [a[1][:1] + b[1][:1] for a, b in itertools.pairwise(own)]
        # best[state]: (cost, audit, lines); states: "", "s", "u", "a"
        best = {"": (0, "", ())}

        def inserted(best):
            for _ in range(3):
                for s, (cost, audit, lines) in list(best.items()):
                    to, name = ("a", "assistant") if s == "u" else ("u", "user")
                    new = (cost + 3, audit + "I", (*lines, f"{name}:"))
                    best[to] = min(best.get(to, new), new, key=lambda x: x[:2])
            return best
        for (_, role, text), fault in zip(own, faults):
            after = {}

            def reach(state, value):
                after[state] = min(after.get(state, value), value, key=lambda x: x[:2])
            for s, (cost, audit, lines) in inserted(best).items():
                reach(s, (cost + 4, audit + "D", lines))
                if fault in ("blank", "duplicate"):
                    continue
                more = 3 if fault == "truncated" else 0
                to, name = ("a", "assistant") if s == "u" else ("u", "user")
                if role[:1] == to or (role[:1] == "s" and s == ""):
                    reach(role[:1], (cost + more, audit + "K", (*lines, f"{role}:{text}")))
                reach(to, (cost + more + 3, audit + "R", (*lines, f"{name}:{text}")))
            best = after
        ends = inserted(best)
        cost, audit, lines = min((ends[s] for s in ("", "a") if s in ends), key=lambda x: x[:2])
        out.append((c, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"),
                    sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=str)


def result(spark, rows):
    given = table(spark, rows)
    return sorted((tuple(r) for r in R.repair(given, R.damaged(given)).collect()), key=str)


def corpus(n=150, seed=5):
    r = random.Random(seed)
    rows = []
    for c in range(n):
        for k in range(r.randrange(1, 14)):
            rows.append((c, None if r.random() < 0.03 else k + (k > 5), r.choice(["user", "assistant"] * 3 + ["system", "tool", None]),
                         r.choice([None, "", "   ", "Fine.", "Fine!", "cut off", f"own {c} {k}.", f"own {k}?  ", "é 日本"])))
    return rows


def test_against_brute_force(spark):
    rows = corpus()
    assert result(spark, rows) == brute(rows)


@pytest.mark.parametrize("rows", [
    [(None, 1, "user", "A."), (None, 2, "assistant", "B."), (2, None, None, None), (3, 1, "", "x."), (3, 1, "", "x."), (3, 1, "", "x.")],
    [(1, k, "user" if k % 2 else "assistant", "w " * 3000 + f"{k}.") for k in range(300)],
    [(c, k, "user", "same.") for c in range(8) for k in range(5)],
    [(1, 2, "user", "tie."), (1, 2, "assistant", "tie."), (1, 2, "system", "tie")],
])
def test_odd_rows(spark, rows):
    assert result(spark, rows) == brute(rows)


def test_empty_table(spark):
    assert result(spark, []) == []


def test_every_short_signature_has_the_cheapest_least_audit():
    """The automaton against all edit scripts, and its sharing."""
    signatures = sorted(("".join(s) for n in range(5) for s in itertools.product("suaxSUAXd", repeat=n)), key=lambda s: s[::-1])
    automaton = R.Automaton()
    solved = {s: automaton.solve(s) for s in signatures}
    assert automaton.made == len(signatures)              # one node per distinct suffix
    grammar = re.compile(r"(s?(ua)+)?")

    def scripts(signature):
        """(cost, audit) of every script with up to three insertions at a place."""
        todo = [(0, "", "", 0)]
        inserts = ["", "u", "a", "ua", "au", "uau", "aua"]
        for symbol in signature:
            nxt = []
            for cost, audit, roles, _ in todo:
                for ins in inserts:
                    c, a, r = cost + 3 * len(ins), audit + "I" * len(ins), roles + ins
                    nxt.append((c + 4, a + "D", r, 0))
                    if symbol != "d":
                        more = 3 if symbol.isupper() else 0
                        nxt.append((c + more, a + "K", r + symbol.lower(), 0))
                        nxt += [(c + more + 3, a + "R", r + x, 0) for x in "ua"]
            todo = [t for t in nxt if t[0] <= 30 and re.fullmatch(r"s?(ua)*u?|s?(ua)*", t[2])]
        for cost, audit, roles, _ in todo:
            for ins in inserts:
                if grammar.fullmatch(roles + ins):
                    yield cost + 3 * len(ins), audit + "I" * len(ins)
    r = random.Random(1)
    for s in [x for x in signatures if len(x) <= 2] + r.sample([x for x in signatures if len(x) == 3], 40):
        assert solved[s] == min(scripts(s)), s


def test_signatures_come_once_per_suffix():
    automaton = R.Automaton()
    for s in sorted(["sua", "ua", "uua", "xua", "a", "ua"], key=lambda s: s[::-1]):
        automaton.solve(s)
    assert automaton.made == 1 + 5        # the end, a, ua, sua, uua, xua


def test_repaired_rows(spark):
    given = table(spark, [(1, 0, "user", "A."), (1, 1, "user", "B."), (2, 0, "assistant", "C.")])
    rows = R.with_earlier(given.selectExpr("conv_id", "turn", "role", "text", "1L as times"))
    reports = R.report(rows)
    lines = [tuple(r) for r in R.repaired_rows(rows, reports).collect()]
    audits = {r.conv_id: r.audit for r in reports.collect()}
    assert audits == {1: "KR", 2: "IK"}
    assert sorted(lines) == sorted([(1, "user:A."), (1, "assistant:B."), (2, "user:"), (2, "assistant:C.")])
