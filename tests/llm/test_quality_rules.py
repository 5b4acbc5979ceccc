import math
import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from flowlens.llm import quality_rules as Q
from flowlens.llm.common import labelled

from .helpers import documents, labels, odd_rows

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    at = defaultdict(list)
    for k in range(len(words) - 4):
        at[tuple(words[k:k + 5])].append(k)
    covered = {j for places in at.values() if len(places) > 1 for k in places for j in range(k, k + 5)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


def texts():
    r = random.Random(2)
    out = ["a b c d e a b c d e", "a a a a a a a", "x\nx\n x\nx\n\n\n", "a b c d e f a b c d e g a b c d e", "## $$ <|> é&é", "one two three four five", "\x0b\x0c\x1c\x85  w", "w v w v"]
    for _ in range(60):
        out.append(" ".join(r.choices("a b c d e f g h".split(), k=r.randrange(60))) + r.choice(["", "\n", " "]))
    return out


def test_statistics(spark):
    rows = odd_rows([(100 + k, t) for k, t in enumerate(texts())])
    got = Q.word_statistics(documents(spark, rows)).collect()
    assert len(got) == len(rows)
    want = defaultdict(list)
    for i, t in rows:
        want[i].append(brute(t))
    for r in got:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) in want[r.doc_id], r


def binomial(k, n, p):
    return sum(math.comb(n, i) * p ** i * (1 - p) ** (n - i) for i in range(k + 1))


def test_binomial(spark):
    cases = [(0, 1), (0, 500), (3, 500), (10, 10), (7, 40), (30, 2000), (0, 0)]
    df = spark.createDataFrame(cases, "k long, n long").select("k", "n", Q.binomial_below(F.col("k"), F.col("n"), 0.02).alias("p"))
    for r in df.collect():
        assert r.p == pytest.approx(binomial(r.k, r.n, 0.02), rel=1e-9)


def holdout(spark):
    r = random.Random(1)
    rows, marks = [], []
    for k in range(900):
        bad = k % 6 == 0
        words = ["".join(r.choices("abcdefghij", k=r.randrange(2, 9))) + ("###" if bad else "") for _ in range(30)]
        rows.append((k, " ".join(words)))
        marks.append((k, 0 if bad else 1, 0))
    return rows, marks


def test_cutoffs_keep_their_promise(spark):
    rows, marks = holdout(spark)
    stats = Q.word_statistics(documents(spark, rows)).cache()
    cut = {r.rule: r.cutoff for r in Q.select_cutoffs(stats, labelled(labels(spark, marks), "quality")).collect()}
    assert "symbols" in cut
    quality = {k: q for k, q, _ in marks}
    bins = {r["doc_id"]: r for r in stats.select("doc_id", Q.base_failed().alias("f"), *[b().alias(n) for n, b in Q.RULES.items()]).collect()}
    good = [b for b in bins.values() if quality[b["doc_id"]] == 1 and not b["f"]]
    level = Q.DELTA / len(Q.RULES)
    for rule, at in cut.items():
        assert binomial(sum(b[rule] >= at for b in good), len(good), Q.ALPHA) <= level
    got = Q.quality_rules(documents(spark, rows), labels(spark, marks)).collect()
    assert all(r.kept == (r.doc_id % 6 != 0) for r in got)


def test_few_labels_certify_nothing(spark):
    rows, marks = holdout(spark)
    got = Q.quality_rules(documents(spark, rows), labels(spark, marks[:200])).collect()
    assert all(r.kept for r in got) and len(got) == len(rows)


def test_odd_rows(spark):
    rows = odd_rows()
    got = Q.quality_rules(documents(spark, rows), labels(spark, [(1, None, None), (None, 1, 0), (4, 0, 0), (4, 1, 0)])).collect()
    assert len(got) == len(rows) and {r.doc_id for r in got if r.kept} == {5}
    kept = Q.keep_good(documents(spark, rows), labels(spark, []))
    assert kept.columns == documents(spark, rows).columns and [r.doc_id for r in kept.collect()] == [5]
    assert Q.quality_rules(documents(spark, []), labels(spark, [])).collect() == []


def test_plan_has_no_python(spark):
    plan = Q.quality_rules(documents(spark, odd_rows()[:3]), labels(spark, [(1, 1, 0)]))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)


def test_copies_are_one_trial(spark):
    """One labelled id or one text, however often repeated, certifies nothing."""
    bad = [(1000 + k, "###".join("abcdefgh") + " " + " ".join(f"bad{k}x{j}###" for j in range(20))) for k in range(30)]
    marks = [(1000 + k, 0, 0) for k in range(30)] + [(5, 1, 0)] + [(2000 + k, 1, 0) for k in range(400)]
    fine = " ".join(f"word{j}" for j in range(40))
    same_id = [(5, fine + f" {k}") for k in range(400)]
    same_text = [(2000 + k, fine) for k in range(400)]
    quality = labelled(labels(spark, marks), "quality")
    for good in (same_id, same_text, same_id + same_text):
        stats = Q.word_statistics(documents(spark, good + bad))
        assert Q.select_cutoffs(stats, quality).collect() == []
    different = [(2000 + k, " ".join(f"word{j}and{k}" for j in range(40))) for k in range(400)]
    assert Q.select_cutoffs(Q.word_statistics(documents(spark, different + bad)), quality).collect() != []


def test_columns_of_any_name_stay(spark):
    docs = documents(spark, odd_rows()).selectExpr("*", "1 as `a.b`", "2 as whole_row", "3 as text_md5", "4 as n_words")
    kept = Q.keep_good(docs, labels(spark, []))
    assert kept.columns == docs.columns and [r.doc_id for r in kept.collect()] == [5]
