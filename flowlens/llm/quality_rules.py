"""Quality rules with risk-controlled thresholds (DataFrame functions only).

Per document, word and line statistics are computed inside the row. Each rule
maps one statistic to a *badness* of 0..1000 and rejects from a cutoff on. The
cutoffs are not set by hand: for every stratum (``lang``) and rule, the good
documents of the labelled holdout are counted by badness -- one trial per distinct text,
however many copies or rows of one id there are, since copies aren't independent --
and a cutoff may be used only if the exact binomial test rejects "the rule refuses more than
``alpha`` of the stratum's good documents" at level
``delta / (number of strata * number of rules)``. That test is the exact
(Clopper-Pearson) upper bound, read the other way round: the bound is at most
``alpha`` iff P[Bin(n, alpha) <= k] <= level. Along one rule the cutoffs are
tested from the mildest to the strictest and the sequence stops at the first
failure (fixed-sequence testing: no further correction inside a rule); across
rules and strata the level is divided (Bonferroni). So with probability at
least ``1 - delta`` no rule refuses more than ``alpha`` of the good documents
of any stratum, hence all rules together at most ``rules * alpha``. Among the
certified cutoffs the one with the largest net benefit is taken (bad documents
refused minus ``good_weight`` times good ones); a rule that finds nothing bad
gets no cutoff.

Defined results: a null text has no words, lines or symbols and fails the base
rule; a null ``lang`` is a stratum of its own; a stratum without labels gets no
cutoffs (only the base rule rejects there); repeated documents keep their rows;
repeated labels of a document count as the largest; equal texts count as their
smallest labelled id; an empty table gives an empty result. Other columns of the
inputs are not read; ``keep_good`` passes columns of any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..functions.names import quoted
from .common import labelled, materialize, table

ALPHA = 0.02          # false rejection allowed per rule and stratum
DELTA = 0.05          # chance that any stratum breaks its limit
GOOD_WEIGHT = 4.0     # one good document refused costs this many bad ones caught
SPACE = r"[\x20\x09-\x0D]+"


def word_statistics(docs: DataFrame, carry: bool = False) -> DataFrame:
    """docs(doc_id, text, ...) -> doc_id, lang, n_words, word_chars, n_symbols,
    n_lines, n_dup_lines, n_repeat_words, text_md5; with ``carry`` also the whole
    row of docs as the struct ``whole_row``. One pass, no shuffle.

    Repeated 5-word windows are found on 64-bit hashes of the windows: equal
    windows always meet, different ones collide with a chance below n^2 / 2^64
    within a text."""
    text = F.coalesce("text", F.lit(""))
    lang = F.col("lang") if "lang" in docs.columns else F.lit(None).cast("string")
    kept = ["whole_row"] if carry else []
    d = docs.select(*[F.struct(*map(quoted, docs.columns)).alias(c) for c in kept], F.col("doc_id").cast("long").alias("doc_id"),
                    lang.cast("string").alias("lang"), text.alias("text"))
    kept = [*kept, "text_md5"]
    d = d.select(
        *kept[:-1], F.md5("text").alias("text_md5"), "doc_id", "lang",
        F.array_remove(F.split("text", SPACE), "").alias("words"),
        F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
        (F.length("text") - F.length(F.regexp_replace("text", r"[#*$%&|<>]+", ""))).alias("n_symbols"))
    # window i covers words i..i+4 (0-based); texts of under five words have none
    hashes = F.when(F.size("words") >= 5, F.transform(
        F.sequence(F.lit(0), F.size("words") - 5),
        lambda i: F.xxhash64(*[F.get(F.col("words"), i + k) for k in range(5)])))
    d = d.select(
        *kept, "doc_id", "lang", "n_symbols",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(hashes, F.array().cast("array<bigint>")).alias("h"))
    # sorted (hash, place) pairs, only for texts in which a window comes twice
    pairs = F.when(F.size(F.array_distinct("h")) < F.size("h"),
                   F.array_sort(F.transform("h", lambda x, i: F.struct(x.alias("x"), i.alias("i")))))
    d = d.select(*[c for c in d.columns if c != "h"], pairs.alias("p"))
    n = F.size("p")
    # both neighbours come in by shifted copies: the lambdas read their own element only
    again = F.when(F.col("p").isNotNull(), F.filter(
        F.arrays_zip(F.col("p").alias("a"),
                     F.concat(F.array(F.lit(None).cast("struct<x:bigint,i:int>")), F.slice("p", 1, F.greatest(n - 1, F.lit(0)))).alias("b"),
                     F.slice("p", 2, F.greatest(n, F.lit(1))).alias("c")),
        lambda e: F.coalesce(e["a"]["x"] == e["b"]["x"], F.lit(False)) | F.coalesce(e["a"]["x"] == e["c"]["x"], F.lit(False))))
    places = F.sort_array(F.transform(again, lambda e: e["a"]["i"]))
    d = d.select(*[c for c in d.columns if c != "p"], places.alias("at"))
    # each repeated window covers five words, or up to the next repeated window
    gaps = F.zip_with(F.slice("at", 2, F.greatest(F.size("at"), F.lit(1))), F.col("at"),
                      lambda nxt, here: F.coalesce(F.least(nxt - here, F.lit(5)), F.lit(5)).cast("long"))
    covered = F.when(F.col("at").isNotNull(), F.aggregate(gaps, F.lit(0).cast("long"), lambda s, g: s + g))
    # always true, but not deterministic: without it the optimizer moves filters on the result below these
    # projections, which repeats the nested expressions many times over
    covered = F.when(F.spark_partition_id() >= 0, covered)
    return d.select(*kept, "doc_id", "lang", "n_words", "word_chars", F.col("n_symbols").cast("long").alias("n_symbols"),
                    "n_lines", "n_dup_lines", F.coalesce(covered, F.lit(0).cast("long")).alias("n_repeat_words"))


def _permille(part: Column, whole: Column) -> Column:
    return F.least(F.lit(1000), F.floor(1000 * part / F.greatest(whole, F.lit(1)))).cast("int")


# rule -> badness of 0..1000 over the columns of word_statistics
RULES = {
    "symbols": lambda: _permille(F.col("n_symbols"), F.col("word_chars")),
    "dup_lines": lambda: _permille(F.col("n_dup_lines"), F.col("n_lines")),
    "repeats": lambda: _permille(F.col("n_repeat_words"), F.col("n_words")),
    "long_words": lambda: _permille(F.col("word_chars"), 40 * F.col("n_words")),
    "short_words": lambda: 1000 - _permille(F.col("word_chars"), 10 * F.col("n_words")),
}


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def binomial_below(k: Column, n: Column, p: float) -> Column:
    """P[Bin(n, p) <= k], exactly by the recurrence of the probabilities, in
    logarithms so that a large n doesn't underflow."""
    odds = F.log(F.lit(p / (1 - p)))
    start = F.struct((n * F.log(F.lit(1 - p))).alias("t"), (n * F.log(F.lit(1 - p))).alias("s"))

    def step(acc, i):
        t = acc["t"] + F.log((n - i + 1) / i) + odds
        top = F.greatest(acc["s"], t)
        return F.struct(t.alias("t"), (top + F.log(F.exp(acc["s"] - top) + F.exp(t - top))).alias("s"))

    terms = F.when(k >= 1, F.sequence(F.lit(1).cast("long"), k)).otherwise(F.array().cast("array<bigint>"))
    return F.aggregate(terms, start, step, lambda acc: F.least(F.lit(1.0), F.exp(acc["s"])))


def select_cutoffs(statistics: DataFrame, quality: DataFrame, alpha: float = ALPHA, delta: float = DELTA,
                   good_weight: float = GOOD_WEIGHT) -> DataFrame:
    """(lang, rule, cutoff): refuse from ``cutoff`` on. ``quality`` holds
    (doc_id, quality 1 good / 0 bad). At most strata * rules rows."""
    held = statistics.where(~base_failed()).join(quality, "doc_id")
    bins = F.struct("lang", *[b().alias(r) for r, b in RULES.items()])
    # independent trials: of an id one text (smallest digest), of a text one id (the smallest)
    by_id = held.groupBy("doc_id", "quality").agg(F.min(F.struct("text_md5", bins.alias("bins"))).alias("own"))
    trials = by_id.groupBy("own.text_md5").agg(F.min(F.struct("doc_id", "quality", "own.bins")).alias("first")).select("first.quality", "first.bins.*")
    bad = F.col("quality") == 0
    long = trials.select("lang", bad.alias("bad"), F.explode(F.map_from_arrays(
        F.array(*[F.lit(r) for r in RULES]), F.array(*RULES))).alias("rule", "bin"))
    counts = materialize(long.groupBy("lang", "rule", "bin").agg(
        F.count_if(~F.col("bad")).alias("good"), F.count_if("bad").alias("bad")), "quality-counts")
    # one row per stratum, rule and occurring badness (1001 at most): small windows
    at_least = Window.partitionBy("lang", "rule").orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy("lang", "rule")
    sums = counts.select("lang", "rule", "bin", F.sum("good").over(at_least).alias("good_refused"),
                         F.sum("bad").over(at_least).alias("bad_refused"), F.sum("good").over(whole).alias("n_good"))
    # tests in one family: every stratum seen times every rule
    strata = max(1, counts.select("lang").distinct().count())
    level = delta / (strata * len(RULES))
    # past this many refused the test can't pass (the bound then exceeds alpha): spares the long sums
    hopeless = F.col("good_refused") > F.col("n_good") * alpha
    tested = sums.select(
        "*", (F.when(hopeless, F.lit(1.0)).otherwise(binomial_below(
            F.when(hopeless, F.lit(0).cast("long")).otherwise(F.col("good_refused")), F.col("n_good"), alpha)) <= level).alias("passes"))
    unbroken = F.min(F.col("passes").cast("int")).over(at_least) == 1   # fixed sequence, mildest first
    benefit = F.col("bad_refused") - good_weight * F.col("good_refused")
    best = tested.select("*", unbroken.alias("certified"), benefit.alias("benefit")).where("certified and benefit > 0 and bin > 0")
    return best.groupBy("lang", "rule").agg(F.max(F.struct("benefit", "bin"))["bin"].alias("cutoff"))


def apply_cutoffs(statistics: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """Adds base_failed, refused_by (comma-joined rules) and kept. The cutoff
    table has one row per stratum with one column per rule."""
    wide = cutoffs.groupBy("lang").agg(*[
        F.max(F.when(F.col("rule") == r, F.col("cutoff"))).alias(f"cut_{r}") for r in RULES]).withColumnRenamed("lang", "stratum")
    wide = materialize(wide, "quality-cutoffs")      # its real size then decides the join
    joined = statistics.join(wide, F.col("lang").eqNullSafe(F.col("stratum")), "left")
    hits = F.concat_ws(",", *[F.when(b() >= F.col(f"cut_{r}"), F.lit(r)) for r, b in RULES.items()])
    return (joined.select(*statistics.columns, base_failed().alias("base_failed"), hits.alias("refused_by"))
            .withColumn("kept", ~F.col("base_failed") & (F.col("refused_by") == "")))


def quality_rules(docs: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """Statistics, verdict and reasons per document. The statistics are
    written once: the fit and the verdict both read them."""
    statistics = materialize(word_statistics(docs), "quality-statistics")
    return apply_cutoffs(statistics, select_cutoffs(statistics, labelled(labels, "quality"), alpha, delta))


def keep_good(docs: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """The rows of ``docs`` that are kept, unchanged. The small statistics are
    written for the fit; the verdict recomputes them beside the texts, so no text
    is shuffled."""
    statistics = materialize(word_statistics(docs), "quality-statistics")
    cutoffs = select_cutoffs(statistics, labelled(labels, "quality"), alpha, delta)
    return apply_cutoffs(word_statistics(docs, carry=True), cutoffs).where("kept").select("whole_row.*")


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "refused_by")
