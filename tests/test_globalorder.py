"""Consecutive global ranks without a one-task window."""

import random

from pyspark.sql import functions as F

from flowlens.functions.names import quoted, unused
from flowlens.operators.globalorder import global_rank


def rows(n=3000):
    r = random.Random(1)
    return [(r.choice([None, *range(50)]), r.random() if k % 7 else None, f"k{k}") for k in range(n)]


def test_rank_equals_a_sort(spark):
    data = rows()
    df = spark.createDataFrame(data, "a int, b double, c string").repartition(5)
    got = global_rank(df, [F.col("a").desc_nulls_last(), F.col("b").asc_nulls_first(), F.col("c").asc()], "place")
    assert got.columns == ["a", "b", "c", "place"]
    key = lambda r: (r[0] is None, -(r[0] or 0), r[1] is not None, r[1] or 0, r[2])
    assert [tuple(r)[:3] for r in sorted(got.collect(), key=lambda r: r.place)] == sorted(data, key=key)
    assert sorted(r.place for r in got.collect()) == list(range(1, len(data) + 1))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "SinglePartition" not in plan


def test_ties_repeated_rows_and_helper_names(spark):
    df = spark.createDataFrame([(1, 2, 3, "x")] * 40 + [(0, 2, 3, "y")], "place int, part int, before int, `a.b` string")
    got = global_rank(df, [F.col("place").asc()])
    assert sorted(r["rank"] for r in got.collect()) == list(range(1, 42)) and got.where("rank = 1").first()["a.b"] == "y"
    assert got.columns == ["place", "part", "before", "a.b", "rank"]


def test_empty(spark):
    assert global_rank(spark.createDataFrame([], "a int"), [F.col("a").asc()]).collect() == []


def test_many_ranges_are_used(spark):
    """A table with one hot key beside the order's first column spreads by the further columns."""
    df = spark.range(20_000).select(F.lit("hot").alias("k"), "id")
    got = global_rank(df, [F.col("k").asc(), F.col("id").asc()])
    assert got.where("rank <> id + 1").isEmpty()
    sizes = [r["count"] for r in got.groupBy(F.col("_metadata.file_path")).count().collect()] if "_metadata" in got.columns else []
    assert not sizes or max(sizes) < 20_000


def test_names():
    assert unused(["A", "_a", "b"], "a", "b", "c", "a") == ["__a", "_b", "c", "___a"]
    assert quoted("a.`b") == "`a.``b`"
