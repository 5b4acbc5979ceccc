"""range_join equals a brute-force BETWEEN join (narrowest match), including
ranges wider than a /8, overlapping ranges, the service-matched form and
addresses that cannot be parsed."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from flowlens.operators.rangejoin import range_join


def _fixture(spark):
    ranges = spark.createDataFrame([
        (167772160, 184549375, "A", "S3"),          # 10.0.0.0/8
        (167772160, 167837695, "B", "S3"),          # 10.0.0.0/16 inside A (narrower)
        (16777216, 1073741823, "WIDE", "EC2"),      # 1.0.0.0 - 63.255.255.255 (wider than /8)
        (3232235776, 3232235776, "ONE", "S3"),      # a single address
        (3232235776, 3232236031, "ONE24", "EC2"),   # /24 holding it, other service
    ], "lo bigint, hi bigint, name string, service string")
    pts = spark.createDataFrame([
        (1, 167772161, "S3"), (2, 167900000, "S3"), (3, 33554432, "EC2"), (4, 3232235776, "S3"),
        (5, 3232235776, "EC2"), (6, None, "S3"), (7, 4000000000, "S3"), (8, 1073741823, None),
        (9, 167772161, "S3"),
    ], "id int, ip bigint, svc string")
    return pts, ranges


def _brute(pts, ranges, service: bool):
    cond = pts.ip.between(ranges.lo, ranges.hi)
    if service:
        cond = cond & (pts.svc == ranges.service)
    j = pts.join(ranges, cond, "left")
    w = Window.partitionBy("id").orderBy((F.col("hi") - F.col("lo")).asc_nulls_last(), F.col("name"))
    return {r.id: r.name for r in j.withColumn("rn", F.row_number().over(w)).where("rn = 1").collect()}


def test_most_specific_equals_between(spark):
    pts, ranges = _fixture(spark)
    for service in (False, True):
        equi = [("svc", "service")] if service else []
        got = range_join(pts, ranges, "ip", "lo", "hi", ["name"], equi=equi, order=[F.col("name")])
        assert {r.id: r.name for r in got.collect()} == _brute(pts, ranges, service)


def test_all_matches_and_no_nested_loop(spark):
    pts, ranges = _fixture(spark)
    got = range_join(pts, ranges, "ip", "lo", "hi", ["name"], resolve="all")
    brute = pts.join(ranges, pts.ip.between(ranges.lo, ranges.hi), "left").select("id", "name")
    assert sorted(map(tuple, got.select("id", "name").collect()), key=str) == \
        sorted(map(tuple, brute.collect()), key=str)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_forced_sort_merge_path(spark):
    pts, ranges = _fixture(spark)
    got = range_join(pts, ranges, "ip", "lo", "hi", ["name"], broadcast_max_bytes=-1)
    assert {r.id: r.name for r in got.collect()} == _brute(pts, ranges, False)


def test_rewritten_range_table(spark, tmp_path):
    """The same path first holds disjoint, then overlapping ranges."""
    pts = spark.createDataFrame([(1, 5), (2, 70_000), (3, 99)], "id int, ip bigint")
    path = str(tmp_path / "ranges")
    for rows in ([(0, 10, "a"), (60_000, 80_000, "b")], [(0, 1000, "wide"), (0, 10, "a"), (60_000, 80_000, "b"), (65_000, 75_000, "c")]):
        spark.createDataFrame(rows, "lo bigint, hi bigint, name string").write.mode("overwrite").parquet(path)
        ranges = spark.read.parquet(path)
        got = range_join(pts, ranges, "ip", "lo", "hi", ["name"], order=[F.col("name")])
        assert sorted((r.id, r.name) for r in got.collect()) == sorted(_brute(pts, ranges, False).items())


def test_broadcast_bound_counts_payload_bytes(spark):
    from flowlens.operators.rangejoin import ROW_BYTES, exploded_bytes
    rng = spark.createDataFrame([(0, 3 * 65536, "x" * 100)], "_lo bigint, _hi bigint, _pl0 string")
    assert exploded_bytes(rng, ["_pl0"]) == 4 * (ROW_BYTES + 100)


def test_ipv6_and_bad_ranges_are_ignored(spark):
    from decimal import Decimal
    pts = spark.createDataFrame([(1, 167772161)], "id int, ip bigint")
    ranges = spark.createDataFrame([
        (Decimal(167772160), Decimal(184549375), "v4"),
        (Decimal(2**100), Decimal(2**100 + 10), "v6"),
        (Decimal(-5), Decimal(3), "neg"),
        (Decimal(20), Decimal(10), "reversed"),
    ], "lo decimal(38,0), hi decimal(38,0), name string")
    got = range_join(pts, ranges, "ip", "lo", "hi", ["name"])
    assert [r.name for r in got.collect()] == ["v4"]


def test_points_distinct_shares_the_key_set(spark):
    pts, ranges = _fixture(spark)
    keyed = pts.groupBy("ip").agg({"id": "min"})            # one row per address
    a = range_join(keyed, ranges, "ip", "lo", "hi", ["name"], points_distinct=True)
    b = range_join(keyed, ranges, "ip", "lo", "hi", ["name"])
    assert sorted(map(tuple, a.collect()), key=str) == sorted(map(tuple, b.collect()), key=str)
