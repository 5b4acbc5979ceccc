"""Flattened intervals against plain BETWEEN with the narrowest range."""

import random

from pyspark.sql import functions as F

from flowlens.operators.intervals import SHIFT, RangeTable, flatten, sweep_lookup, winners


def test_winners_against_every_point():
    r = random.Random(1)
    for _ in range(100):
        ranges = []
        for k in range(r.randrange(1, 14)):
            lo = r.randrange(40)
            hi = lo + r.randrange(20)
            ranges.append((lo, hi, r.choice("ab"), (hi - lo, r.randrange(3), k)))
        found = winners(ranges)
        assert all(a[1] < b[0] for a, b in zip(found, found[1:]))
        for p in range(62):
            want = sorted(min((x[3], i) for i, x in enumerate(ranges) if x[2] == slot and x[0] <= p <= x[1])[1]
                          for slot in "ab" if any(x[2] == slot and x[0] <= p <= x[1] for x in ranges))
            got = [list(b) for lo, hi, b in found if lo <= p <= hi]
            assert got == ([want] if want else [])


def tables(spark, seed=3):
    """Nested, overlapping, wide (over many cells), equal and broken ranges."""
    r = random.Random(seed)
    cell = 1 << SHIFT
    one, two = [], []
    for k in range(120):
        lo = r.choice([r.randrange(1 << 32), 5 * cell + r.randrange(300), 7 * cell - 50 + r.randrange(100)])
        width = r.choice([0, 1, 10, 255, 256, cell - 1, cell, 3 * cell, 200 * cell])
        one.append((lo, min(lo + width, (1 << 32) - 1), r.choice([None, *range(6)])))
        two.append((lo, min(lo + width, (1 << 32) - 1), r.choice(["S3", "EC2", None]), r.choice(["r1", "r2", None])))
    one += one[:5] + [(None, 5, 1), (9, 3, 1), (-4, 8, 1), (1 << 32, 1 << 33, 1), (0, (1 << 32) - 1, 99)]
    return spark.createDataFrame(one, "lo bigint, hi bigint, g bigint"), spark.createDataFrame(two, "a bigint, b bigint, service string, region string"), one, two


def test_lookup_equals_between(spark):
    d1, d2, one, two = tables(spark)
    flat = flatten([RangeTable("geo", d1, "lo", "hi", ["g"]), RangeTable("cloud", d2, "a", "b", ["service", "region"], [F.col("service") == "S3"]),
                    RangeTable("own", d2, "a", "b", ["region"], by="service")])
    rows = sorted((x.cell, x.lo, x.hi) for x in flat.collect())
    assert all(a[2] < b[1] for a, b in zip(rows, rows[1:])) and all(lo >> SHIFT == hi >> SHIFT == c for c, lo, hi in rows)
    r = random.Random(4)
    points = [r.randrange(1 << 32) for _ in range(300)] + [x for lo, hi, *_ in two for x in (lo, hi, lo - 1, hi + 1) if 0 <= x < 1 << 32] + [None, None, 0, (1 << 32) - 1]
    df = spark.createDataFrame([(k, p) for k, p in enumerate(points)], "at int, ip bigint")          # a helper's name as a column
    got = sweep_lookup(df, "ip", flat)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Cartesian" not in plan
    none_first = lambda v: (v is not None, v)
    valid = [x for x in one if x[0] is not None and 0 <= x[0] <= x[1] < 1 << 32]
    seen = 0
    for x in got.collect():
        p = points[x["at"]]
        geo = [g for lo, hi, g in valid if p is not None and lo <= p <= hi]
        if not geo:
            assert x.geo is None
        else:
            assert x.geo.g == min((hi - lo, none_first(g)) for lo, hi, g in valid if lo <= p <= hi)[1][1]
        mine = [c for c in two if p is not None and c[0] <= p <= c[1]]
        if mine:
            best = min(mine, key=lambda c: (c[1] - c[0], none_first(None if c[2] is None else c[2] == "S3"), none_first(c[2]), none_first(c[3])))
            assert (x.cloud.service, x.cloud.region) == best[2:]
        else:
            assert x.cloud is None
        for s in ("S3", "EC2"):
            of = [c for c in mine if c[2] == s]
            own = (x.own or {}).get(s)
            assert (own.region if own else None) == (min(of, key=lambda c: (c[1] - c[0], none_first(c[3])))[3] if of else None) and bool(own) == bool(of)
        seen += 1
    assert seen == len(points)


def test_no_ranges_and_no_points(spark):
    empty = flatten([RangeTable("geo", spark.createDataFrame([], "lo bigint, hi bigint, g bigint"), "lo", "hi", ["g"])])
    points = spark.createDataFrame([(1, 5), (2, None)], "id int, ip bigint")
    assert sorted((x.id, x.geo) for x in sweep_lookup(points, "ip", empty).collect()) == [(1, None), (2, None)]
    assert sweep_lookup(points.where("id > 9"), "ip", empty).collect() == []
