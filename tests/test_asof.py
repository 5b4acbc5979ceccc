"""asof_dns_join against a brute-force theta join on literal rows: window
bounds (closed), latest wins, domain tie, hour boundary, empty answers."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowlens.functions.dates import iso_to_micros
from flowlens.operators.asof import asof_dns_join
from flowlens.sources.fixtures import ANSWER_TYPE

T0 = 1771113600  # 2026-02-15 00:00:00 UTC


def _iso(t):
    import datetime as dt
    when = dt.datetime.fromtimestamp(t, dt.timezone.utc)
    return when.strftime("%Y-%m-%dT%H:%M:%SZ") if t == int(t) else when.strftime("%Y-%m-%dT%H:%M:%S.%fZ")


def _data(spark):
    flows = spark.createDataFrame([
        (1, "a", "v", "c", "d", T0 + 1000, 10), (2, "a", "v", "c", "d", T0 + 1000, 20),
        (3, "a", "v", "c", "d", T0 + 3600 + 30, 5), (4, "a", "v", "c", "d", T0 + 5000, 7),
        (5, "a", "v", "c", "x", T0 + 1000, 1), (6, "a", "v", "c", "d", T0 + 1600, 2),
        (7, "a", "v", "c", "e", T0, 3), (8, "a", "v", "c", "e", T0 + 1, 4), (9, "a", "v", None, "e", T0 + 1, 5), (10, "a", "v", "c", "e", None, 6),
    ], "fid int, account_id string, vpc_id string, pkt_srcaddr string, pkt_dstaddr string, start_time bigint, bytes bigint")
    dns_rows = [
        ("a", "v", "c", _iso(T0 + 400), [("d",)], "old.example"),        # exactly 600 s before flows 1,2
        ("a", "v", "c", _iso(T0 + 900), [("d",)], "zz.example"),         # latest, ties with next
        ("a", "v", "c", _iso(T0 + 900), [("d",)], "aa.example"),
        ("a", "v", "c", _iso(T0 + 3600 - 100), [("d",)], "prevhour.example"),  # previous hour, 130 s before flow 3
        ("a", "v", "c", _iso(T0 + 1100), [], "empty.example"),
        ("a", "v", "c", _iso(T0 + 0.9), [("e",)], "subsecond.example"),          # after flow 7, before flow 8
        ("a", "v", "c", _iso(T0 + 1100), None, "null.example"),
    ]
    schema = T.StructType([
        T.StructField("account_id", T.StringType()), T.StructField("vpc_id", T.StringType()),
        T.StructField("srcaddr", T.StringType()), T.StructField("query_timestamp", T.StringType()),
        T.StructField("answers", ANSWER_TYPE), T.StructField("query_name", T.StringType()),
    ])
    return flows, spark.createDataFrame(dns_rows, schema)


def _brute(flows, dns, same_hour):
    d = dns.select("account_id", "vpc_id", F.col("srcaddr").alias("c"), F.explode("answers").alias("a"),
                   iso_to_micros("query_timestamp").alias("t"), F.col("query_name").alias("dom"))
    d = d.select("account_id", "vpc_id", "c", F.col("a.Rdata").alias("r"), "t", "dom")
    cond = ((flows.account_id == d.account_id) & (flows.vpc_id == d.vpc_id) & (flows.pkt_srcaddr == d.c)
            & (flows.pkt_dstaddr == d.r) & (d.t <= flows.start_time * 1000000) & (flows.start_time * 1000000 <= d.t + 600000000))
    if same_hour:
        cond = cond & (F.floor(d.t / 3600000000) == F.floor(flows.start_time / 3600))
    j = flows.join(d, cond, "left")
    w = Window.partitionBy("fid").orderBy(F.col("t").desc_nulls_last(), F.col("dom").asc())
    return {r.fid: r.dom for r in j.withColumn("rn", F.row_number().over(w)).where("rn = 1").collect()}


@pytest.mark.parametrize("same_hour", [True, False])
def test_asof_equals_brute_force(spark, same_hour):
    flows, dns = _data(spark)
    got = asof_dns_join(flows, dns, same_hour=same_hour)
    assert got.count() == flows.count()          # every flow kept, none duplicated
    result = {r.fid: r.domain for r in got.collect()}
    assert result == _brute(flows, dns, same_hour)
    assert result[1] == result[2] == "aa.example"
    assert result[3] == (None if same_hour else "prevhour.example")
    assert result[7] is None and result[8] == "subsecond.example" and result[9] is None and result[10] is None
    assert result[6] is None                     # 700 s after the last answer


def test_asof_plan_is_equi_join(spark):
    flows, dns = _data(spark)
    plan = asof_dns_join(flows, dns)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
