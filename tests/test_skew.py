"""A third of all flows on one destination / one VPC: results stay whole and
equal to brute force (no capping, no sampling, bytes conserved)."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from flowlens.functions.ipmath import ip_to_int
from flowlens.operators.rangejoin import range_join
from flowlens.plans import daily, enrichment as en

HOT_IP = "45.10.0.1"


def _skewed(flows):
    hot = F.pmod(F.xxhash64("srcport", "start_time", "dstaddr"), F.lit(3)) == 0
    return flows.withColumn("dstaddr", F.when(hot, F.lit(HOT_IP)).otherwise(F.col("dstaddr"))) \
        .withColumn("vpc_id", F.when(hot, F.lit("vpc-hot")).otherwise(F.col("vpc_id")))


def test_hot_destination_range_join_equals_brute_force(inputs):
    flows = _skewed(inputs.flows).withColumn("ip", ip_to_int("dstaddr"))
    hot_rows = flows.where(F.col("dstaddr") == HOT_IP).count()
    assert hot_rows * 4 > flows.count()
    asn = inputs.dims.geo_asn
    got = range_join(flows, asn, "ip", "network_start_integer", "network_end_integer",
                     ["autonomous_system_organization"])
    assert got.count() == flows.count()
    brute = flows.join(asn, flows.ip.between(asn.network_start_integer, asn.network_end_integer), "left")
    g = got.groupBy("autonomous_system_organization").agg(F.sum("bytes").alias("b"))
    b = brute.groupBy("autonomous_system_organization").agg(F.sum("bytes").alias("b"))
    assert sorted(map(tuple, g.collect()), key=str) == sorted(map(tuple, b.collect()), key=str)


def test_hot_vpc_aggregates_conserve_bytes(inputs):
    flows = _skewed(inputs.flows)
    egress_bytes = daily.egress(flows).agg(F.sum("bytes")).first()[0]
    asn = daily.destination_asn_service(flows, inputs.dims)
    assert asn.agg(F.sum("total_bytes")).first()[0] == egress_bytes
    final = daily.network_intelligence_final(flows, inputs.dns, inputs.dims)
    summary = daily.flow_daily_summary(flows)
    assert final.count() == summary.count()


def test_hot_group_top_n_is_exact(inputs):
    flows = _skewed(inputs.flows)
    joined = en.joined_logs(flows, inputs.dns, inputs.dims.ec2)
    top = en.top_flows_enriched(joined, inputs.dims, n=5)
    hot = top.where(F.col("vpc_id") == "vpc-hot").groupBy("account_id", "region").count().collect()
    assert hot and all(r["count"] == 5 for r in hot)
    # the 5 survivors of each hot group are exactly the 5 largest
    ref = joined.where(F.col("instance_id").isNotNull() & (F.col("vpc_id") == "vpc-hot"))
    w = Window.partitionBy("account_id", "region").orderBy(F.col("total_bytes").desc_nulls_last())
    expected = ref.withColumn("r", F.row_number().over(w)).where("r <= 5").agg(F.sum("total_bytes")).first()[0]
    assert top.where(F.col("vpc_id") == "vpc-hot").agg(F.sum("total_bytes")).first()[0] == expected
