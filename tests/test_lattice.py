"""Grains derived from written grains equal those computed from the facts."""

import random

import pytest
from pyspark.sql import functions as F

from flowlens.operators.lattice import Lattice
from flowlens.plans import daily
from flowlens.plans.job import daily_aggregates


def facts(spark):
    r = random.Random(2)
    data = [(r.choice(["a", "b", None]), r.randrange(4), r.choice([None, r.randrange(9)]), r.random() < 0.5, r.choice([None, r.randrange(100)])) for _ in range(2000)]
    data += [("only nulls", 1, 1, True, None)] * 3
    return spark.createDataFrame(data, "x string, y int, z int, ok boolean, v long")


def test_grains_equal_direct_aggregates(spark):
    df = facts(spark)
    lattice = Lattice(df, {k: F.col(k) for k in ("x", "y", "z", "ok")}, {"s": F.sum("v"), "n": F.count(F.lit(1))})
    lattice.keep(["x", "y", "ok"])
    for keys, only in ((["x", "y", "z"], None), (["x"], None), (["y"], "ok"), (["x", "z"], "ok"), (["x", "y", "ok"], None)):
        direct = (df.where(only) if only else df).groupBy(*keys).agg(F.sum("v").alias("s"), F.count(F.lit(1)).alias("n"))
        assert sorted(map(tuple, lattice.grain(keys, only).collect()), key=str) == sorted(map(tuple, direct.collect()), key=str)
    assert lattice.grain(["x"]).where("x = 'only nulls'").first()["s"] is None


def test_the_smallest_grain_is_read(spark):
    lattice = Lattice(facts(spark), {k: F.col(k) for k in ("x", "y", "z", "ok")}, {"n": F.count(F.lit(1))})
    small = lattice.keep(["x", "y"])
    assert lattice.parent(["x"]) is small and lattice.parent(["x", "z"]) is not small
    with pytest.raises(ValueError):
        lattice.grain(["x", "unknown"])


def test_daily_job_scans_the_flows_twice(spark, inputs, tmp_path):
    """Once for the lattice, once for the aggregate over all traffic; results equal the single queries."""
    from flowlens.plans.inputs import Inputs

    path = str(tmp_path / "flows_as_given")
    inputs.flows.write.parquet(path)
    given = Inputs.from_frames(spark, spark.read.parquet(path), inputs.dns, inputs.dims, inputs.resolved)
    out = daily_aggregates(spark, given)
    reads = {name: df._jdf.queryExecution().optimizedPlan().toString().count("Relation [") and "flows_as_given" in "".join(df.inputFiles()) for name, df in out.items()}
    assert [name for name, r in reads.items() if r] == ["vpc_action_agg"]      # the others read the written grains
    ec2, dims = inputs.dims.ec2, inputs.dims
    single = {
        "total_internet_egress": daily.total_internet_egress(inputs.flows, ec2), "internet_bound_flows": daily.internet_bound_flows(inputs.flows, ec2),
        "unique_destination": daily.unique_destination(inputs.flows, ec2), "vpc_action_agg": daily.vpc_action_agg(inputs.flows, ec2),
        "vpc_egress_trends_summary": daily.vpc_egress_trends(inputs.flows, ec2), "vpc_top_talkers_enriched": daily.vpc_top_talkers(inputs.flows, ec2),
        "vpc_top_ports_agg": daily.vpc_top_ports(inputs.flows, ec2), "destination_asn_service_agg": daily.destination_asn_service(inputs.flows, dims),
        "top_domain_port_geo": daily.top_domain_port_geo(inputs.flows, inputs.dns, dims),
        "network_intelligence_final": daily.network_intelligence_final(inputs.flows, inputs.dns, dims),
    }
    assert out.keys() == single.keys()
    for name, df in out.items():
        assert df.columns == single[name].columns
        assert sorted(map(tuple, df.collect()), key=str) == sorted(map(tuple, single[name].collect()), key=str), name
