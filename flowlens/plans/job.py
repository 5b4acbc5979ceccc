"""The daily job: ten aggregates for one day, written to partitioned
Parquet (or a database through ``write_jdbc``).

The flows are scanned twice in all: once for the aggregate over all traffic, once for
the nine over egress records, whose grains come from one lattice (``daily.egress_lattice``).
Further shared intermediates -- the day's primary DNS domain per client/address and
the destination metadata (country, ASN, cloud range) -- are computed once, too, and
cut from the lineage as Parquet tables written under the cluster's
``spark.checkpoint.dir`` (``session.materialize``), so a lost executor re-reads
them instead of recomputing the range joins, and every aggregate that needs
them reads the same files.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.filters import on_day
from ..operators.dns import dns_daily_summary, primary_domain
from ..session import drop_scratch, materialize, scratch_mark
from ..sinks.writers import write_partitioned
from . import daily
from .inputs import Inputs
from .ipmeta import ip_metadata

OUTPUT_KEYS = ["account_id", "region", "year", "month", "day"]


def daily_aggregates(spark: SparkSession, inputs: Inputs, day: tuple[str, str, str] | None = None,
                     mode: str = "literal") -> dict[str, DataFrame]:
    flows = inputs.flows.where(on_day(*day)) if day else inputs.flows
    dns = inputs.dns.where(on_day(*day)) if day else inputs.dns
    dims, ec2 = inputs.dims, inputs.dims.ec2
    lattice = daily.egress_lattice(flows, mode)
    pre = {name: daily.lattice_grain(lattice, name) for name in daily.GRAINS}
    domains = materialize(primary_domain(dns_daily_summary(dns)))
    meta = materialize(ip_metadata(
        lattice.grain(["dstaddr", "pkt_dst_aws_service"]), dims, keys=("dstaddr", "pkt_dst_aws_service"), service_matched=True))
    return {
        "total_internet_egress": daily.total_internet_egress(flows, ec2, mode, pre=pre["total_internet_egress"]),
        "internet_bound_flows": daily.internet_bound_flows(flows, ec2, mode, pre=pre["internet_bound_flows"]),
        "unique_destination": daily.unique_destination(flows, ec2, mode, pre=pre["unique_destination"]),
        "vpc_action_agg": daily.vpc_action_agg(flows, ec2),
        "vpc_egress_trends_summary": daily.vpc_egress_trends(flows, ec2, mode, pre=pre["vpc_egress_trends"]),
        "vpc_top_talkers_enriched": daily.vpc_top_talkers(flows, ec2, mode, pre=pre["vpc_top_talkers"]),
        "vpc_top_ports_agg": daily.vpc_top_ports(flows, ec2, mode, pre=pre["vpc_top_ports"]),
        "destination_asn_service_agg": daily.destination_asn_service(
            flows, dims, mode, meta=meta, pre=pre["destination_asn_service"]),
        "top_domain_port_geo": daily.top_domain_port_geo(
            flows, dns, dims, mode, domains=domains, meta=meta, pre=pre["top_domain_port_geo"]),
        "network_intelligence_final": daily.network_intelligence_final(
            flows, dns, dims, mode, domains=domains, meta=meta, pre=pre["network_intelligence_final"]),
    }


def daily_job_summary(spark: SparkSession, inputs: Inputs) -> DataFrame:
    """aggregate, rows: how many rows the job makes of each of its ten tables."""
    parts = [df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("aggregate"), "n_rows")
             for name, df in daily_aggregates(spark, inputs).items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def run_daily_job(spark: SparkSession, inputs: Inputs, out_root: str, day: tuple[str, str, str] | None = None,
                  writer: Callable[[DataFrame, str], None] | None = None) -> dict[str, str]:
    """Compute and write the ten aggregates; returns name -> output path.
    Re-running a day overwrites only that day's partitions. The job's scratch
    tables are deleted once every output is written."""
    mark = scratch_mark()
    outputs = {}
    try:
        for name, df in daily_aggregates(spark, inputs, day).items():
            path = f"{out_root.rstrip('/')}/{name}"
            if writer is None:
                write_partitioned(df, path, OUTPUT_KEYS)
            else:
                writer(df, path)
            outputs[name] = path
    finally:
        drop_scratch(spark, mark)
    return outputs
