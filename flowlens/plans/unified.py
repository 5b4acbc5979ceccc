"""Flow x DNS: the daily summary join and the as-of (time-window) join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.filters import connection_start, is_egress, on_day, status_ok
from ..operators.asof import asof_dns_join
from ..operators.dns import dns_daily_summary, primary_domain, with_primary_domain
from .daily import DAY, flow_daily_summary

UNIFIED_COLUMNS = [
    "account_id", "region", "vpc_id", "instance_id", "client_ip", "destination_ip", "domain",
    "pkt_dst_aws_service", "traffic_path", "total_bytes", "total_packets", *DAY,
]


def unified_daily(flows: DataFrame, dns: DataFrame, mode: str = "literal") -> DataFrame:
    """Flow daily summary with the day's primary domain per (client, resolved
    address). The primary domain is unique per join key, so the summary grain
    is kept and the reference's re-aggregation is an identity (not run)."""
    summary = flow_daily_summary(flows, mode)
    domains = primary_domain(dns_daily_summary(dns))
    j = with_primary_domain(summary, domains)
    return j.select(
        "account_id", "region", "vpc_id", "instance_id", F.col("srcaddr").alias("client_ip"),
        F.col("dstaddr").alias("destination_ip"), "domain", "pkt_dst_aws_service", "traffic_path",
        "total_bytes", "total_packets", *DAY,
    )


def unified_asof(flows: DataFrame, dns: DataFrame, day: tuple[str, str, str] | None = None,
                 tolerance_s: int = 600, same_hour: bool = True) -> DataFrame:
    """Egress connection-start records (OK status) with the latest DNS answer
    seen in the ``tolerance_s`` seconds before the flow started, summed per
    instance x client x destination x domain. Every flow is kept: the match is
    resolved per flow, so two flows that differ only in ports keep their bytes.

    Flows are first summed per (grain, start second): the domain depends only
    on (account, vpc, client, destination, start), so this pre-aggregation
    shrinks the join input without changing the result.
    """
    f = flows.where(is_egress() & status_ok() & connection_start())
    d = dns
    if day is not None:
        f = f.where(on_day(*day))
        d = d.where(on_day(*day))
    pre = f.groupBy(
        "account_id", "region", "vpc_id", "instance_id", "pkt_srcaddr", "pkt_dstaddr",
        "pkt_dst_aws_service", "traffic_path", *DAY, "start_time",
    ).agg(F.sum("bytes").alias("_b"), F.sum("packets").alias("_p"))
    j = asof_dns_join(pre, d, src="pkt_srcaddr", dst="pkt_dstaddr", start="start_time",
                      tolerance_s=tolerance_s, same_hour=same_hour)
    return j.groupBy(
        "account_id", "region", "vpc_id", "instance_id", F.col("pkt_srcaddr").alias("client_ip"),
        F.col("pkt_dstaddr").alias("destination_ip"), "domain", "pkt_dst_aws_service", "traffic_path", *DAY,
    ).agg(F.sum("_b").alias("total_bytes"), F.sum("_p").alias("total_packets")).select(*UNIFIED_COLUMNS)
