"""Query registry: name -> callable(spark, sf_dir) -> DataFrame.

Each entry loads the inputs (fixture adapters over the driver's tables) and
runs one plan over the whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import daily, job
from ..session import materialize
from .inputs import Inputs, load

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
# the same plans as functions of ``Inputs`` (fixture or curated inputs)
PLANS: dict[str, Callable[[Inputs], DataFrame]] = {}


def register(name: str):
    def deco(fn: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
        PLANS[name] = fn
        QUERIES[name] = lambda spark, sf_dir: fn(load(spark, sf_dir))
        return fn
    return deco


register("total_internet_egress")(lambda i: daily.total_internet_egress(i.flows, i.dims.ec2))
register("internet_bound_flows")(lambda i: daily.internet_bound_flows(i.flows, i.dims.ec2))
register("unique_destination")(lambda i: daily.unique_destination(i.flows, i.dims.ec2))
register("vpc_action_agg")(lambda i: daily.vpc_action_agg(i.flows, i.dims.ec2))
register("vpc_egress_trends")(lambda i: daily.vpc_egress_trends(i.flows, i.dims.ec2))
register("vpc_top_talkers")(lambda i: daily.vpc_top_talkers(i.flows, i.dims.ec2))
register("vpc_top_ports")(lambda i: daily.vpc_top_ports(i.flows, i.dims.ec2))
register("destination_asn_service")(lambda i: daily.destination_asn_service(i.flows, i.dims))
register("top_domain_port_geo")(lambda i: daily.top_domain_port_geo(i.flows, i.dns, i.dims))
register("network_intelligence_final")(lambda i: daily.network_intelligence_final(i.flows, i.dns, i.dims))
register("network_intelligence_ranked")(lambda i: daily.by_volume(daily.network_intelligence_final(i.flows, i.dns, i.dims)))
register("daily_job_summary")(lambda i: job.daily_job_summary(i.spark, i))
register("flow_daily_summary")(lambda i: daily.flow_daily_summary(i.flows))
register("flow_bi_rollup")(lambda i: daily.flow_bi_rollup(i.flows))
register("profile_counts")(lambda i: daily.profile_counts(i.flows))
register("profile_columns")(lambda i: daily.profile_columns(i.flows))

# ---- DNS / unified ---------------------------------------------------------
from ..operators.dns import dns_daily_summary as _dns_sum, primary_domain as _primary  # noqa: E402
from . import enrichment as en, reports as rp, unified as un  # noqa: E402

register("dns_daily_summary")(lambda i: _dns_sum(i.dns))
register("dns_primary_domain")(lambda i: _primary(_dns_sum(i.dns)))
register("unified_daily")(lambda i: un.unified_daily(i.flows, i.dns))
register("unified_asof")(lambda i: un.unified_asof(i.flows, i.dns))
register("unified_asof_day")(lambda i: un.unified_asof(i.flows, i.dns, day=i.day))

# ---- joined logs family ----------------------------------------------------


def _joined(i: Inputs) -> DataFrame:
    return en.joined_logs(i.flows, i.dns, i.dims.ec2)


def _dictionary_agg(i: Inputs) -> DataFrame:
    # the joined logs feed the dictionary and the roll-up; the dictionary is a
    # table of its own: both are written once
    j = materialize(_joined(i))
    return en.asn_service_from_dictionary(j, materialize(en.ip_asn_dictionary(j, i.dims)))


register("joined_logs")(_joined)
register("top_flows_enriched")(lambda i: en.top_flows_enriched(_joined(i), i.dims, day=i.day))
register("domain_traffic_summary")(lambda i: en.domain_traffic_summary(_joined(i), i.dims, day=i.day))
register("joined_preagg_enriched")(lambda i: en.joined_preagg_enriched(_joined(i), i.dims, day=i.day))
register("asn_service_rollup")(lambda i: en.asn_service_rollup(_joined(i), i.dims))
register("ip_asn_dictionary")(lambda i: en.ip_asn_dictionary(_joined(i), i.dims))
register("asn_service_from_dictionary")(_dictionary_agg)
register("asn_service_pivot")(lambda i: en.asn_service_pivot(_dictionary_agg(i)))
register("egress_domain_country")(lambda i: en.egress_domain_country(i.flows, i.dims, i.resolved))
register("ip_metadata")(lambda i: en.ip_metadata_table(i.flows, i.dims))
register("ip_metadata_by_service")(lambda i: en.ip_metadata_table(i.flows, i.dims, by_service=True))
register("reverse_domain_labels")(
    lambda i: en.reverse_domain_labels(daily.unique_destination(i.flows, i.dims.ec2), i.resolved)
)

# ---- dashboard reports (date filter = the inputs' day) ---------------------


def _src(i: Inputs) -> DataFrame:
    return rp.report_source(i.flows)


def _date(i: Inputs) -> str | None:
    return "-".join(i.day) if i.day else None


register("report_traffic_by_hour")(lambda i: rp.report_traffic_by_hour(_src(i), date=_date(i)))
register("report_top_services")(lambda i: rp.report_top_services(_src(i), date=_date(i)))
register("report_flow_edges")(lambda i: rp.report_flow_edges(_src(i), date=_date(i)))
register("report_flow_nodes")(lambda i: rp.report_flow_nodes(rp.report_flow_edges(_src(i), date=_date(i))))
# the same reports under action, service and address filters, and the pivot under its lists of values
register("report_traffic_by_hour_filtered")(
    lambda i: rp.report_traffic_by_hour(_src(i), date=_date(i), action="ACCEPT", service="S3"))
register("report_flow_edges_filtered")(
    lambda i: rp.report_flow_edges(_src(i), date=_date(i), action="ACCEPT", service="C", ip="10.0.1.7"))
register("asn_service_pivot_filtered")(lambda i: en.asn_service_pivot(
    _dictionary_agg(i), account="000000000001", vpcs=["vpc-0", "vpc-2", "vpc-4"], regions=["us-east-1", "eu-west-1"],
    years=["2026"], months=["02"], days=["14", "15"]))
register("report_rejected")(lambda i: rp.report_rejected(_src(i), date=_date(i)))

# ---- ETL: raw -> curated round trips, database copy, file profile ----------
from . import etl  # noqa: E402
from ..session import prepare  # noqa: E402


def _file_query(fn: Callable[[SparkSession, str], DataFrame]) -> Query:
    """Queries that read or write files themselves (no ``Inputs``)."""
    return lambda spark, sf_dir: fn(prepare(spark), sf_dir)


QUERIES["ingest_flow_logs"] = _file_query(etl.flow_roundtrip)
QUERIES["ingest_dns_logs"] = _file_query(etl.dns_roundtrip)
QUERIES["ingest_listed_accounts"] = _file_query(etl.listed_accounts)
QUERIES["ingest_delivered_dns"] = _file_query(etl.delivered_dns)
QUERIES["curated_day_totals"] = _file_query(etl.curated_day_totals)
QUERIES["catalog_day_totals"] = _file_query(etl.catalog_day_totals)
QUERIES["allowed_account_totals"] = _file_query(etl.allowed_account_totals)
QUERIES["appended_batches"] = _file_query(etl.appended_batches)
QUERIES["replaced_table"] = _file_query(etl.replaced_table)
register("publish_curated")(lambda i: etl.publish_curated(i.flows))
QUERIES["profile_rows_per_file"] = _file_query(
    lambda spark, sf_dir: daily.profile_rows_per_file(spark.read.parquet(f"{sf_dir.rstrip('/')}/lineitem.parquet"))
    .select("file_name", "rows_per_file")
)
