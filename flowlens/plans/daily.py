"""The ten daily aggregates and the shared daily summaries.

Every aggregate filters first (pushed to the scan), aggregates on its own
grain with partial (map-side) aggregation, and only then joins look-ups that
hold one row per key -- so a join never changes the grain and never
multiplies bytes.

``GRAINS`` names the keys of each aggregate over egress records. Alone, an
aggregate computes its grain from the flows; the daily job hands it over as ``pre``
(``_b`` bytes, ``_p`` packets, ``_n`` records), from one lattice for all.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import labels as L
from ..functions.dates import hour_bucket, log_date
from ..functions.filters import public_egress, status_ok
from ..functions.ipmath import ip_to_int
from ..functions.names import quoted
from ..operators.dns import dns_daily_summary, primary_domain, with_primary_domain
from ..operators.lattice import Lattice
from ..operators.lookups import with_account, with_owner_labels
from ..operators.globalorder import global_rank
from ..operators.topn import tie_breakers, top_n_per_group
from ..session import materialize
from .ipmeta import ip_metadata, join_metadata, with_asn, with_cloud

DAY = ["year", "month", "day"]
VPC = ["account_id", "region", "vpc_id"]


# keys of the aggregates over egress records, besides the day
GRAINS = {
    "total_internet_egress": VPC,
    "internet_bound_flows": VPC,
    "unique_destination": [*VPC, "dstaddr"],
    "vpc_egress_trends": [*VPC, "time_hour", "flow_direction"],
    "vpc_top_talkers": [*VPC, "instance_id", "dstaddr", "flow_direction"],
    "vpc_top_ports": [*VPC, "dstport", "instance_id", "dstaddr"],
    "destination_asn_service": [*VPC, "dstaddr", "pkt_dst_aws_service"],
    "top_domain_port_geo": [*VPC, "srcaddr", "dstaddr", "dstport", "pkt_dst_aws_service"],
    "network_intelligence_final": [*VPC, "instance_id", "srcaddr", "dstaddr", "pkt_dst_aws_service", "traffic_path"],
}
STATUS_OK_ONLY = ("top_domain_port_geo", "network_intelligence_final")


def key_column(name: str) -> F.Column:
    """The expression of a grain's key over the flows."""
    if name == "time_hour":
        return hour_bucket("start_time")
    return F.coalesce(status_ok(), F.lit(False)) if name == "status_ok" else F.col(name)


def measures() -> dict[str, F.Column]:
    return {"_b": F.sum("bytes"), "_p": F.sum("packets"), "_n": F.count(F.lit(1))}


def egress_grain(flows: DataFrame, aggregate: str, mode: str = "literal") -> DataFrame:
    """The grain of ``aggregate`` computed from the flows."""
    rows = egress(flows, mode)
    if aggregate in STATUS_OK_ONLY:
        rows = rows.where(status_ok())
    return rows.groupBy(*[key_column(k).alias(k) for k in GRAINS[aggregate]], *DAY).agg(*[e.alias(n) for n, e in measures().items()])


def egress_lattice(flows: DataFrame, mode: str = "literal") -> Lattice:
    """One scan of the egress records for all of ``GRAINS``: the finest grain,
    the one without hours, and the one without sources."""
    connections = [*VPC, "instance_id", "srcaddr", "dstaddr", "dstport", "pkt_dst_aws_service", "traffic_path", "flow_direction", "status_ok", *DAY]
    finest = [*connections, "time_hour"]
    lattice = Lattice(egress(flows, mode), {k: key_column(k) for k in finest}, measures())
    lattice.keep(connections)
    lattice.keep([*VPC, "instance_id", "dstaddr", "dstport", "pkt_dst_aws_service", "flow_direction", *DAY])
    return lattice


def lattice_grain(lattice: Lattice, aggregate: str) -> DataFrame:
    return lattice.grain([*GRAINS[aggregate], *DAY], "status_ok" if aggregate in STATUS_OK_ONLY else None)


def _ld() -> F.Column:
    return log_date().alias("log_date")


def egress(flows: DataFrame, mode: str = "literal") -> DataFrame:
    """Egress records to public destinations (the base of AGG 1-3, 5-10)."""
    return flows.where(public_egress(mode))


def total_internet_egress(flows: DataFrame, ec2: DataFrame, mode: str = "literal", pre: DataFrame | None = None) -> DataFrame:
    agg = egress_grain(flows, "total_internet_egress", mode) if pre is None else pre
    return with_account(agg, ec2).select(
        "account_name", *VPC, L.gb("_b", 6).alias("total_gb"), *DAY, _ld()
    )


def internet_bound_flows(flows: DataFrame, ec2: DataFrame, mode: str = "literal", pre: DataFrame | None = None) -> DataFrame:
    agg = egress_grain(flows, "internet_bound_flows", mode) if pre is None else pre
    return with_account(agg, ec2).select("account_name", *VPC, F.col("_n").alias("total_connections"), *DAY, _ld())


def unique_destination(flows: DataFrame, ec2: DataFrame, mode: str = "literal", pre: DataFrame | None = None) -> DataFrame:
    agg = egress_grain(flows, "unique_destination", mode) if pre is None else pre
    return with_account(agg, ec2).select(
        "account_name", *VPC, F.col("dstaddr").alias("destination_ip"), F.col("_b").alias("total_bytes"),
        F.col("_n").alias("connection_count"), *DAY, _ld()
    )


def vpc_action_agg(flows: DataFrame, ec2: DataFrame) -> DataFrame:
    """All traffic (no direction or destination filter) per action x direction."""
    agg = flows.groupBy(*VPC, "action", "flow_direction", *DAY).agg(
        F.sum("bytes").alias("_b"), F.sum("packets").alias("total_packets"),
        F.count(F.lit(1)).alias("record_count"),
    )
    return with_account(agg, ec2).select(
        "account_name", *VPC, "action", "flow_direction", L.gb("_b", 4).alias("total_gb"),
        "total_packets", "record_count", *DAY, _ld(),
    )


def vpc_egress_trends(flows: DataFrame, ec2: DataFrame, mode: str = "literal", pre: DataFrame | None = None) -> DataFrame:
    agg = egress_grain(flows, "vpc_egress_trends", mode) if pre is None else pre
    return with_account(agg, ec2).select(
        "account_name", *VPC, "time_hour", "flow_direction", L.mb("_b", 2).alias("traffic_mb"), *DAY, _ld()
    )


def vpc_top_talkers(flows: DataFrame, ec2: DataFrame, mode: str = "literal", fallback_by=("account_id", "region"),
                    pre: DataFrame | None = None) -> DataFrame:
    """Per instance x destination, labelled by instance, else account(+region).
    GB is rounded once from summed bytes (the reference sums rounded values)."""
    agg = egress_grain(flows, "vpc_top_talkers", mode) if pre is None else pre
    return with_owner_labels(agg, ec2, fallback_by).select(
        "account_name", "biz_unit", "application_id", *VPC, "instance_id", "dstaddr", "flow_direction",
        L.gb("_b", 4).alias("total_data_out_gb"), F.col("_p").alias("total_packets"), F.col("_n").alias("record_count"), *DAY, _ld(),
    )


def vpc_top_ports(flows: DataFrame, ec2: DataFrame, mode: str = "literal", pre: DataFrame | None = None) -> DataFrame:
    """Top instance+destination per (vpc, port, day) by bytes; ties by
    instance_id, dstaddr ascending."""
    agg = (egress_grain(flows, "vpc_top_ports", mode) if pre is None else pre).withColumnRenamed("_b", "total_bytes")
    top = top_n_per_group(
        agg, [*VPC, "dstport", *DAY],
        [F.col("total_bytes").desc_nulls_last(), F.col("instance_id").asc_nulls_last(),
         F.col("dstaddr").asc_nulls_last()],
        1,
    )
    return with_account(top, ec2).select(
        "account_name", *VPC, L.port_label("dstport").alias("destination_port"), "instance_id", "dstaddr",
        L.gb("total_bytes", 4).alias("data_out_gb"), *DAY, _ld(),
    )


def destination_asn_service(flows: DataFrame, dims, mode: str = "literal", service_from: str = "packet",
                            meta: DataFrame | None = None, pre: DataFrame | None = None) -> DataFrame:
    """Bytes per destination ASN x service label.

    ``service_from='packet'`` (default): the flow's packet-level service, empty
    -> NON-AWS. The reference also joined the (overlapping) cloud ranges
    without using them, multiplying bytes; that join contributes no column and
    is left out. ``service_from='range'``: the service of the narrowest cloud
    range holding the address (the other variant of the reference)."""
    pre = egress_grain(flows, "destination_asn_service", mode) if pre is None else pre
    if meta is not None and service_from == "packet":
        # the job's written address dictionary already holds the organisation
        asn = meta.groupBy("dstaddr").agg(F.max("asn_org").alias("asn_org"))
    else:
        dst = materialize(pre.select("dstaddr").distinct().withColumn("dst_ip_int", ip_to_int("dstaddr")))
        asn = with_asn(dst, dims)
    if service_from == "range":
        asn = with_cloud(asn, dims)
        label = L.final_service("cloud_service")
    elif service_from == "packet":
        asn = asn.withColumn("cloud_service", F.lit(None).cast("string"))
        label = L.service_label("pkt_dst_aws_service")
    else:
        raise ValueError(f"unknown service_from {service_from!r}")
    enriched = pre.join(asn.select("dstaddr", "asn_org", "cloud_service"), "dstaddr", "left")
    agg = enriched.groupBy(
        *VPC, F.coalesce("asn_org", F.lit(L.UNKNOWN)).alias("asn_org"), label.alias("service_label"), *DAY,
    ).agg(F.sum("_b").alias("total_bytes"), F.sum("_n").alias("flow_count"))
    return with_account(agg, dims.ec2).select(
        "account_name", *VPC, "asn_org", "service_label", "total_bytes",
        L.gb("total_bytes", 6).alias("total_gb"), "flow_count", *DAY, _ld(),
    )


def flow_daily_summary(flows: DataFrame, mode: str = "literal", pre: DataFrame | None = None) -> DataFrame:
    """Egress, public, log_status OK, per instance x src x dst x service x path."""
    agg = egress_grain(flows, "network_intelligence_final", mode) if pre is None else pre
    return agg.select(*GRAINS["network_intelligence_final"], *DAY, F.col("_b").alias("total_bytes"), F.col("_p").alias("total_packets"))


def top_domain_port_geo(flows: DataFrame, dns: DataFrame, dims, mode: str = "literal",
                        domains: DataFrame | None = None, meta: DataFrame | None = None,
                        pre: DataFrame | None = None) -> DataFrame:
    """``domains`` / ``meta`` may be passed precomputed (shared by several
    aggregates in the daily job); ``meta`` must be keyed by
    (dstaddr, pkt_dst_aws_service) and cover the egress destinations."""
    base = egress_grain(flows, "top_domain_port_geo", mode) if pre is None else pre
    domains = primary_domain(dns_daily_summary(dns)) if domains is None else domains
    if meta is None:
        meta = ip_metadata(base, dims, keys=("dstaddr", "pkt_dst_aws_service"), service_matched=True)
    j = with_primary_domain(base, domains)
    j = join_metadata(j, meta, ["dstaddr", "pkt_dst_aws_service"])
    agg = j.groupBy(
        *VPC, F.coalesce("domain", F.lit(L.UNKNOWN)).alias("domain"), "dstport",
        F.col("dstaddr").alias("destination_ip"), "country_name", "asn_org", "final_service_type", *DAY,
    ).agg(F.sum("_b").alias("_b"), F.sum("_p").alias("total_packets"), F.sum("_n").alias("flow_count"))
    return with_account(agg, dims.ec2).select(
        "account_name", *VPC, "domain", "dstport", L.port_label("dstport").alias("destination_port"),
        "destination_ip", "country_name", "asn_org", "final_service_type",
        L.gb("_b", 6).alias("total_gb"), "total_packets", "flow_count", *DAY, _ld(),
    )


def network_intelligence_final(flows: DataFrame, dns: DataFrame, dims, mode: str = "literal",
                               domains: DataFrame | None = None, meta: DataFrame | None = None,
                               pre: DataFrame | None = None) -> DataFrame:
    """Widest enriched fact. Every join is to a unique key that is a subset of
    the summary grain, so the grain of ``flow_daily_summary`` is kept and no
    second aggregation (and shuffle) is needed."""
    vpc_sum = flow_daily_summary(flows, mode, pre)
    domains = primary_domain(dns_daily_summary(dns)) if domains is None else domains
    if meta is None:
        meta = ip_metadata(vpc_sum, dims, keys=("dstaddr", "pkt_dst_aws_service"), service_matched=True)
    u = with_primary_domain(vpc_sum, domains)
    u = with_owner_labels(u, dims.ec2)
    u = join_metadata(u, meta, ["dstaddr", "pkt_dst_aws_service"])
    return u.select(
        "account_name", "biz_unit", "application_id", *VPC, "instance_id",
        F.col("srcaddr").alias("client_ip"), F.col("dstaddr").alias("destination_ip"),
        F.coalesce("domain", F.lit(L.UNKNOWN)).alias("domain"),
        "pkt_dst_aws_service", "traffic_path", "country_name", "asn_org", "final_service_type", "aws_region",
        L.region_scope("cloud_service", "aws_region", "region", strict=True).alias("region_scope"),
        L.gb("total_bytes", 6).alias("data_out_gb"), "total_packets", *DAY, _ld(),
    )


def flow_bi_rollup(flows: DataFrame) -> DataFrame:
    """22-key roll-up of OK records with protocol names and log_date."""
    return (
        flows.where(status_ok())
        .groupBy(
            "account_id", "region", "az_id", "vpc_id", "subnet_id", "instance_id", "interface_id",
            F.col("type").alias("eni_type"), F.col("srcaddr").alias("source_ip"),
            F.col("dstaddr").alias("destination_ip"), "srcport", "dstport",
            "pkt_src_aws_service", "pkt_dst_aws_service", "flow_direction", "traffic_path",
            "protocol", "action", "tcp_flags", *DAY,
        )
        .agg(F.sum("bytes").alias("total_bytes"), F.sum("packets").alias("total_packets"),
             F.count(F.lit(1)).alias("flow_record_count"))
        .select(
            "account_id", "region", "az_id", "vpc_id", "subnet_id", "instance_id", "interface_id", "eni_type",
            "source_ip", "destination_ip", "srcport", "dstport", "pkt_src_aws_service", "pkt_dst_aws_service",
            "flow_direction", "traffic_path", "protocol", L.protocol_name("protocol").alias("protocol_name"),
            "action", "tcp_flags", log_date().alias("log_date"), *DAY,
            "total_bytes", "total_packets", "flow_record_count")
    )


def profile_counts(flows: DataFrame) -> DataFrame:
    return flows.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count("bytes").alias("non_null_bytes"),
        F.count("packets").alias("non_null_packets"),
    )


def profile_columns(df: DataFrame) -> DataFrame:
    """One row per column: position, name, type, rows, and rows that aren't NULL.
    One wide aggregate, turned long; the table is read once."""
    counts = df.agg(F.count(F.lit(1)).alias("n_rows"), *[F.count(F.col(quoted(c))).alias(f"n{k}") for k, c in enumerate(df.columns)])
    rows = F.array(*[F.struct(F.lit(k + 1).alias("position"), F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("data_type"),
                              F.col(f"n{k}").alias("n_non_null")) for k, f in enumerate(df.schema.fields)])
    return counts.select("n_rows", F.explode(rows).alias("c")).select("c.position", "c.column_name", "c.data_type", "n_rows", "c.n_non_null")


def profile_rows_per_file(scan: DataFrame) -> DataFrame:
    """Rows per source file of a file-based scan (uses the _metadata column)."""
    return scan.groupBy(F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_name").alias("file_name")).agg(
        F.count(F.lit(1)).alias("rows_per_file")
    )


def by_volume(final: DataFrame, name: str = "volume_rank") -> DataFrame:
    """``network_intelligence_final`` in the order of its volume: each row with
    its place in the whole table (largest first, ties by the row's keys)."""
    keys = [*VPC, "instance_id", "client_ip", "destination_ip", "pkt_dst_aws_service", "traffic_path", *DAY]
    return global_rank(final, [F.col("data_out_gb").desc_nulls_last(), *tie_breakers(keys)], name)
