"""Queries over the joined daily logs (flow summary + domain + owner labels):
top-N enrichment, ASN x service roll-ups, the IP->ASN dictionary, the
service pivot report and the destination x domain x country pre-aggregate."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import labels as L
from ..functions.filters import in_values, on_day, status_ok
from ..functions.ipmath import ip_to_int
from ..operators.dns import dns_daily_summary, primary_domain, with_primary_domain, with_reverse_domain
from ..operators.lookups import with_owner_labels
from ..operators.topn import tie_breakers, top_n_per_group
from .daily import DAY, VPC, egress
from ..operators.rangejoin import range_matches
from ..session import materialize
from .ipmeta import ip_metadata, join_metadata, with_asn, with_country

# The service columns of the pivot report, in report order.
PIVOT_SERVICES = ["S3", "EC2", "AMAZON", "ROUTE53", "CLOUDFRONT", "DYNAMODB", "GLOBALACCELERATOR", "AMAZON_CONNECT"]

JOINED_COLUMNS = [
    "account_id", "account_name", "biz_units", "application_id", "instance_id", "client_ip",
    "destination_ip", "dstport", "domain", "pkt_dst_aws_service", "total_bytes", "region", "vpc_id", *DAY,
]


def joined_logs(flows: DataFrame, dns: DataFrame, ec2: DataFrame, mode: str = "literal") -> DataFrame:
    """Daily egress summary per instance x client x destination x port x
    service, with the primary domain (NULL when none) and owner labels."""
    base = (
        egress(flows, mode).where(status_ok())
        .groupBy(*VPC, "instance_id", "srcaddr", "dstaddr", "dstport", "pkt_dst_aws_service", *DAY)
        .agg(F.sum("bytes").alias("total_bytes"))
    )
    j = with_primary_domain(base, primary_domain(dns_daily_summary(dns)))
    j = with_owner_labels(j, ec2)
    return j.select(
        "account_id", "account_name", F.col("biz_unit").alias("biz_units"), "application_id", "instance_id",
        F.col("srcaddr").alias("client_ip"), F.col("dstaddr").alias("destination_ip"), "dstport", "domain",
        "pkt_dst_aws_service", "total_bytes", "region", "vpc_id", *DAY,
    )


def _meta(df: DataFrame, dims) -> DataFrame:
    """Enrich ``df`` (read twice: for its key set and for the join-back), so
    it is checkpointed once and both reads use the written rows."""
    df = materialize(df)
    meta = ip_metadata(df, dims, keys=("destination_ip", "pkt_dst_aws_service"), service_matched=True,
                       checkpoint_keys=False)
    return join_metadata(df, meta, ["destination_ip", "pkt_dst_aws_service"])


def top_flows_enriched(joined: DataFrame, dims, day=None, n: int = 300) -> DataFrame:
    """Top ``n`` rows per (account, region, vpc) by bytes, then enriched --
    the range joins run on the survivors only."""
    d = joined.where(F.col("instance_id").isNotNull() & on_day(*(day or (None, None, None))))
    top = top_n_per_group(
        d, VPC,
        [F.col("total_bytes").desc_nulls_last(), *tie_breakers(
            [*DAY, "instance_id", "client_ip", "destination_ip", "dstport", "pkt_dst_aws_service"])],
        n,
    )
    e = _meta(top, dims)
    return e.select(
        "account_name", "biz_units", "application_id", "instance_id", F.col("client_ip").alias("srcaddr"),
        F.col("destination_ip").alias("dstaddr"), F.col("domain").alias("query_name"), "country_name",
        "asn_org", "final_service_type", "aws_region",
        L.region_scope("cloud_service", "aws_region", "region", strict=False).alias("region_scope"),
        "total_bytes", *VPC, *DAY,
    )


def domain_traffic_summary(joined: DataFrame, dims, day=None, n: int = 300) -> DataFrame:
    """Top ``n`` (domain, destination) per (account, region, vpc, port) by GB
    rounded to 2 decimals (ties by domain, destination), then the country."""
    d = joined.where(
        F.col("domain").isNotNull() & (F.col("domain") != "") & on_day(*(day or (None, None, None)))
    )
    g = d.groupBy("account_id", "vpc_id", "region", "domain", "destination_ip", "dstport", *DAY).agg(
        L.gb(F.sum("total_bytes"), 2).alias("gb_transferred")
    )
    top = top_n_per_group(
        g, [*VPC, "dstport"],
        [F.col("gb_transferred").desc_nulls_last(), *tie_breakers([*DAY, "domain", "destination_ip"])], n,
    )
    pts = materialize(top.withColumn("dst_ip_int", ip_to_int("destination_ip")))
    return with_country(pts, dims).select(
        "domain", "destination_ip", "dstport", "gb_transferred", "country_name", *VPC, *DAY
    )


def joined_preagg_enriched(joined: DataFrame, dims, day=None) -> DataFrame:
    """Daily pre-aggregate of the joined logs with country, ASN and the
    service-matched cloud range (every bucket a range covers is searched)."""
    c = joined.where(on_day(*(day or (None, None, None))) & F.col("instance_id").isNotNull()).groupBy(
        "account_id", "account_name", "region", "vpc_id", "application_id", "instance_id", "client_ip",
        "destination_ip", "dstport", "domain", "pkt_dst_aws_service", *DAY,
    ).agg(F.sum("total_bytes").alias("total_bytes"))
    e = _meta(c, dims)
    return e.select(
        "account_name", "application_id", "instance_id", F.col("client_ip").alias("srcaddr"),
        F.col("destination_ip").alias("dstaddr"), "dstport", F.col("domain").alias("query_name"),
        "country_name", "asn_org", "final_service_type", "aws_region",
        L.region_scope("cloud_service", "aws_region", "region", strict=True).alias("region_scope"),
        L.gb("total_bytes").alias("data_out_gb"), "account_id", "region", *DAY,
    )


ROLLUP_KEYS = ["account_id", "account_name", "region", "vpc_id", *DAY]


def asn_service_rollup(joined: DataFrame, dims) -> DataFrame:
    """ASN x service bytes. The ASN range join is attempted only for
    destinations without a packet-level service (the guard nulls the key)."""
    pre = materialize(joined.where(F.col("instance_id").isNotNull()).groupBy(
        *ROLLUP_KEYS, "destination_ip", "pkt_dst_aws_service"
    ).agg(F.sum("total_bytes").alias("total_bytes")))
    guarded = pre.withColumn(
        "_gip", F.when(~L.has_service("pkt_dst_aws_service"), ip_to_int("destination_ip"))
    )
    keys = guarded.select("_gip").where(F.col("_gip").isNotNull()).distinct()
    asn = range_matches(keys, dims.geo_asn, "_gip", "network_start_integer", "network_end_integer",
                        ["autonomous_system_organization"], rename={"autonomous_system_organization": "_asn"})
    r = guarded.join(asn, "_gip", "left")
    return r.groupBy(
        *ROLLUP_KEYS,
        L.asn_org_label("pkt_dst_aws_service", "_asn").alias("asn_org"),
        L.service_label("pkt_dst_aws_service", L.GENERAL_TRAFFIC).alias("service_label"),
    ).agg(F.sum("total_bytes").alias("total_bytes"))


def ip_asn_dictionary(joined: DataFrame, dims) -> DataFrame:
    """Distinct external destinations (no packet service) -> ASN organisation."""
    ips = joined.where(F.col("instance_id").isNotNull() & ~L.has_service("pkt_dst_aws_service")).select(
        "destination_ip"
    ).distinct().withColumn("dst_ip_int", ip_to_int("destination_ip"))
    return with_asn(ips, dims).select(
        "destination_ip", F.coalesce("asn_org", F.lit(L.UNKNOWN_ASN)).alias("asn_org")
    )


def asn_service_from_dictionary(joined: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Same roll-up as ``asn_service_rollup`` through the dictionary table."""
    d = dictionary.select("destination_ip", F.col("asn_org").alias("_dict_asn"))
    j = joined.where(F.col("instance_id").isNotNull()).join(d, "destination_ip", "left")
    return j.groupBy(
        *ROLLUP_KEYS,
        L.asn_org_label("pkt_dst_aws_service", "_dict_asn").alias("asn_org"),
        L.service_label("pkt_dst_aws_service", L.GENERAL_TRAFFIC).alias("service_label"),
    ).agg(F.sum("total_bytes").alias("total_bytes"))


def asn_service_pivot(agg: DataFrame, account=None, vpcs=None, regions=None, years=None, months=None,
                      days=None, top: int = 20) -> DataFrame:
    """GB per service for the cloud ASN, general traffic for others; the 20
    ASNs with most bytes (a top-k report; ties by asn_org)."""
    pred = F.lit(True) if account is None else F.col("account_id") == account
    for col, values in (("vpc_id", vpcs), ("region", regions), ("year", years), ("month", months), ("day", days)):
        pred = pred & in_values(col, values)
    is_cloud = F.col("asn_org") == L.CLOUD_ASN_ORG

    def svc_gb(label):
        return F.round(
            F.sum(F.when(F.col("service_label") == label, F.col("total_bytes")).otherwise(F.lit(0))).cast("double")
            / L.BYTES_PER_GB, 3)

    aggs = [F.when(is_cloud, svc_gb(s)).alias(s) for s in PIVOT_SERVICES]
    aggs.append(F.when(~is_cloud, svc_gb(L.GENERAL_TRAFFIC)).alias("General_Traffic"))
    aggs.append(F.sum("total_bytes").alias("_total"))
    return (
        agg.where(pred).groupBy("asn_org").agg(*aggs)
        .orderBy(F.col("_total").desc_nulls_last(), F.col("asn_org").asc_nulls_last())
        .limit(top)
        .drop("_total")
    )


def egress_domain_country(flows: DataFrame, dims, resolved: DataFrame, mode: str = "literal") -> DataFrame:
    """Destination x reverse-DNS domain x country per VPC and day. Country is
    resolved once per distinct destination (dictionary) and joined back."""
    crushed = egress(flows, mode).groupBy(*VPC, F.col("dstaddr").alias("destination_ip"), *DAY).agg(
        F.sum("bytes").alias("total_bytes")
    )
    # the destination dictionary is a narrow pass over the facts, written once
    geo = materialize(crushed.select("destination_ip").distinct().withColumn("ip_int", ip_to_int("destination_ip")))
    geo = with_country(geo, dims, ip="ip_int")
    j = with_reverse_domain(crushed, resolved, ip="destination_ip", name="_rev")
    j = j.join(geo, "destination_ip", "left")
    return j.select(
        "vpc_id", "destination_ip", F.coalesce("_rev", F.lit("unknown")).alias("domain"), "country_name",
        "total_bytes", "ip_int", "account_id", "region", *DAY,
    )


def ip_metadata_table(flows: DataFrame, dims, by_service: bool = False, mode: str = "literal") -> DataFrame:
    """Per distinct egress destination (and service): country, ASN, cloud
    service and region (narrowest range wins; service-matched when keyed by
    service)."""
    keys = ("dstaddr", "pkt_dst_aws_service") if by_service else ("dstaddr",)
    m = ip_metadata(egress(flows, mode), dims, keys=keys, service_matched=by_service)
    return m.select(*keys, "country_name", "asn_org", "final_service_type", "aws_region")


def reverse_domain_labels(unique_dest: DataFrame, resolved: DataFrame) -> DataFrame:
    """Attach the reverse-DNS name; 'No domain found' when the address has
    none and 'Invalid/No IP' when the address is missing."""
    j = with_reverse_domain(unique_dest, resolved, ip="destination_ip", name="_rev")
    label = (
        F.when(F.col("destination_ip").isNull(), F.lit("Invalid/No IP"))
        .otherwise(F.coalesce("_rev", F.lit("No domain found")))
    )
    return j.withColumn("domain", label).drop("_rev")
