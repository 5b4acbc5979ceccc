"""Adapters from the driver's TPC-H-like tables to flow-log-shaped inputs.

The reference ships no data, so the curated flow table, the curated DNS table
and the five dimension tables are derived deterministically from
``lineitem``, ``part`` and ``nation`` (rules in FIXTURES.md, part B). Every
adapter is a narrow projection of a Parquet scan (no shuffle) except
``resolved_ips`` (one distinct). All of them grow with the input tables.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import epoch_to_ntz

# Fixed values of the fixture (FIXTURES.md part B).
REGIONS = ["us-east-1", "us-west-1", "eu-west-1"]
PORTS = [443, 80, 53, 22, 3306, 5432, 6379, 8080, 9000]
PROTOCOLS = [6, 17, 1]
TCP_FLAGS = [2, 18]
PKT_SERVICES = ["S3", "EC2", "", "DYNAMODB", None]
CLOUD_SERVICES = ["S3", "EC2", "DYNAMODB"]
CLOUD_REGIONS = ["us-east-1", "us-west-1"]
UMBRELLA_SERVICE = "AMAZON"
UMBRELLA_REGION = "GLOBAL"
DAY_START_EPOCH = 1771113600  # 2026-02-15 00:00:00 UTC
FIXTURE_DAY = ("2026", "02", "15")

# Curated flow schema: data columns, then partition columns.
FLOW_COLUMNS = [
    ("version", "int"), ("log_account_id", "string"), ("interface_id", "string"),
    ("srcaddr", "string"), ("dstaddr", "string"), ("srcport", "int"), ("dstport", "int"),
    ("protocol", "int"), ("packets", "bigint"), ("bytes", "bigint"),
    ("start_time", "bigint"), ("end_time", "bigint"), ("action", "string"),
    ("log_status", "string"), ("vpc_id", "string"), ("subnet_id", "string"),
    ("instance_id", "string"), ("tcp_flags", "int"), ("type", "string"),
    ("pkt_srcaddr", "string"), ("pkt_dstaddr", "string"), ("log_region", "string"),
    ("az_id", "string"), ("sublocation_type", "string"), ("sublocation_id", "string"),
    ("pkt_src_aws_service", "string"), ("pkt_dst_aws_service", "string"),
    ("flow_direction", "string"), ("traffic_path", "int"),
]
FLOW_PARTITIONS = ["account_id", "region", "year", "month", "day"]
DNS_PARTITIONS = ["account_id", "vpc_id", "year", "month", "day"]

ANSWER_TYPE = T.ArrayType(T.StructType([T.StructField("Rdata", T.StringType())]))


def _pick(index: Column, values: list, dtype: str | None = None) -> Column:
    """values[index] as a CASE chain (index is a small non-negative int)."""
    expr = None
    for i, v in enumerate(values):
        lit = F.lit(v) if dtype is None else F.lit(v).cast(dtype)
        expr = F.when(index == i, lit) if expr is None else expr.when(index == i, lit)
    return expr


def _s(c: Column) -> Column:
    return c.cast("string")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _flow_columns(li: DataFrame) -> DataFrame:
    k, n, p, s = F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey"), F.col("l_suppkey")
    account = F.lpad(_s(s % 4 + 1), 12, "0")
    region = _pick(s % 3, REGIONS)
    pm100 = _s(p % 100)
    dst = (
        F.when(p % 97 == 0, F.lit("2600:1f18::1"))
        .when(p % 10 == 0, F.concat(F.lit("192.168.1."), pm100))
        .when(p % 10 == 1, F.concat(F.lit("10.9.0."), pm100))
        .when(p % 10 == 2, F.concat(F.lit("172.16.0."), pm100))
        .when(p % 10 == 3, F.concat(F.lit("172.20.0."), pm100))
        .otherwise(F.concat_ws(".", _s(p % 200 + 20), _s(p % 7 * 36), _s(s % 3), pm100))
    )
    src = F.concat(F.lit("10.0."), _s(s % 4), F.lit("."), _s(p % 50))
    nodata = k % 50 == 0
    start = F.lit(DAY_START_EPOCH).cast("bigint") + (k * 37 + n * 911) % 86400
    return li.select(
        k.alias("_k"), n.alias("_n"), p.alias("_p"),
        F.lit(5).alias("version"),
        account.alias("log_account_id"),
        F.concat(F.lit("eni-"), _s(s % 20)).alias("interface_id"),
        src.alias("srcaddr"),
        dst.alias("dstaddr"),
        (F.lit(1024) + k % 4000).cast("int").alias("srcport"),
        _pick(p % 9, PORTS, "int").alias("dstport"),
        _pick(n % 3, PROTOCOLS, "int").alias("protocol"),
        F.when(~nodata, F.round(F.col("l_quantity")).cast("bigint")).alias("packets"),
        F.when(~nodata, F.round(F.col("l_extendedprice") * 1000).cast("bigint")).alias("bytes"),
        start.alias("start_time"),
        (start + 60).alias("end_time"),
        F.when(F.col("l_returnflag") == "R", "REJECT").otherwise("ACCEPT").alias("action"),
        F.when(nodata, "NODATA").otherwise("OK").alias("log_status"),
        F.concat(F.lit("vpc-"), _s(s % 6)).alias("vpc_id"),
        F.concat(F.lit("subnet-"), _s(s % 9)).alias("subnet_id"),
        F.when(n != 7, F.concat(F.lit("i-"), _s(p % 40))).alias("instance_id"),
        _pick(k % 2, TCP_FLAGS, "int").alias("tcp_flags"),
        F.lit("IPv4").alias("type"),
        src.alias("pkt_srcaddr"),
        dst.alias("pkt_dstaddr"),
        region.alias("log_region"),
        F.concat(F.lit("az-"), _s(s % 3)).alias("az_id"),
        F.lit(None).cast("string").alias("sublocation_type"),
        F.lit(None).cast("string").alias("sublocation_id"),
        F.lit(None).cast("string").alias("pkt_src_aws_service"),
        _pick(s % 5, PKT_SERVICES, "string").alias("pkt_dst_aws_service"),
        F.when(F.col("l_linestatus") == "O", "egress").otherwise("ingress").alias("flow_direction"),
        (n % 3).cast("int").alias("traffic_path"),
        account.alias("account_id"),
        region.alias("region"),
        F.lit(FIXTURE_DAY[0]).alias("year"),
        F.lit(FIXTURE_DAY[1]).alias("month"),
        F.lit(FIXTURE_DAY[2]).alias("day"),
    )


def flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Curated VPC flow records, one per lineitem row."""
    li = _table(spark, sf_dir, "lineitem")
    cols = [c for c, _ in FLOW_COLUMNS] + FLOW_PARTITIONS
    return _flow_columns(li).select(*cols)


def dns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Curated resolver query logs: one query per flow. Queries of line numbers
    above 3 were answered with an address no flow goes to (TEST-NET-2)."""
    base = _flow_columns(_table(spark, sf_dir, "lineitem"))
    k, p, n = F.col("_k"), F.col("_p"), F.col("_n")
    answer = F.when(n <= 3, F.col("dstaddr")).otherwise(F.concat(F.lit("198.51.100."), _s(p % 100)))
    dns_time = F.col("start_time") - k % 900
    stamp = F.date_format(epoch_to_ntz(dns_time), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    answers = (
        F.when(k % 22 == 0, F.lit(None).cast(ANSWER_TYPE))
        .when(k % 11 == 0, F.array().cast(ANSWER_TYPE))
        .otherwise(F.array(F.struct(answer.alias("Rdata"))))
    )
    return base.select(
        "account_id",
        "region",
        "vpc_id",
        "srcaddr",
        "srcport",
        F.when(F.col("instance_id").isNotNull(), F.create_map(F.lit("instance"), F.col("instance_id"))).alias("srcids"),
        F.concat(F.lit("host"), _s(p % 60), F.lit(".example.com")).alias("query_name"),
        F.lit("A").alias("query_type"),
        F.lit("IN").alias("query_class"),
        stamp.alias("query_timestamp"),
        answers.alias("answers"),
        F.when(k % 11 == 0, "NXDOMAIN").otherwise("NOERROR").alias("rcode"),
        F.lit("UDP").alias("transport"),
        F.lit("1.100000").alias("version"),
        F.substring(stamp, 1, 4).alias("year"),
        F.substring(stamp, 6, 2).alias("month"),
        F.substring(stamp, 9, 2).alias("day"),
    )


def ec2_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Instance inventory. Each (account, region, instance) key has several rows
    with different business units (the fan-out trap of the reference)."""
    p = F.col("p_partkey")
    return _table(spark, sf_dir, "part").select(
        F.lpad(_s(p % 3 + 1), 12, "0").alias("account_id"),
        _pick(F.floor(p / 3) % 3, REGIONS).alias("region"),
        F.concat(F.lit("i-"), _s(p % 45)).alias("instance_id"),
        F.concat(F.lit("acct-"), _s(p % 3 + 1)).alias("account_name"),
        F.col("p_type").alias("biz_unit"),
        F.concat(F.lit("app-"), _s(p % 8)).alias("application_id"),
    )


def _block(p: Column) -> tuple[Column, Column]:
    """(first address, width) of a part's block. Parts share 180 first octets;
    the first 64 of an octet get a quarter-million addresses each, side by side,
    later ones a /24 inside one of those (nested ranges)."""
    j = F.floor(p / 180)
    lo = (p % 180 + 20) * 16777216 + j % 64 * 262144 + F.when(j < 64, 0).otherwise(F.floor(j / 64) % 1024 * 256)
    return lo.cast("bigint"), F.when(j < 64, 262144).otherwise(256).cast("bigint")


def geo_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = F.col("p_partkey")
    lo, width = _block(p)
    return _table(spark, sf_dir, "part").select(
        lo.alias("network_start_integer"), (lo + width - 1).alias("network_end_integer"),
        (p % 30).cast("bigint").alias("geoname_id"))


def geo_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names by id; even ids have a second one (another locale)."""
    nation = _table(spark, sf_dir, "nation")
    gid = F.col("n_nationkey").cast("bigint").alias("geoname_id")
    return nation.select(gid, F.col("n_name").alias("country_name")).unionByName(
        nation.where(F.col("n_nationkey") % 2 == 0).select(gid, F.lower("n_name").alias("country_name")))


def geo_asn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two halves per block, each with its own organisation."""
    p = F.col("p_partkey")
    part = _table(spark, sf_dir, "part")
    lo, width = _block(p)
    half = (width / 2).cast("bigint")
    parts = []
    for k, shift in ((0, 0), (1, 13)):
        start = lo + k * half
        parts.append(part.select(
            start.alias("network_start_integer"), (start + half - 1).alias("network_end_integer"),
            F.concat(F.lit("AS-"), _s((p + shift) % 40)).alias("autonomous_system_organization")))
    return parts[0].unionByName(parts[1])


def cloud_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cloud provider ranges: each spans two /8 and is repeated under the
    umbrella service label, so ranges overlap."""
    n = F.col("n_nationkey").cast("bigint")
    nat = _table(spark, sf_dir, "nation")
    lo = (n * 8 + 20) * 16777216
    specific = nat.select(
        lo.alias("network_start_int"),
        (lo + 2 * 16777216 - 1).alias("network_end_int"),
        _pick(n % 3, CLOUD_SERVICES).alias("service"),
        _pick(n % 2, CLOUD_REGIONS).alias("region"),
    )
    umbrella = specific.select(
        "network_start_int", "network_end_int",
        F.lit(UMBRELLA_SERVICE).alias("service"), F.lit(UMBRELLA_REGION).alias("region"),
    )
    return specific.unionByName(umbrella)


def resolved_ips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reverse-DNS table: a name for each destination, some with a second one;
    the rows of every third part name an address no flow goes to."""
    f = _flow_columns(_table(spark, sf_dir, "lineitem"))
    p = F.col("_p")
    address = F.when(p % 3 != 0, F.col("dstaddr")).otherwise(F.concat(F.lit("203.0.113."), _s(p % 100)))
    name = F.concat(F.when(p % 11 == 0, "second-").otherwise("rev-"), F.regexp_replace("dstaddr", r"[.:]", "-"), F.lit(".example.net"))
    return f.select(address.alias("dstaddr"), name.alias("domain")).distinct()


@dataclass
class Dims:
    ec2: DataFrame
    geo_blocks: DataFrame
    geo_locations: DataFrame
    geo_asn: DataFrame
    cloud_ranges: DataFrame


class LazyDims(Dims):
    """Dims whose tables are read on first use."""

    def __init__(self, spark: SparkSession, sf_dir: str):  # noqa: D107
        self._spark, self._dir = spark, sf_dir

    def __getattr__(self, name):
        builders = {"ec2": ec2_details, "geo_blocks": geo_blocks, "geo_locations": geo_locations,
                    "geo_asn": geo_asn, "cloud_ranges": cloud_ranges}
        if name not in builders:
            raise AttributeError(name)
        value = builders[name](self._spark, self._dir)
        setattr(self, name, value)
        return value


def dims(spark: SparkSession, sf_dir: str) -> Dims:
    return LazyDims(spark, sf_dir)
