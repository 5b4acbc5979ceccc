"""ETL jobs: raw logs -> curated Parquet, and the curated -> database copy."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import log_date
from ..functions.filters import on_day
from ..session import scratch_path, with_conf
from ..sinks.appends import append_batch, read_committed, stage_batch
from ..sinks.tables import create_or_replace_table
from ..sinks.writers import large_files, to_path_layout, write_partitioned, write_raw_dns_logs, write_raw_flow_logs
from ..sources import fixtures
from ..sources.catalog import create_external_table, partition_statistics
from ..sources.fixtures import DNS_PARTITIONS, FLOW_COLUMNS, FLOW_PARTITIONS
from ..sources.rawlogs import (DNS_CURATED, RAW_HIVE_FLOW_KEYS, dns_log_paths, flow_log_paths, flow_schema_ddl, read_curated, read_dns_logs,
                              read_flow_logs, small_inputs)

# The column order of the curated database copy.
PUBLISH_COLUMNS = [
    "az_id", "action", "bytes", "dstaddr", "dstport", "end_time", "flow_direction", "instance_id",
    "interface_id", "log_status", "packets", "pkt_dst_aws_service", "pkt_dstaddr", "pkt_src_aws_service",
    "pkt_srcaddr", "protocol", "srcaddr", "srcport", "start_time", "sublocation_id", "sublocation_type",
    "subnet_id", "tcp_flags", "traffic_path", "type", "version", "vpc_id", "account_id", "region",
    "year", "month", "day", "log_date",
]
FLOW_FILE_RECORDS = 1_500_000
DNS_FILE_RECORDS = 500_000
# raw logs are compressed text, 10 to 20 times as large when read: more and smaller tasks
RAW_SPLITS = {"spark.sql.files.maxPartitionBytes": str(32 << 20)}


def ingest_flow_logs(spark: SparkSession, raw_paths, out_path: str, layout: str = "aws") -> DataFrame:
    """Raw flow logs -> curated Parquet partitioned by account/region/day;
    returns the curated table as written."""
    curated = read_flow_logs(spark, raw_paths, layout)
    with with_conf(spark, RAW_SPLITS):
        write_partitioned(curated, out_path, FLOW_PARTITIONS, max_records=FLOW_FILE_RECORDS, spread=small_inputs(spark, raw_paths))
    return read_curated(spark, out_path).select(*[c for c, _ in FLOW_COLUMNS], *FLOW_PARTITIONS)


def ingest_dns_logs(spark: SparkSession, raw_paths, out_path: str, layout: str = "aws") -> DataFrame:
    curated = read_dns_logs(spark, raw_paths, layout)
    with with_conf(spark, RAW_SPLITS):
        write_partitioned(curated, out_path, DNS_PARTITIONS, max_records=DNS_FILE_RECORDS, spread=small_inputs(spark, raw_paths))
    return read_curated(spark, out_path).select(*DNS_CURATED)


def publish_curated(curated: DataFrame) -> DataFrame:
    """The exact projection loaded into the database copy (rows without
    addresses or account dropped)."""
    df = curated.withColumn("log_date", log_date())
    return df.dropna(subset=["srcaddr", "dstaddr", "log_date", "account_id"]).select(*PUBLISH_COLUMNS)


def answers_text(df: DataFrame) -> DataFrame:
    """answers array -> comma-joined Rdata text (comparison-friendly form)."""
    return df.withColumn(
        "answers", F.array_join(F.transform("answers", lambda a: a["Rdata"]), ",")
    )


def flow_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Curated fixture flows -> raw text files -> ingest -> curated Parquet."""
    raw = scratch_path(spark, "raw-flowlogs")
    write_raw_flow_logs(fixtures.flows(spark, sf_dir), raw)
    return ingest_flow_logs(spark, raw, scratch_path(spark, "curated-flowlogs"), layout="hive")


def listed_accounts(spark: SparkSession, sf_dir: str, accounts: tuple[str, ...] = ("000000000002", "000000000004", "999999999999")) -> DataFrame:
    """Raw text in the log delivery's own folders, of which the listed accounts'
    are read (one of them has none); account, region and day come from the path."""
    hive, raw = scratch_path(spark, "raw-flowlogs"), scratch_path(spark, "delivered-flowlogs")
    write_raw_flow_logs(fixtures.flows(spark, sf_dir), hive)
    to_path_layout(spark, hive, raw, [RAW_HIVE_FLOW_KEYS[p] for p in FLOW_PARTITIONS],
                   "AWSLogs/{account_id}/vpcflowlogs/{path_region}/{year}/{month}/{day}")
    read = read_flow_logs(spark, flow_log_paths(raw, fixtures.FIXTURE_DAY, accounts))
    return read.groupBy("account_id", "region", "year", "month", "day", "log_account_id").agg(
        F.count(F.lit(1)).alias("n_flows"), F.sum("bytes").alias("total_bytes"), F.count("instance_id").alias("n_instances"))


def delivered_dns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw DNS records in the delivery's folders, every account and VPC by wildcard; VPC and day come from the path."""
    hive, raw = scratch_path(spark, "raw-dnslogs"), scratch_path(spark, "delivered-dnslogs")
    write_raw_dns_logs(fixtures.dns(spark, sf_dir), hive)
    to_path_layout(spark, hive, raw, DNS_PARTITIONS, "AWSLogs/{account_id}/vpcdnsquerylogs/{vpc_id}/{year}/{month}/{day}")
    y, m, d = fixtures.FIXTURE_DAY
    days = [(y, m, f"{int(d) + k:02d}") for k in (-1, 0, 1)]
    return read_dns_logs(spark, dns_log_paths(raw, days)).groupBy("vpc_id", "year", "month", "day", "rcode").agg(
        F.count(F.lit(1)).alias("n_queries"), F.countDistinct("query_name").alias("n_names"), F.count("answers").alias("n_answered"))


def dns_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records with a field that the curated schema doesn't know, too: it comes
    back from the residue."""
    raw = scratch_path(spark, "raw-dnslogs")
    records = fixtures.dns(spark, sf_dir)
    write_raw_dns_logs(records.withColumn("firewall", F.when(F.col("rcode") != "NOERROR", F.struct(F.lit("ALERT").alias("action"), "srcport"))), raw)
    curated = ingest_dns_logs(spark, raw, scratch_path(spark, "curated-dnslogs"), layout="hive")
    return answers_text(curated).withColumns({
        "src_instance": F.col("srcids")["instance"],
        "firewall_action": F.try_variant_get("residue", "$.firewall.action", "string"),
        "firewall_port": F.try_variant_get("residue", "$.firewall.srcport", "int"),
    }).drop("srcids", "residue")


def curated_days_path(spark: SparkSession, sf_dir: str) -> str:
    """The fixture flows over two days (odd start seconds one day later),
    written as the partitioned curated table."""
    flows = fixtures.flows(spark, sf_dir)
    late = F.col("start_time") % 2 == 1
    two = flows.withColumns({
        "day": F.when(late, "16").otherwise(F.col("day")),
        "start_time": F.col("start_time") + F.when(late, 86400).otherwise(0),
    })
    path = scratch_path(spark, "curated-days")
    write_partitioned(two, path, FLOW_PARTITIONS, max_records=FLOW_FILE_RECORDS)
    return path


def curated_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_curated(spark, curated_days_path(spark, sf_dir))


def curated_day_totals(spark: SparkSession, sf_dir: str, day: tuple[str, str, str] = ("2026", "02", "16")) -> DataFrame:
    """Totals of one day of a partitioned table of two days: the day filter
    prunes the other day's folders."""
    return curated_days(spark, sf_dir).where(on_day(*day)).groupBy("account_id", "region", "day").agg(
        F.count(F.lit(1)).alias("n_flows"), F.sum("bytes").alias("total_bytes"), F.min("start_time").alias("first_start"))


def catalog_day_totals(spark: SparkSession, sf_dir: str, day: tuple[str, str, str] = ("2026", "02", "16")) -> DataFrame:
    """One day per VPC through the catalog: an external table over the curated folders, its partitions
    recovered and analysed; the day filter picks partitions in the catalog."""
    name = f"curated_flows_{uuid.uuid4().hex[:12]}"
    create_external_table(spark, name, curated_days_path(spark, sf_dir))
    partition_statistics(spark, name)
    return spark.table(name).where(on_day(*day)).groupBy("vpc_id", "day").agg(
        F.count(F.lit(1)).alias("n_flows"), F.sum("bytes").alias("total_bytes"), F.max("end_time").alias("last_end"))


def allowed_accounts(ec2: DataFrame, names: list[str]) -> DataFrame:
    """The allow-list as a table: the account ids of the named accounts."""
    return ec2.where(F.col("account_name").isin(names)).select("account_id").distinct()


def allowed_account_totals(spark: SparkSession, sf_dir: str, names: tuple[str, ...] = ("acct-1", "acct-3")) -> DataFrame:
    """Totals per allowed account and day. The list is joined to the partition
    column, so its account folders alone are read, decided while the query runs."""
    allowed = allowed_accounts(fixtures.ec2_details(spark, sf_dir), list(names))
    return curated_days(spark, sf_dir).join(F.broadcast(allowed), "account_id").groupBy("account_id", "day").agg(      # one row per account named
        F.count(F.lit(1)).alias("n_flows"), F.sum("bytes").alias("total_bytes"))


def appended_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals of a table that grew by appends: two batches, the second one
    repeated, and a third that broke off before its commit."""
    flows, path = fixtures.flows(spark, sf_dir), scratch_path(spark, "appended-flows")
    early = F.col("start_time") % 86400 < 43200
    spread = not large_files(flows, FLOW_PARTITIONS)
    append_batch(flows.where(early), path, FLOW_PARTITIONS, "morning", spread)
    for _ in range(2):
        append_batch(flows.where(~early), path, FLOW_PARTITIONS, "afternoon", spread)
    stage_batch(flows, path, FLOW_PARTITIONS, "broken-off", spread)
    return read_committed(spark, path, flow_schema_ddl()).groupBy("account_id", "region", "ingest_batch").agg(
        F.count(F.lit(1)).alias("n_flows"), F.sum("bytes").alias("total_bytes"))


def replaced_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes per destination, created as a table and then created again: the table holds one copy."""
    name, root = f"destinations_{uuid.uuid4().hex[:12]}", scratch_path(spark, "tables")
    for _ in range(2):
        totals = fixtures.flows(spark, sf_dir).groupBy("dstaddr", "flow_direction").agg(F.sum("bytes").alias("total_bytes"), F.count(F.lit(1)).alias("n_flows"))
        create_or_replace_table(totals, name, root)
    return spark.table(name)
