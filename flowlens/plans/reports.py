"""Parameterised dashboard reports: filters are Column expressions and every
report is a top-k (the limit is the report)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import hour_bucket, log_date
from ..functions.filters import report_filter
from ..session import materialize


def report_source(flows: DataFrame) -> DataFrame:
    """The dashboard table: curated flows with ``start`` and ``date``."""
    return flows.withColumn("start", F.col("start_time")).withColumn("date", log_date())


def _filtered(src: DataFrame, **flt) -> DataFrame:
    return src.where(report_filter(date_col="date", **flt))


def report_traffic_by_hour(src: DataFrame, hours: int = 24, **flt) -> DataFrame:
    return (
        _filtered(src, **flt).groupBy(hour_bucket("start").alias("time_window"))
        .agg((F.sum("bytes").cast("double") / 1073741824.0).alias("total_gb"))
        .orderBy(F.col("time_window").desc()).limit(hours)
    )


def report_top_services(src: DataFrame, top: int = 5, **flt) -> DataFrame:
    return (
        _filtered(src, **flt).where(F.col("pkt_dst_aws_service").isNotNull())
        .groupBy("pkt_dst_aws_service").agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.col("count").desc(), F.col("pkt_dst_aws_service").asc()).limit(top)
    )


def report_flow_edges(src: DataFrame, limit: int = 20, **flt) -> DataFrame:
    return (
        _filtered(src, **flt).groupBy("srcaddr", "dstaddr")
        .agg((F.sum("bytes").cast("double") / 1048576.0).alias("total_mb"))
        .orderBy(F.col("total_mb").desc_nulls_last(), F.col("srcaddr").asc_nulls_last(),
                 F.col("dstaddr").asc_nulls_last())
        .limit(limit)
    )


def report_flow_nodes(edges: DataFrame) -> DataFrame:
    """Graph node ids for the top-k edges: sources in edge order, then
    destinations, numbered by first appearance. Works on the k edges only."""
    order = [F.col("total_mb").desc_nulls_last(), F.col("srcaddr").asc_nulls_last(), F.col("dstaddr").asc_nulls_last()]
    edges = materialize(edges)   # k rows, read twice below
    ranked = edges.withColumn("_r", F.row_number().over(Window.orderBy(*order)) - 1)
    k = F.count(F.lit(1)).over(Window.partitionBy(F.lit(0)))
    ranked = ranked.withColumn("_k", k)
    appear = ranked.select(F.col("srcaddr").alias("node"), F.col("_r").alias("_pos")).unionByName(
        ranked.select(F.col("dstaddr").alias("node"), (F.col("_k") + F.col("_r")).alias("_pos"))
    )
    first = appear.groupBy("node").agg(F.min("_pos").alias("_first"))
    return first.select("node", (F.row_number().over(Window.orderBy("_first")) - 1).cast("bigint").alias("node_id"))


def report_rejected(src: DataFrame, limit: int = 20, **flt) -> DataFrame:
    return (
        _filtered(src, **flt).where(F.col("action") == "REJECT")
        .groupBy("srcaddr", "dstport", "pkt_dst_aws_service").agg(F.count(F.lit(1)).alias("blocks"))
        .orderBy(F.col("blocks").desc(), F.col("srcaddr").asc_nulls_last(), F.col("dstport").asc_nulls_last(),
                 F.col("pkt_dst_aws_service").asc_nulls_last())
        .limit(limit)
    )
