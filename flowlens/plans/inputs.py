"""The inputs every query reads: curated flows, curated DNS, dimensions and
the reverse-DNS table. ``load`` builds them from the driver's tables through
the fixture adapters; a deployment builds the same object from curated
Parquet (``Inputs.from_frames``). Members are built on first use, so a query
only analyses the inputs it reads."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from ..session import prepare
from ..sources import fixtures


class Inputs:
    """``day`` is the (year, month, day) the day-scoped plans (top-N reports,
    single-day as-of, dashboard reports) run for; None means every day."""

    def __init__(self, spark: SparkSession, sf_dir: str | None = None,
                 day: tuple[str, str, str] | None = None, **frames):
        self.spark, self.sf_dir, self.day = spark, sf_dir, day
        self.__dict__.update(frames)

    @classmethod
    def from_frames(cls, spark: SparkSession, flows: DataFrame, dns: DataFrame, dims: fixtures.Dims,
                    resolved: DataFrame, day: tuple[str, str, str] | None = None) -> "Inputs":
        return cls(spark, None, day=day, flows=flows, dns=dns, dims=dims, resolved=resolved)

    @cached_property
    def flows(self) -> DataFrame:
        return fixtures.flows(self.spark, self.sf_dir)

    @cached_property
    def dns(self) -> DataFrame:
        return fixtures.dns(self.spark, self.sf_dir)

    @cached_property
    def dims(self) -> fixtures.Dims:
        return fixtures.dims(self.spark, self.sf_dir)

    @cached_property
    def resolved(self) -> DataFrame:
        return fixtures.resolved_ips(self.spark, self.sf_dir)


def load(spark: SparkSession, sf_dir: str) -> Inputs:
    """Fixture inputs; the day-scoped plans run for the fixture day."""
    prepare(spark)
    return Inputs(spark, sf_dir, day=fixtures.FIXTURE_DAY)


# Folder names of the dimension tables under the dimensions root (parameters
# of a deployment; override with ``dim_dirs``).
DIM_DIRS = {
    "ec2": "ec2_details",
    "geo_blocks": "geo_country_blocks_range",
    "geo_locations": "geo_country_locations",
    "geo_asn": "geo_asn_blocks_range",
    "cloud_ranges": "aws_ip_ranges_int",
}


def load_curated(spark: SparkSession, flows_root: str, dns_root: str, dims_root: str,
                 day: tuple[str, str, str] | None = None, accounts=None, resolved_path: str | None = None,
                 dim_dirs: dict | None = None) -> Inputs:
    """Inputs of a deployment: curated flow and DNS Parquet (partition-pruned
    to ``day`` / ``accounts``) and the dimension tables."""
    from ..sources.rawlogs import read_curated

    prepare(spark)
    dirs = {**DIM_DIRS, **(dim_dirs or {})}
    y, m, d = day if day else (None, None, None)
    flows = read_curated(spark, flows_root, y, m, d, accounts)
    dns = read_curated(spark, dns_root, y, m, d, accounts)

    def dim(name):
        return spark.read.option("mergeSchema", "false").parquet(f"{dims_root.rstrip('/')}/{dirs[name]}")

    dims = fixtures.Dims(**{k: dim(k) for k in DIM_DIRS})
    resolved = (spark.read.parquet(resolved_path) if resolved_path
                else spark.createDataFrame([], "dstaddr string, domain string"))
    return Inputs.from_frames(spark, flows, dns, dims, resolved, day=day)
