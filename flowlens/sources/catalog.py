"""Catalog tables over curated Parquet: external partitioned tables,
partition discovery and empty partitioned targets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.names import quoted
from ..sinks.tables import identifier, literal
from .fixtures import FLOW_COLUMNS, FLOW_PARTITIONS


def _ddl(columns: Sequence[tuple[str, str]]) -> str:
    return ", ".join(f"{quoted(n)} {t}" for n, t in columns)


def create_external_table(spark: SparkSession, name: str, location: str,
                          columns: Sequence[tuple[str, str]] = tuple(FLOW_COLUMNS),
                          partitions: Sequence[str] = tuple(FLOW_PARTITIONS)) -> None:
    """CREATE TABLE ... USING parquet PARTITIONED BY ... LOCATION, then
    discover the partitions already present under ``location``."""
    cols = list(columns) + [(p, "string") for p in partitions if p not in dict(columns)]
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {identifier(name)} ({_ddl(cols)}) USING parquet "
        f"PARTITIONED BY ({', '.join(quoted(p) for p in partitions)}) LOCATION {literal(location)} "
        f"TBLPROPERTIES ('parquet.compression'='SNAPPY')"
    )
    recover_partitions(spark, name)


def recover_partitions(spark: SparkSession, name: str) -> None:
    """Register partitions written by other jobs (MSCK REPAIR TABLE)."""
    spark.sql(f"ALTER TABLE {identifier(name)} RECOVER PARTITIONS")


def partition_statistics(spark: SparkSession, name: str, partitions: Sequence[str] = tuple(FLOW_PARTITIONS)) -> None:
    """Row count and size of every partition, kept in the catalog for the planner."""
    spark.sql(f"ANALYZE TABLE {identifier(name)} PARTITION ({', '.join(quoted(p) for p in partitions)}) COMPUTE STATISTICS")


def create_empty_table(spark: SparkSession, name: str, schema: T.StructType, partitions: Sequence[str],
                       location: str | None = None) -> None:
    """An empty partitioned Parquet table with a fixed schema (the target of
    later appends or partition overwrites)."""
    w = spark.createDataFrame([], schema).write.format("parquet").partitionBy(*partitions).mode("ignore")
    if location:
        w = w.option("path", location)
    w.saveAsTable(name)


def read_address_csv(spark: SparkSession, path, column: str = "dstaddr") -> DataFrame:
    """CSV files with a header (as ``write_csv`` leaves them) -> the distinct
    non-empty addresses of ``column``."""
    rows = spark.read.option("header", "true").csv(path)
    return rows.select(F.trim(F.col(column)).alias(column)).where(F.col(column) != "").distinct()
