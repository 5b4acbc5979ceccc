"""Sinks: partitioned Parquet (idempotent per partition), raw text/JSON
layouts, CSV and JDBC."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import with_conf
from ..sources.rawlogs import MISSING, RAW_HIVE_FLOW_KEYS, raw_name
from ..sources.fixtures import FLOW_COLUMNS, FLOW_PARTITIONS


def spread_for_write(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rebalance by the output partition keys: adaptive execution cuts a hot
    key into pieces of the advisory partition size, measured at run time, and
    joins small ones, so the number of writing tasks follows the bytes of a key."""
    return df.hint("rebalance", *keys)


# unsorted rows are written with up to 64 files open in a task; Spark sorts the rows of further keys
UNSORTED = {"spark.sql.maxConcurrentOutputFileWriters": "64"}
DIRECT_ROWS = 50_000           # rows per file from which a write needs no shuffle
DIRECT_BLOCK = 32 * 1024 ** 2  # bytes that each open Parquet file may hold in memory


def large_files(df: DataFrame, keys: Sequence[str], rows: int = DIRECT_ROWS) -> bool:
    """Whether the tasks of ``df``, as they are, write files of ``rows`` rows on
    average, so that a shuffle by ``keys`` would gain little. Counts the rows of each
    task and key (a pass over the columns that make the keys)."""
    files = df.groupBy(F.spark_partition_id().alias("_task"), *keys).agg(F.count(F.lit(1)).alias("_rows"))
    mean = files.agg(F.avg("_rows")).first()[0]
    return mean is not None and mean >= rows


def write_partitioned(df: DataFrame, path: str, keys: Sequence[str], max_records: int | None = None,
                      sort_by: Sequence[str] | None = None, mode: str = "overwrite", fmt: str = "parquet",
                      spread: bool = True, overwrite: str = "dynamic", **options) -> None:
    """Write ``df`` partitioned by ``keys``. With the dynamic partition-overwrite
    mode a re-run replaces only the partitions it writes. ``spread=False``: the tasks of
    ``df`` write their rows as they come, without a shuffle or sort (for rows that
    already lie in few large pieces per key)."""
    out = spread_for_write(df, keys) if spread else df
    if spread or sort_by:
        out = out.sortWithinPartitions(*(sort_by or keys))
    w = out.write.mode(mode).partitionBy(*keys).option("partitionOverwriteMode", overwrite)
    if max_records:
        w = w.option("maxRecordsPerFile", int(max_records))
    if not spread:
        w = w.option("parquet.block.size", DIRECT_BLOCK)
    for k, v in options.items():
        w = w.option(k, v)
    if spread or sort_by:
        w.format(fmt).save(path)
    else:
        with with_conf(df.sparkSession, UNSORTED):
            w.format(fmt).save(path)


def write_raw_flow_logs(flows: DataFrame, path: str, compression: str = "gzip") -> None:
    """Curated flows back to the raw text format (space separated, header,
    '-' for missing) in the ``hive`` layout. Empty strings cannot be carried by
    the raw format and are written as '-' as well."""
    data = [c for c, _ in FLOW_COLUMNS]
    cols = [F.coalesce(F.nullif(F.col(c).cast("string"), F.lit("")), F.lit(MISSING)) for c in data]
    # a line is one value, its header the name: formatted as 29 fields it takes twice as long
    line = F.concat_ws(" ", *cols).alias(" ".join(map(raw_name, data)))
    keys = [RAW_HIVE_FLOW_KEYS[p] for p in FLOW_PARTITIONS]
    out = flows.select(line, *[F.col(p).alias(RAW_HIVE_FLOW_KEYS[p]) for p in FLOW_PARTITIONS])
    spread = not large_files(out, keys)
    with with_conf(flows.sparkSession, UNSORTED):
        ((spread_for_write(out, keys) if spread else out).write.mode("overwrite").partitionBy(*keys)
            .option("header", "true").option("sep", "\u0001").option("compression", compression)
            .option("quote", "\u0000").option("zlib.compress.level", "BEST_SPEED").csv(path))


def to_path_layout(spark: SparkSession, hive_root: str, root: str, keys: Sequence[str], template: str) -> int:
    """Moves the folders of a ``key=value`` layout to ``root``/``template`` (with
    ``{key}`` places), as log delivery lays them out. Renames only; returns the
    number of folders (one per combination of the keys)."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path
    fs = path(hive_root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    folders = [s.getPath() for s in fs.globStatus(path(hive_root.rstrip("/") + "".join(f"/{k}=*" for k in keys)))]
    for folder in folders:
        values, at = {}, folder
        for key in reversed(keys):
            values[key], at = at.getName().split("=", 1)[1], at.getParent()
        target = path(f"{root.rstrip('/')}/{template.format(**values)}")
        fs.mkdirs(target.getParent())
        if not fs.rename(folder, target):
            raise OSError(f"cannot move {folder} to {target}")
    return len(folders)


def write_raw_dns_logs(dns: DataFrame, path: str, compression: str = "gzip") -> None:
    """Curated DNS rows as JSON lines in the ``hive`` layout
    (account_id/vpc_id/year/month/day directories)."""
    keys = ["account_id", "vpc_id", "year", "month", "day"]
    with with_conf(dns.sparkSession, UNSORTED):
        (dns.write.mode("overwrite").partitionBy(*keys).option("compression", compression)
            .option("ignoreNullFields", "true").option("zlib.compress.level", "BEST_SPEED").json(path))


def write_csv(df: DataFrame, path: str, header: bool = True, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", str(header).lower()).csv(path)


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict, num_writers: int = 10,
               batch_size: int = 50000, mode: str = "append") -> None:
    """Row sink to a database through Spark's JDBC writer: ``num_writers``
    concurrent connections, ``batch_size`` rows per batch, one transaction per
    task (a failed task is retried as a whole). ``repartition`` (not
    ``coalesce``) keeps the upstream stage at full parallelism. Overwrite a
    day by deleting it first on the database side; append is not idempotent."""
    props = dict(properties)
    props.setdefault("batchsize", str(batch_size))
    props.setdefault("isolationLevel", "READ_COMMITTED")
    df.repartition(num_writers).write.mode(mode).jdbc(url, table, properties=props)
