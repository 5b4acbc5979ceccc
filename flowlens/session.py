"""Session helpers: building a local session for tests/bench and pinning the
SQL settings every query relies on.

On a cluster the session is created by the job launcher; ``prepare`` only sets
runtime SQL confs (never static/core confs) so it is safe to call on any
session.
"""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Runtime SQL settings the engine relies on. All of them are modifiable at run
# time, unlike core confs such as spark.serializer (those go on the builder).
RUNTIME_CONF = {
    # every timestamp/hour bucket is computed in UTC
    "spark.sql.session.timeZone": "UTC",
    # partition values such as month='02' must stay strings
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    # re-runs overwrite only the partitions they produce
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # AQE: runtime coalescing, skew splitting, broadcast conversion
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # the JVM never compiles methods beyond 8000 bytes; generated code of that size (wide
    # projections behind a join) runs as small functions instead
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def cluster_conf(input_bytes: int, executor_cores: int = 4, executor_memory_gb: int = 16,
                 target_partition_mb: int = 256) -> dict[str, str]:
    """Settings for a cluster run over ``input_bytes`` of compressed input.

    Shuffle partitions are sized so a partition holds about
    ``target_partition_mb`` of shuffle data (AQE coalesces smaller ones and
    splits skewed ones); scans pack files into ~``target_partition_mb`` splits.
    Static confs (serializer, speculation, memory) belong on spark-submit or
    the builder; the SQL ones can also be set at run time."""
    mb = 1024 * 1024
    partitions = max(200, int(input_bytes // (target_partition_mb * mb)))
    return {
        "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
        "spark.speculation": "true",
        "spark.executor.cores": str(executor_cores),
        "spark.executor.memory": f"{executor_memory_gb}g",
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_mb * mb),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_mb * mb),
        "spark.sql.files.maxPartitionBytes": str(target_partition_mb * mb),
        "spark.sql.files.openCostInBytes": str(8 * mb),
        "spark.sql.autoBroadcastJoinThreshold": str(64 * mb),
        "spark.sql.parquet.compression.codec": "snappy",
        **RUNTIME_CONF,
    }


def prepare(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


@contextmanager
def with_conf(spark: SparkSession, conf: dict[str, str]) -> Iterator[None]:
    """Runtime settings that hold for what is planned in the block."""
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "flowlens") -> SparkSession:
    """Session used by tests and bench (local mode, UI off)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("FLOWLENS_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.serializer", "org.apache.spark.serializer.KryoSerializer")
    )
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return prepare(spark)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    The folder is read from the session (``spark.checkpoint.dir`` or the
    SparkContext). Only when nothing is configured -- local tests -- do we set
    one of our own.
    """
    sc = spark.sparkContext
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        configured = tempfile.mkdtemp(prefix="flowlens-ckpt-")   # local runs only
    sc.setCheckpointDir(configured)
    return sc._jsc.sc().getCheckpointDir().get()


class _Scratch(threading.local):
    """Scratch tables by thread: a job that cleans up after itself leaves the
    tables of jobs in other threads alone."""

    def __init__(self):
        self.paths: list[str] = []


_SCRATCH = _Scratch()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for written tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/flowlens/{name}-{uuid.uuid4().hex[:12]}"
    _SCRATCH.paths.append(path)
    return path


def scratch_mark() -> int:
    return len(_SCRATCH.paths)


def drop_scratch(spark: SparkSession, since: int = 0) -> int:
    """Delete the scratch tables this thread created after ``since`` (a ``scratch_mark``)
    through the Hadoop FileSystem API of the session (works for any shared
    store). Call only once nothing reads them any more."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    dropped = 0
    while len(_SCRATCH.paths) > since:
        p = jvm.org.apache.hadoop.fs.Path(_SCRATCH.paths.pop())
        fs = p.getFileSystem(conf)
        if fs.exists(p):
            fs.delete(p, True)
            dropped += 1
    return dropped


def materialize(df, name: str = "table"):
    """Cut the lineage of a reused intermediate by writing it as a Parquet
    table in the shared checkpoint folder and reading it back: computed once
    (one job), every consumer reads the files, a lost executor re-reads
    instead of recomputing, and the planner sees the real size (so small
    dictionaries are broadcast from the start)."""
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)
