"""Appends that may be repeated: every batch lands in a folder of its own and
counts once it is committed.

``append_batch`` takes back the batch's commit, if there is one, replaces the batch's
folder and commits again, so a batch that is written twice -- a retry, or a stream
that stopped between its write and its checkpoint -- replaces its own files, and a batch that
broke off is never read. ``read_committed`` reads the folders of committed batches only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from .writers import write_partitioned

BATCH = "ingest_batch"
COMMITS = "_commits"      # Spark's listings leave names with an underscore out


def _file_system(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _named(batch: str) -> str:
    if not batch or not all(c.isalnum() or c == "-" for c in batch):
        raise ValueError(f"batch names are letters, digits and '-': {batch!r}")
    return batch


def _folder(path: str, batch: str) -> str:
    return f"{path.rstrip('/')}/{BATCH}={_named(batch)}"


def _marker(path: str, batch: str) -> str:
    return f"{path.rstrip('/')}/{COMMITS}/{_named(batch)}"


def stage_batch(df: DataFrame, path: str, keys: Sequence[str], batch: str, spread: bool = True) -> None:
    """Writes the batch's folder; it isn't read before ``commit_batch``. ``spread``:
    as in ``write_partitioned``."""
    marker, fs = _file_system(df.sparkSession, _marker(path, batch))
    if fs.exists(marker):
        fs.delete(marker, False)
    write_partitioned(df, _folder(path, batch), keys, spread=spread, overwrite="static")


def commit_batch(spark: SparkSession, path: str, batch: str) -> None:
    marker, fs = _file_system(spark, _marker(path, batch))
    fs.create(marker, True).close()


def append_batch(df: DataFrame, path: str, keys: Sequence[str], batch: str, spread: bool = True) -> None:
    stage_batch(df, path, keys, batch, spread)
    commit_batch(df.sparkSession, path, batch)


def committed_batches(spark: SparkSession, path: str) -> list[str]:
    """Names of the committed batches, in order."""
    folder, fs = _file_system(spark, f"{path.rstrip('/')}/{COMMITS}")
    return sorted(s.getPath().getName() for s in fs.listStatus(folder)) if fs.exists(folder) else []


def read_committed(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The rows of all committed batches; ``schema`` (with the partition columns) is
    that of an empty table while there are none. The column ``ingest_batch`` names the batch."""
    batches = committed_batches(spark, path)
    if not batches:
        return spark.createDataFrame([], f"{schema}, {BATCH} string")
    return spark.read.option("basePath", path).schema(f"{schema}, {BATCH} string").parquet(*[_folder(path, b) for b in batches])
