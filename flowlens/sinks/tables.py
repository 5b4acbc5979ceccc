"""Create-or-replace of catalog tables from a query, staged: the rows are written
to a new version folder, and only then does the name point to them -- one catalog
operation, so readers see the old table or the new one and a failed run changes nothing."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ..functions.names import quoted


def identifier(name: str) -> str:
    """``db.table`` or ``table`` as Spark reads it back."""
    return ".".join(quoted(p) for p in name.split("."))


def literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def create_or_replace_table(df: DataFrame, name: str, root: str, partitions: tuple[str, ...] = (), keep: int = 2) -> str:
    """``name`` as the rows of ``df``; returns the version's folder. The newest
    ``keep`` versions stay (readers that began before the switch still read theirs);
    re-running leaves one copy of the rows in the table."""
    spark = df.sparkSession
    folder = f"{root.rstrip('/')}/{name}"
    version = f"{folder}/v-{uuid.uuid4().hex}"
    writer = df.write.mode("errorifexists")
    (writer.partitionBy(*partitions) if partitions else writer).parquet(version)
    spark.sql(f"CREATE OR REPLACE VIEW {identifier(name)} AS SELECT * FROM parquet.{quoted(version)}")
    _drop_older(spark, folder, version, keep)
    return version


def _drop_older(spark: SparkSession, folder: str, version: str, keep: int) -> None:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(folder)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    whole = lambda path: fs.exists(jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS"))  # noqa: E731  (others may be being written)
    known = [(s.getModificationTime(), s.getPath()) for s in fs.listStatus(p) if s.getPath().getName().startswith("v-") and whole(s.getPath())]
    others = sorted((k for k in known if k[1].getName() != version.rsplit("/", 1)[1]), key=lambda k: k[0], reverse=True)
    for _, path in others[max(0, keep - 1):]:
        fs.delete(path, True)
