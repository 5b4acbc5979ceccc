"""Session helpers and the CSV sink."""

import tempfile

from flowlens.session import cluster_conf, drop_scratch, ensure_checkpoint_dir, materialize, scratch_mark, scratch_path
from flowlens.sinks.writers import write_csv


def test_scratch_lives_under_the_session_checkpoint_dir(spark):
    base = ensure_checkpoint_dir(spark)
    assert scratch_path(spark, "x").startswith(base.rstrip("/") + "/flowlens/")


def test_materialize_cuts_lineage_and_drop_scratch_removes_it(spark):
    mark = scratch_mark()
    df = materialize(spark.range(100).withColumnRenamed("id", "v"))
    assert "FileScan parquet" in df._jdf.queryExecution().executedPlan().toString()
    assert df.count() == 100
    assert drop_scratch(spark, mark) == 1


def test_cluster_conf_sizes_partitions():
    c = cluster_conf(100 * 1024**4)
    assert int(c["spark.sql.shuffle.partitions"]) == 409600
    assert c["spark.sql.adaptive.enabled"] == "true"
    assert int(cluster_conf(1024)["spark.sql.shuffle.partitions"]) == 200


def test_write_csv_round_trip(spark, inputs):
    out = tempfile.mkdtemp(prefix="flowlens-csv-") + "/ips"
    src = inputs.flows.select("dstaddr").distinct()
    write_csv(src, out)
    back = spark.read.option("header", "true").csv(out)
    assert back.count() == src.count() and back.columns == ["dstaddr"]


def test_address_csv_feeds_the_reverse_labels(spark, inputs, tmp_path):
    from flowlens.operators.dns import with_reverse_domain
    from flowlens.sources.catalog import read_address_csv

    out = str(tmp_path / "ips")
    src = inputs.flows.select("dstaddr").distinct()
    write_csv(src, out)
    addresses = read_address_csv(spark, out)
    assert sorted(r.dstaddr for r in addresses.collect()) == sorted(r.dstaddr for r in src.collect())
    named = with_reverse_domain(addresses, inputs.resolved, ip="dstaddr", name="reverse")
    assert named.count() == addresses.count()          # several names of an address multiply nothing
    assert named.where("reverse is not null").count() > 0


def test_drop_scratch_leaves_other_threads_alone(spark):
    import threading

    from flowlens.session import drop_scratch, materialize, scratch_mark
    mark, made = scratch_mark(), []
    worker = threading.Thread(target=lambda: made.append(materialize(spark.range(7).toDF("x"))))
    worker.start()
    worker.join()
    own = materialize(spark.range(3).toDF("x"))
    assert own.count() == 3 and drop_scratch(spark, mark) == 1
    assert made[0].count() == 7


def test_rebalanced_write_splits_a_hot_key(spark, tmp_path):
    import os

    from pyspark.sql import functions as F

    from flowlens.sinks.writers import write_partitioned
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        rows = spark.range(100_000, numPartitions=8).select(
            "id", F.sha2(F.col("id").cast("string"), 256).alias("v"), F.when(F.col("id") % 10 == 0, "cold").otherwise("hot").alias("k"))
        write_partitioned(rows, str(tmp_path / "t"), ["k"])
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    assert len([f for f in os.listdir(tmp_path / "t" / "k=hot") if f.endswith(".parquet")]) > 4
    assert spark.read.parquet(str(tmp_path / "t")).count() == 100_000
