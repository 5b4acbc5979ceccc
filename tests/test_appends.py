"""Repeatable appends, staged create-or-replace, catalog read path, runtime
partition pruning, column profile and the residue of unknown fields."""

import json
import os

import pytest
from pyspark.sql import functions as F

from flowlens.plans import daily, etl
from flowlens.sinks.appends import BATCH, append_batch, commit_batch, committed_batches, read_committed, stage_batch
from flowlens.sinks.tables import create_or_replace_table
from flowlens.sinks.writers import write_partitioned
from flowlens.sources import rawlogs
from flowlens.sources.catalog import create_external_table, partition_statistics
from flowlens.sources.rawlogs import RAW_FLOW_FIELDS, read_dns_logs
from flowlens.streaming import ingest

from .conftest import SMALL
from .test_ingest import _record, _write

DDL = "id long, k string"


def ids(df):
    return sorted(r.id for r in df.collect())


def test_a_repeated_batch_replaces_itself(spark, tmp_path):
    path = str(tmp_path / "t")
    assert ids(read_committed(spark, path, DDL)) == []
    rows = lambda *i: spark.createDataFrame([(x, f"k{x % 2}") for x in i], DDL)
    append_batch(rows(1, 2, 3), path, ["k"], "a")
    append_batch(rows(4, 5), path, ["k"], "b")
    append_batch(rows(4, 5), path, ["k"], "b")
    assert ids(read_committed(spark, path, DDL)) == [1, 2, 3, 4, 5]
    append_batch(rows(6), path, ["k"], "b")               # other rows and fewer partitions than before
    assert ids(read_committed(spark, path, DDL)) == [1, 2, 3, 6]
    stage_batch(rows(7), path, ["k"], "c")                # written, not committed
    assert ids(read_committed(spark, path, DDL)) == [1, 2, 3, 6] and committed_batches(spark, path) == ["a", "b"]
    stage_batch(rows(8), path, ["k"], "b")                # a repeat that broke off hides its batch rather than half of it
    assert ids(read_committed(spark, path, DDL)) == [1, 2, 3]
    commit_batch(spark, path, "b")
    assert {(r.id, r[BATCH]) for r in read_committed(spark, path, DDL).collect()} == {(1, "a"), (2, "a"), (3, "a"), (8, "b")}
    for name in ("", "a/b", "x=y"):
        with pytest.raises(ValueError):
            append_batch(rows(1), path, ["k"], name)


def test_stream_that_stops_between_write_and_checkpoint(spark, tmp_path, monkeypatch):
    """The batch is written and committed, then the stream breaks before its own
    checkpoint: after the restart no row is doubled."""
    raw, out, ckpt = (str(tmp_path / d) for d in ("raw", "out", "ckpt"))
    _write(raw, "111111111111", "us-east-1", "15", RAW_FLOW_FIELDS, [_record(), _record(bytes="7")], name="a.log.gz")
    whole = ingest.append_batch

    def broken(*a, **k):
        whole(*a, **k)
        raise RuntimeError("stopped after the write")
    monkeypatch.setattr(ingest, "append_batch", broken)
    with pytest.raises(Exception, match="stopped after the write"):
        ingest.start_flow_ingest(spark, raw, out, ckpt).awaitTermination(120)
    schema = rawlogs.flow_schema_ddl()
    assert read_committed(spark, out, schema).count() == 2
    monkeypatch.setattr(ingest, "append_batch", whole)
    ingest.start_flow_ingest(spark, raw, out, ckpt).awaitTermination(120)
    assert sorted(r.bytes for r in read_committed(spark, out, schema).collect()) == [7, 1500]
    _write(raw, "111111111111", "us-east-1", "16", RAW_FLOW_FIELDS, [_record(bytes="9")], name="b.log.gz")
    ingest.start_flow_ingest(spark, raw, out, ckpt).awaitTermination(120)
    assert sorted(r.bytes for r in read_committed(spark, out, schema).collect()) == [7, 9, 1500]
    assert len(committed_batches(spark, out)) == 2
    # another stream into the same table has batch numbers of its own
    raw2 = str(tmp_path / "raw2")
    _write(raw2, "111111111111", "us-east-1", "16", RAW_FLOW_FIELDS, [_record(bytes="11")], name="c.log.gz")
    ingest.start_flow_ingest(spark, raw2, out, str(tmp_path / "ckpt2")).awaitTermination(120)
    assert sorted(r.bytes for r in read_committed(spark, out, schema).collect()) == [7, 9, 11, 1500]


def test_create_or_replace_is_one_switch(spark, tmp_path):
    root, name = str(tmp_path), "replaced_t"
    one = create_or_replace_table(spark.range(5), name, root)
    before = spark.table(name)
    assert before.count() == 5
    with pytest.raises(Exception):                        # a run that fails leaves the table as it is
        create_or_replace_table(spark.range(9).select(F.raise_error(F.lit("no"))), name, root)
    assert spark.table(name).count() == 5
    two = create_or_replace_table(spark.range(7).selectExpr("id", "id % 2 as p"), name, root, ("p",))
    assert spark.table(name).count() == 7 and before.count() == 5      # who began before still reads the old one
    assert "PartitionFilters: [isnotnull(p" in spark.table(name).where("p = 1")._jdf.queryExecution().executedPlan().toString()
    create_or_replace_table(spark.range(3), name, root)
    left = {d for d in os.listdir(f"{root}/{name}") if os.path.exists(f"{root}/{name}/{d}/_SUCCESS")}
    assert spark.table(name).count() == 3 and os.path.basename(one) not in left and os.path.basename(two) in left
    spark.sql(f"DROP VIEW {name}")


def test_catalog_reads_prune_partitions(spark, inputs, tmp_path):
    path = str(tmp_path / "it's a folder")
    write_partitioned(inputs.flows, path, ["account_id", "region", "year", "month", "day"])
    create_external_table(spark, "catalog_t", path)
    partition_statistics(spark, "catalog_t")
    some = spark.table("catalog_t").where("account_id = '000000000001' and region = 'us-east-1'")
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(account_id" in plan
    assert 0 < len(some.inputFiles()) < len(spark.table("catalog_t").inputFiles())
    described = spark.sql("DESCRIBE EXTENDED catalog_t PARTITION (account_id='000000000001', region='us-east-1', year='2026', month='02', day='15')")
    statistics = [r.data_type for r in described.collect() if r.col_name == "Partition Statistics"]
    assert statistics and f"{some.count()} rows" in statistics[0]
    spark.sql("DROP TABLE catalog_t")


def test_allow_list_prunes_while_the_query_runs(spark):
    df = etl.allowed_account_totals(spark, SMALL)
    assert "dynamicpruning" in df._jdf.queryExecution().executedPlan().toString()
    listed = etl.curated_days(spark, SMALL).where(F.col("account_id").isin("000000000001", "000000000003")).groupBy("account_id", "day").agg(
        F.count(F.lit(1)).alias("n_flows"), F.sum("bytes").alias("total_bytes"))
    names = {r.account_id: r.account_name for r in etl.fixtures.ec2_details(spark, SMALL).select("account_id", "account_name").distinct().collect()}
    assert {a for a, n in names.items() if n in ("acct-1", "acct-3")} == {"000000000001", "000000000003"}
    assert sorted(map(tuple, df.collect())) == sorted(map(tuple, listed.collect()))


def test_column_profile(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, 5.0, None), (3, None, None)], "a int, `b.c` double, d string")
    assert [tuple(r) for r in daily.profile_columns(df).orderBy("position").collect()] == [
        (1, "a", "int", 3, 3), (2, "b.c", "double", 3, 1), (3, "d", "string", 3, 1)]
    assert [r.n_rows for r in daily.profile_columns(df.limit(0)).collect()] == [0, 0, 0]


def test_unknown_fields_are_kept(spark, tmp_path):
    folder = tmp_path / "AWSLogs/111111111111/vpcdnsquerylogs/vpc-1/2026/02/15"
    folder.mkdir(parents=True)
    plain = {"account_id": "1", "query_name": "a.example", "answers": [{"Rdata": "9.9.9.9", "Type": "A", "Class": "IN"}], "srcids": {"instance": "i-1", "other": "x"}}
    lines = [plain, plain | {"firewall_rule": {"action": "BLOCK", "ids": [1, 2]}, "edns": 7}, plain | {"answers": [{"Rdata": "1.1.1.1", "Ttl": 30}]}]
    (folder / "a.log").write_text("\n".join([*map(json.dumps, lines), "no json {", ""]) + "\n")
    out = str(tmp_path / "curated")
    got = etl.ingest_dns_logs(spark, str(folder), out)
    rows = [tuple(r) for r in got.select(
        "query_name", F.to_json("residue").alias("residue"), F.try_variant_get("residue", "$.firewall_rule.ids[1]", "int").alias("second"),
        F.try_variant_get("residue", "$.answers[0].Ttl", "int").alias("ttl")).collect()]
    assert len(rows) == 4
    assert ("a.example", None, None, None) in rows
    assert [json.loads(r[1]) for r in rows if r[2] == 2] == [{"firewall_rule": {"action": "BLOCK", "ids": [1, 2]}, "edns": 7}]
    assert [json.loads(r[1]) for r in rows if r[3] == 30] == [{"answers": [{"Rdata": "1.1.1.1", "Ttl": 30}]}]
    assert [json.loads(r[1]) for r in rows if r[0] is None] == [{"malformed": "no json {"}]
    assert read_dns_logs(spark, str(tmp_path / "missing")).schema == read_dns_logs(spark, str(folder)).schema


def test_batches_of_large_pieces_are_written_without_a_shuffle(spark, tmp_path, monkeypatch):
    from flowlens.sinks import writers

    rows = spark.range(0, 4000, 1, 2).select(F.col("id"), (F.col("id") % 3).cast("string").alias("k"), F.when(F.col("id") % 5 > 0, "d").alias("d"))
    assert writers.large_files(rows, ["k", "d"], 300) and not writers.large_files(rows, ["k", "d"], 400)      # 12 files
    assert not writers.large_files(rows.limit(0), ["k", "d"], 1)
    seen, spread = [], writers.spread_for_write
    monkeypatch.setattr(writers, "spread_for_write", lambda df, keys: seen.append(keys) or spread(df, keys))
    for k, flag in enumerate((True, False)):
        for _ in range(2):       # the repeated batch replaces itself
            append_batch(rows, str(tmp_path / str(k)), ["k", "d"], "b-1", spread=flag)
    assert len(seen) == 2
    read = [sorted(map(tuple, read_committed(spark, str(tmp_path / str(k)), "id long, k string, d string").collect()), key=str) for k in (0, 1)]
    assert read[0] == read[1] and len(read[0]) == 4000
