"""Incremental (streaming) ingest picks up only new files and matches the
batch reader; catalog tables discover written partitions."""

import os
import tempfile

from flowlens.sources.catalog import create_empty_table, create_external_table
from flowlens.sources.rawlogs import RAW_FLOW_FIELDS, read_curated, read_flow_logs
from flowlens.streaming.ingest import start_flow_ingest

from .test_ingest import _record, _write


def test_streaming_ingest_is_incremental(spark):
    root = tempfile.mkdtemp(prefix="flowlens-stream-")
    raw, out, ckpt = (os.path.join(root, d) for d in ("raw", "out", "ckpt"))
    _write(raw, "111111111111", "us-east-1", "15", RAW_FLOW_FIELDS, [_record(), _record(bytes="7")], name="a.log.gz")
    q = start_flow_ingest(spark, raw, out, ckpt)
    q.awaitTermination(120)
    assert read_curated(spark, out).count() == 2
    _write(raw, "111111111111", "us-east-1", "16", list(reversed(RAW_FLOW_FIELDS)), [_record(bytes="9")],
           name="b.log.gz")
    q = start_flow_ingest(spark, raw, out, ckpt)
    q.awaitTermination(120)
    cur = read_curated(spark, out)
    assert cur.count() == 3                                   # first file not re-ingested
    assert sorted(r.bytes for r in cur.collect()) == [7, 9, 1500]
    batch = read_flow_logs(spark, f"{raw}/AWSLogs/*/vpcflowlogs/*/2026/02/*/")
    assert sorted(map(tuple, batch.collect()), key=str) == \
        sorted(map(tuple, cur.select(*batch.columns).collect()), key=str)


def test_external_table_and_partition_discovery(spark, inputs):
    from flowlens.sinks.writers import write_partitioned
    out = tempfile.mkdtemp(prefix="flowlens-table-")
    write_partitioned(inputs.flows, out, ["account_id", "region", "year", "month", "day"])
    create_external_table(spark, "curated_flows_t", out)
    assert spark.table("curated_flows_t").count() == inputs.flows.count()
    parts = spark.sql("SHOW PARTITIONS curated_flows_t").count()
    assert parts == inputs.flows.select("account_id", "region", "day").distinct().count()
    assert spark.table("curated_flows_t").where("day = '15'").select("month").first()[0] == "02"
    create_empty_table(spark, "domain_traffic_t", spark.table("curated_flows_t").schema, ["account_id"],
                       location=tempfile.mkdtemp(prefix="flowlens-empty-") + "/t")
    assert spark.table("domain_traffic_t").count() == 0
