"""End to end through the CLI: raw files -> curated -> daily aggregates read
from curated Parquet and dimension tables (the deployment path)."""

import os
import tempfile

from flowlens.cli import main
from flowlens.plans import daily
from flowlens.plans.inputs import DIM_DIRS
from flowlens.sinks.writers import write_partitioned
from flowlens.sources.rawlogs import RAW_FLOW_FIELDS, read_curated

from .test_ingest import _record, _write


def test_cli_ingest_and_daily(spark, inputs):
    root = tempfile.mkdtemp(prefix="flowlens-cli-")
    raw = os.path.join(root, "raw")
    _write(raw, "111111111111", "us-east-1", "15", RAW_FLOW_FIELDS, [_record(), _record(bytes="10")])
    _write(raw, "111111111111", "us-east-1", "16", RAW_FLOW_FIELDS, [_record()])
    assert main(["ingest-flows", "--raw", raw, "--out", os.path.join(root, "flows"),
                 "--date", "2026/2/15", "2026-02-16"]) == 0
    assert read_curated(spark, os.path.join(root, "flows")).count() == 3

    # deployment layout built from the fixture: curated flows/DNS + dimension folders
    flows_dir, dns_dir, dims_dir = (os.path.join(root, d) for d in ("cflows", "cdns", "dims"))
    write_partitioned(inputs.flows, flows_dir, ["account_id", "region", "year", "month", "day"])
    write_partitioned(inputs.dns, dns_dir, ["account_id", "vpc_id", "year", "month", "day"])
    for attr, folder in DIM_DIRS.items():
        getattr(inputs.dims, attr).write.parquet(os.path.join(dims_dir, folder))
    out = os.path.join(root, "agg")
    assert main(["daily", "--flows", flows_dir, "--dns", dns_dir, "--dims", dims_dir, "--date", "2026-02-15",
                 "--out", out]) == 0
    got = read_curated(spark, os.path.join(out, "total_internet_egress"))
    exp = daily.total_internet_egress(inputs.flows, inputs.dims.ec2)
    cols = exp.columns
    assert sorted(map(tuple, got.select(*cols).collect()), key=str) == sorted(map(tuple, exp.collect()), key=str)


def test_cli_run_and_report(spark, inputs, capsys):
    root = tempfile.mkdtemp(prefix="flowlens-cli-")
    flows_dir, dns_dir, dims_dir = (os.path.join(root, d) for d in ("cflows", "cdns", "dims"))
    write_partitioned(inputs.flows, flows_dir, ["account_id", "region", "year", "month", "day"])
    write_partitioned(inputs.dns, dns_dir, ["account_id", "vpc_id", "year", "month", "day"])
    for attr, folder in DIM_DIRS.items():
        getattr(inputs.dims, attr).write.parquet(os.path.join(dims_dir, folder))
    out = os.path.join(root, "top")
    assert main(["run", "--name", "top_flows_enriched", "--flows", flows_dir, "--dns", dns_dir,
                 "--dims", dims_dir, "--date", "2026-02-15", "--out", out]) == 0
    from flowlens.plans import enrichment as en
    exp = en.top_flows_enriched(en.joined_logs(inputs.flows, inputs.dns, inputs.dims.ec2), inputs.dims)
    assert spark.read.parquet(out).count() == exp.count()
    capsys.readouterr()
    assert main(["report", "--name", "rejected", "--flows", flows_dir, "--date", "2026-02-15", "--limit", "5"]) == 0
    lines = capsys.readouterr().out.strip().splitlines()
    assert len(lines) == 5


def test_cli_profile(spark, inputs, capsys):
    root = tempfile.mkdtemp(prefix="flowlens-cli-")
    flows_dir = os.path.join(root, "cflows")
    write_partitioned(inputs.flows, flows_dir, ["account_id", "region", "year", "month", "day"])
    capsys.readouterr()
    assert main(["profile", "--flows", flows_dir, "--date", "2026-02-15"]) == 0
    out = capsys.readouterr().out.strip().splitlines()
    total = inputs.flows.count()
    assert out[0].startswith(f"total_rows={total}\t")
    assert sum(int(line.rsplit("\t", 1)[1]) for line in out[1:]) == total


def test_cli_run_uses_the_requested_day(spark, inputs):
    from pyspark.sql import functions as F
    root = tempfile.mkdtemp(prefix="flowlens-cli-")
    flows_dir, dns_dir, dims_dir = (os.path.join(root, d) for d in ("cflows", "cdns", "dims"))
    write_partitioned(inputs.flows.withColumn("day", F.lit("16")), flows_dir,
                      ["account_id", "region", "year", "month", "day"])
    write_partitioned(inputs.dns, dns_dir, ["account_id", "vpc_id", "year", "month", "day"])
    for attr, folder in DIM_DIRS.items():
        getattr(inputs.dims, attr).write.parquet(os.path.join(dims_dir, folder))
    out = os.path.join(root, "top16")
    assert main(["run", "--name", "top_flows_enriched", "--flows", flows_dir, "--dns", dns_dir,
                 "--dims", dims_dir, "--date", "2026/02/16", "--out", out]) == 0
    got = spark.read.parquet(out)
    assert got.count() > 0 and {r.day for r in got.select("day").distinct().collect()} == {"16"}
