"""Raw log ingest edge cases (FIXTURES.md part C), on small hand-written files
in a fresh temporary folder."""

import gzip
import os
import tempfile

from flowlens.sinks.writers import write_partitioned
from flowlens.sources.rawlogs import RAW_FLOW_FIELDS, read_curated, read_dns_logs, read_flow_logs


def _record(**over):
    base = {f: "-" for f in RAW_FLOW_FIELDS}
    base.update({"version": "5", "account-id": "111111111111", "srcaddr": "10.0.0.1", "dstaddr": "8.8.8.8",
                 "srcport": "1234", "dstport": "443", "protocol": "6", "packets": "3", "bytes": "1500",
                 "start": "1771113600", "end": "1771113660", "action": "ACCEPT", "log-status": "OK",
                 "region": "us-east-1", "flow-direction": "egress", "traffic-path": "1"})
    base.update(over)
    return base


def _write(root, account, region, day, fields, records, name="part.log.gz"):
    d = os.path.join(root, "AWSLogs", account, "vpcflowlogs", region, "2026", "02", day)
    os.makedirs(d, exist_ok=True)
    with gzip.open(os.path.join(d, name), "wt") as f:
        f.write(" ".join(fields) + "\n")
        for r in records:
            f.write(" ".join(r[k] for k in fields) + "\n")


def test_header_orders_and_path_precedence(spark):
    root = tempfile.mkdtemp(prefix="flowlens-ingest-")
    _write(root, "111111111111", "us-east-1", "15", RAW_FLOW_FIELDS, [_record()])
    rev = list(reversed(RAW_FLOW_FIELDS))
    _write(root, "222222222222", "eu-west-1", "15", rev,
           [_record(**{"account-id": "999999999999", "bytes": "77", "srcaddr": "10.0.0.2"})])
    df = read_flow_logs(spark, f"{root}/AWSLogs/*/vpcflowlogs/*/2026/02/15/")
    rows = {r.srcaddr: r for r in df.collect()}
    assert rows["10.0.0.1"].bytes == 1500 and rows["10.0.0.2"].bytes == 77
    assert rows["10.0.0.2"].dstaddr == "8.8.8.8" and rows["10.0.0.2"].dstport == 443
    assert rows["10.0.0.2"].account_id == "222222222222"        # path wins
    assert rows["10.0.0.2"].log_account_id == "999999999999"    # record value kept
    assert rows["10.0.0.2"].region == "eu-west-1" and rows["10.0.0.2"].day == "15"
    assert rows["10.0.0.1"].instance_id is None                  # '-' -> NULL
    assert rows["10.0.0.1"].start_time == 1771113600


def test_missing_day_is_empty(spark):
    root = tempfile.mkdtemp(prefix="flowlens-ingest-")
    df = read_flow_logs(spark, f"{root}/AWSLogs/*/vpcflowlogs/*/2026/02/16/")
    assert df.count() == 0 and "bytes" in df.columns


def test_one_silent_account_or_day_hides_nothing(spark):
    from flowlens.sources.rawlogs import dns_log_paths, existing_paths, flow_log_paths
    root = tempfile.mkdtemp(prefix="flowlens-ingest-")
    _write(root, "111111111111", "us-east-1", "15", RAW_FLOW_FIELDS, [_record(), _record()])
    paths = flow_log_paths(root, ("2026", "02", "15"), accounts=["111111111111", "222222222222"])
    assert read_flow_logs(spark, paths).count() == 2
    assert [len(x) for x in existing_paths(spark, paths)] == [1, 1]
    d = os.path.join(root, "AWSLogs", "1", "vpcdnsquerylogs", "vpc-1", "2026", "02", "15")
    os.makedirs(d)
    with open(os.path.join(d, "x.log"), "w") as f:
        f.write('{"account_id":"1","query_name":"a.example"}\n')
    assert read_dns_logs(spark, dns_log_paths(root, [("2026", "02", "15"), ("2026", "02", "16")])).count() == 1
    assert read_dns_logs(spark, dns_log_paths(root, [("2026", "02", "17")])).count() == 0


def test_file_without_header_keeps_its_rows(spark):
    root = tempfile.mkdtemp(prefix="flowlens-ingest-")
    _write(root, "111111111111", "us-east-1", "15", RAW_FLOW_FIELDS, [_record()])
    d = os.path.join(root, "AWSLogs", "222222222222", "vpcflowlogs", "us-east-1", "2026", "02", "15")
    os.makedirs(d)
    with open(os.path.join(d, "bare.log"), "w") as f:
        for k in range(3):
            f.write(" ".join(_record(bytes=str(k))[x] for x in RAW_FLOW_FIELDS) + "\n")
    rows = read_flow_logs(spark, f"{root}/AWSLogs/*/vpcflowlogs/*/2026/02/15/").collect()
    assert sorted(r.bytes for r in rows) == [0, 1, 2, 1500] and {r.dstaddr for r in rows} == {"8.8.8.8"}


def test_rerun_overwrites_only_its_partition(spark):
    root = tempfile.mkdtemp(prefix="flowlens-ingest-")
    out = os.path.join(root, "curated")
    for day in ("15", "16"):
        _write(root, "111111111111", "us-east-1", day, RAW_FLOW_FIELDS, [_record(), _record(bytes="9")])
    both = read_flow_logs(spark, f"{root}/AWSLogs/*/vpcflowlogs/*/2026/02/*/")
    write_partitioned(both, out, ["account_id", "region", "year", "month", "day"])
    _write(root, "111111111111", "us-east-1", "16", RAW_FLOW_FIELDS, [_record(bytes="5")], name="part.log.gz")
    again = read_flow_logs(spark, f"{root}/AWSLogs/*/vpcflowlogs/*/2026/02/16/")
    write_partitioned(again, out, ["account_id", "region", "year", "month", "day"])
    cur = read_curated(spark, out)
    assert cur.where("day = '15'").count() == 2
    assert [r.bytes for r in cur.where("day = '16'").collect()] == [5]
    assert read_curated(spark, out, year=2026, month=2, day=16).count() == 1   # unpadded parameters


def test_dns_answers_shapes(spark):
    root = tempfile.mkdtemp(prefix="flowlens-dns-")
    d = os.path.join(root, "AWSLogs", "111111111111", "vpcdnsquerylogs", "vpc-1", "2026", "02", "15")
    os.makedirs(d)
    lines = [
        '{"account_id":"111111111111","srcaddr":"10.0.0.1","srcport":"53","query_name":"a.example","rcode":"NOERROR","query_timestamp":"2026-02-15T00:00:01Z","query_class":"IN","srcids":{"instance":"i-1"},"answers":[{"Rdata":"1.1.1.1","Type":"A","Class":"IN"}]}',
        '{"account_id":"111111111111","srcaddr":"10.0.0.1","query_name":"b.example","rcode":"NOERROR","answers":[{"Rdata":"1.1.1.1"},{"Rdata":"2.2.2.2"}]}',
        '{"account_id":"111111111111","srcaddr":"10.0.0.1","query_name":"c.example","rcode":"NXDOMAIN","answers":[]}',
        '{"account_id":"111111111111","srcaddr":"10.0.0.1","query_name":"d.example","rcode":"NXDOMAIN"}',
    ]
    with gzip.open(os.path.join(d, "x.log.gz"), "wt") as f:
        f.write("\n".join(lines) + "\n")
    df = read_dns_logs(spark, f"{root}/AWSLogs/*/vpcdnsquerylogs/*/2026/02/15/")
    rows = {r.query_name: r for r in df.collect()}
    assert rows["a.example"].srcids == {"instance": "i-1"} and rows["b.example"].srcids is None
    assert rows["a.example"].query_class == "IN" and rows["a.example"].answers[0].Type == "A" and rows["b.example"].answers[0].Class is None
    assert len(rows["a.example"].answers) == 1 and rows["a.example"].srcport == 53
    assert [a.Rdata for a in rows["b.example"].answers] == ["1.1.1.1", "2.2.2.2"]
    assert rows["c.example"].answers == [] and rows["d.example"].answers is None
    assert rows["a.example"].vpc_id == "vpc-1" and rows["a.example"].account_id == "111111111111"

    from flowlens.operators.dns import dns_daily_summary, explode_answers
    assert explode_answers(df).count() == 3
    assert explode_answers(df, keep_empty=True).count() == 5
    assert dns_daily_summary(df).count() == 3


def test_path_lists_and_dates(spark):
    from flowlens.sources.rawlogs import flow_log_paths, parse_process_date
    assert parse_process_date("2026/2/5") == ("2026", "02", "05")
    assert parse_process_date("20260215") == ("2026", "02", "15")
    root = tempfile.mkdtemp(prefix="flowlens-ingest-")
    for acct in ("111111111111", "222222222222", "333333333333"):
        _write(root, acct, "us-east-1", "15", RAW_FLOW_FIELDS, [_record()])
    paths = flow_log_paths(root, parse_process_date("2026-02-15"), accounts=["111111111111", "333333333333"])
    df = read_flow_logs(spark, paths)
    assert sorted(r.account_id for r in df.collect()) == ["111111111111", "333333333333"]


def test_headers_come_from_a_probe(spark, tmp_path):
    """The plan scans the raw text once; files in two column orders, without a
    header, with blank first lines and of many lines (split) read alike."""
    root = str(tmp_path)
    _write(root, "111111111111", "us-east-1", "15", RAW_FLOW_FIELDS, [_record(bytes=str(k)) for k in range(300)], name="a.log.gz")
    _write(root, "111111111111", "us-east-1", "15", list(reversed(RAW_FLOW_FIELDS)), [_record(bytes="700")], name="b.log.gz")
    folder = os.path.join(root, "AWSLogs/222222222222/vpcflowlogs/us-east-1/2026/02/15")
    os.makedirs(folder)
    order = RAW_FLOW_FIELDS[::2] + RAW_FLOW_FIELDS[1::2]
    rows = [" ".join(_record(bytes=str(1000 + k))[f] for f in order) for k in range(5000)]
    with open(os.path.join(folder, "split.log"), "w") as f:
        f.write("\n  \n" + "\n".join([" ".join(order), *rows]) + "\n")
    with open(os.path.join(folder, "bare.log"), "w") as f:
        f.write(" ".join(_record(bytes="900")[x] for x in RAW_FLOW_FIELDS) + "\n")
    before, cost = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        small = read_flow_logs(spark, f"{root}/AWSLogs/*/vpcflowlogs/*/2026/02/15/")      # searched in a scan of their own
        df = read_flow_logs(spark, f"{root}/AWSLogs/*/vpcflowlogs/*/2026/02/15/", probe_from=0)
        assert sorted(map(tuple, small.collect()), key=str) == sorted(map(tuple, df.collect()), key=str)
        assert df.rdd.getNumPartitions() > 4                 # the large file comes in splits
        assert sorted(r.bytes for r in df.collect()) == [*range(300), 700, 900, *range(1000, 6000)]
        assert {r.dstaddr for r in df.select("dstaddr").distinct().collect()} == {_record()["dstaddr"]}
        plan = df.select("*")._jdf.queryExecution().executedPlan().toString()       # as planned, not run
        assert plan.count("FileScan text") == 1
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert spark.conf.get("spark.sql.files.openCostInBytes") == cost


def test_large_raw_files_are_written_without_a_shuffle(spark, tmp_path, monkeypatch):
    """Small raw files are brought together by partition; files that are large already
    stay apart, with the same rows."""
    from flowlens.plans import etl
    from flowlens.sinks import writers
    from flowlens.sources import rawlogs

    for account in ("111111111111", "222222222222"):
        _write(str(tmp_path), account, "us-east-1", "15", RAW_FLOW_FIELDS, [_record(bytes=str(k)) for k in range(40)])
    paths = f"{tmp_path}/AWSLogs/*/vpcflowlogs/*/2026/02/15/"
    spread, shuffles = writers.spread_for_write, []
    monkeypatch.setattr(writers, "spread_for_write", lambda df, keys: shuffles.append(keys) or spread(df, keys))
    small = sorted(map(tuple, etl.ingest_flow_logs(spark, paths, str(tmp_path / "small")).collect()), key=str)
    assert len(shuffles) == 1 and rawlogs.small_inputs(spark, paths)
    monkeypatch.setattr(etl, "small_inputs", lambda spark, found: rawlogs.small_inputs(spark, found, large=1))
    assert sorted(map(tuple, etl.ingest_flow_logs(spark, paths, str(tmp_path / "large")).collect()), key=str) == small
    assert len(shuffles) == 1 and len(small) == 80
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters", "0") == "0"


def test_generated_code_stays_within_what_the_jvm_compiles(spark):
    from flowlens.session import RUNTIME_CONF

    assert int(RUNTIME_CONF["spark.sql.codegen.hugeMethodLimit"]) <= 8000


def test_lines_are_split_once(spark, tmp_path):
    _write(str(tmp_path), "111111111111", "us-east-1", "15", RAW_FLOW_FIELDS, [_record()])
    plan = read_flow_logs(spark, f"{tmp_path}/AWSLogs/*/vpcflowlogs/*/2026/02/15/", probe_from=0)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(value") == 2        # the data's and the headers'


def test_plain_records_are_told_without_parsing(spark):
    """What the pattern takes has no residue, by the parsed form as well."""
    import re
    from pyspark.sql import functions as F
    from flowlens.sources import rawlogs

    head = '{"account_id":"1","query_name":"a.example"'
    plain = [head + "}", "{}", head + ',"srcport":53,"answers":[{"Rdata":"1.1.1.1","Type":"A","Class":"IN"},{"Rdata":"x"}],"srcids":{"instance":"i-1"}}',
             head + ',"answers":[]}', head + ',"srcids":{}}', head + ',"query_name":"twice"}', '{"query_name":"é日"}',
             '{"answers":[' + ",".join(['{"Rdata":"1.1.1.1"}'] * 5000) + "]}"]
    other = [head + ',"edns":7}', head + ',"answers":[{"Rdata":"1.1.1.1","Ttl":30}]}', head + ',"srcids":{"a":"1","a":"2"}}', head + ',"srcids":{"a":"1","b":"2"}}',
             head + ",}", head, "no json {", '{"query_name":"tab\t"}', '{"query_name":"q\\u0041"}', '{"srcport":053}', '{"answers":[{"Rdata":"1"},]}', "[1]", " {}", head + "} x", '{"firewall":{"a":[1]},"answers":null}']
    assert [bool(re.search(rawlogs.PLAIN_RECORD.replace(r"\z", r"\Z"), x)) for x in plain + other] == [True] * len(plain) + [False] * len(other)
    df = spark.createDataFrame([(x,) for x in plain + other], "value string")
    value = F.col("value")
    fast = df.select(value, F.to_json(rawlogs._residue(value, None)).alias("r")).collect()
    pattern, rawlogs.PLAIN_RECORD = rawlogs.PLAIN_RECORD, "(?!)"
    try:
        assert df.select(value, F.to_json(rawlogs._residue(value, None)).alias("r")).collect() == fast
    finally:
        rawlogs.PLAIN_RECORD = pattern
    assert [r.r for r in fast[:len(plain)]] == [None] * len(plain) and sum(r.r is not None for r in fast) >= 8
