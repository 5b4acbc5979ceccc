"""Command line jobs.

    python -m flowlens.cli ingest-flows --raw s3://raw --out s3://curated/flows --date 2026/02/15 [--accounts A B]
    python -m flowlens.cli ingest-dns   --raw s3://raw --out s3://curated/dns --date 2026/02/15 2026/02/16 ...
    python -m flowlens.cli daily --flows ... --dns ... --dims ... --date 2026/02/15 --out s3://aggregates
    python -m flowlens.cli run --name top_flows_enriched --flows ... --dns ... --dims ... --date ... --out ...
    python -m flowlens.cli profile --flows s3://curated/flows [--date 2026/02/15]
    python -m flowlens.cli report --name rejected --flows ... --date 2026-02-15 [--action REJECT]
                                  [--service S3] [--ip 10.0.1.5] [--limit 20]

The session comes from the launcher (spark-submit); ``--master`` is for local
runs only.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from .plans.etl import DNS_FILE_RECORDS, FLOW_FILE_RECORDS
from .plans import reports as rp
from .plans.daily import profile_counts, profile_rows_per_file
from .plans.inputs import load_curated
from .plans.registry import PLANS
from .plans.job import run_daily_job
from .session import drop_scratch, prepare, scratch_mark
from .sinks.writers import write_partitioned
from .sources.fixtures import DNS_PARTITIONS, FLOW_PARTITIONS
from .plans.reports import report_source
from .sources.rawlogs import (dns_log_paths, flow_log_paths, parse_process_date, read_curated, read_dns_logs,
                              read_flow_logs)

REPORTS = {
    "traffic_by_hour": rp.report_traffic_by_hour,
    "top_services": rp.report_top_services,
    "flow_edges": rp.report_flow_edges,
    "rejected": rp.report_rejected,
}


def _session(master: str | None) -> SparkSession:
    builder = SparkSession.builder.appName("flowlens")
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false")
    return prepare(builder.getOrCreate())


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="flowlens")
    ap.add_argument("--master")
    sub = ap.add_subparsers(dest="cmd", required=True)
    for name in ("ingest-flows", "ingest-dns"):
        p = sub.add_parser(name)
        p.add_argument("--raw", required=True)
        p.add_argument("--out", required=True)
        p.add_argument("--date", required=True, nargs="+", help="one or more days")
        p.add_argument("--accounts", nargs="*")
    for name in ("daily", "run"):
        p = sub.add_parser(name)
        for a in ("--flows", "--dns", "--dims", "--out"):
            p.add_argument(a, required=True)
        p.add_argument("--date", required=True)
        p.add_argument("--resolved")
        if name == "run":
            p.add_argument("--name", required=True)
    p = sub.add_parser("profile")
    p.add_argument("--flows", required=True)
    p.add_argument("--date")
    p = sub.add_parser("report")
    p.add_argument("--name", required=True, choices=sorted(REPORTS))
    p.add_argument("--flows", required=True)
    p.add_argument("--date", required=True)
    p.add_argument("--action")
    p.add_argument("--service")
    p.add_argument("--ip")
    p.add_argument("--limit", type=int, default=20)
    args = ap.parse_args(argv)

    spark = _session(args.master)
    if args.cmd.startswith("ingest"):
        days = [parse_process_date(d) for d in args.date]
        if args.cmd == "ingest-flows":
            paths = [p for day in days for p in flow_log_paths(args.raw, day, args.accounts)]
            write_partitioned(read_flow_logs(spark, paths), args.out, FLOW_PARTITIONS, max_records=FLOW_FILE_RECORDS)
        else:
            df = read_dns_logs(spark, dns_log_paths(args.raw, days, args.accounts))
            write_partitioned(df, args.out, DNS_PARTITIONS, max_records=DNS_FILE_RECORDS)
        return 0
    if args.cmd == "profile":
        y, m, d = parse_process_date(args.date) if args.date else (None, None, None)
        flows = read_curated(spark, args.flows, y, m, d)
        counts = profile_counts(flows).first()
        print("\t".join(f"{k}={v}" for k, v in counts.asDict().items()))
        for row in profile_rows_per_file(flows).orderBy("file_path").collect():   # one row per file
            print(f"{row.file_path}\t{row.rows_per_file}")
        return 0
    day = parse_process_date(args.date)
    if args.cmd == "daily":
        inputs = load_curated(spark, args.flows, args.dns, args.dims, day, resolved_path=args.resolved)
        run_daily_job(spark, inputs, args.out, day)
    elif args.cmd == "run":
        inputs = load_curated(spark, args.flows, args.dns, args.dims, day, resolved_path=args.resolved)
        mark = scratch_mark()
        try:
            PLANS[args.name](inputs).write.mode("overwrite").parquet(args.out)
        finally:
            drop_scratch(spark, mark)
    else:
        y, m, d = day
        src = report_source(read_curated(spark, args.flows, y, m, d))
        flt = dict(date=f"{y}-{m}-{d}", action=args.action, service=args.service, ip=args.ip)
        fn = REPORTS[args.name]
        df = fn(src, **flt) if args.name in ("traffic_by_hour", "top_services") else fn(src, args.limit, **flt)
        for row in df.collect():      # a top-k report: at most ``limit`` rows
            print("\t".join("" if v is None else str(v) for v in row))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
