"""Raw log readers and the normalisation into the curated schema.

Flow logs: space-separated text with a header line per file, ``-`` for
missing values, usually gzip. Each file may order its columns differently, so
lines are read as text and every value is looked up by name in *its own
file's* header (header table broadcast; it has one row per input file, a
bound known from the file listing). No column can be silently swapped. The headers come from a
probe that reads the beginning of each file and stops, so the data are scanned once;
files too small to be worth a task each are searched in a scan of their own.

DNS logs: JSON lines read with an explicit schema (no inference pass). What a
record holds beside the schema -- new fields, answers with further fields, lines that aren't
JSON -- is kept in the VARIANT column ``residue``.

Path layouts: ``aws`` (``.../AWSLogs/<account>/vpcflowlogs/<region>/<yyyy>/<mm>/<dd>/file``
and ``.../AWSLogs/<account>/vpcdnsquerylogs/<vpc>/<yyyy>/<mm>/<dd>/file``) or
``hive`` (``key=value`` directories, discovered by Spark).
"""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize, with_conf
from .fixtures import FLOW_COLUMNS, FLOW_PARTITIONS

log = logging.getLogger(__name__)

# The raw flow-log field names in the default record format,
# and the renames from raw names to curated names.
RAW_FLOW_FIELDS = [
    "version", "account-id", "interface-id", "srcaddr", "dstaddr", "srcport", "dstport", "protocol",
    "packets", "bytes", "start", "end", "action", "log-status", "vpc-id", "subnet-id", "instance-id",
    "tcp-flags", "type", "pkt-srcaddr", "pkt-dstaddr", "region", "az-id", "sublocation-type",
    "sublocation-id", "pkt-src-aws-service", "pkt-dst-aws-service", "flow-direction", "traffic-path",
]
RESERVED_RENAMES = {"start": "start_time", "end": "end_time"}
# raw columns that collide with the path-derived partition columns
PATH_COLLISIONS = {"account_id": "log_account_id", "region": "log_region"}
MISSING = "-"
MAX_HEADER_BYTES = 1024

# hive-layout directory names of raw flow logs (the record itself has a
# "region" field, so the directory uses another name)
RAW_HIVE_FLOW_KEYS = {"account_id": "account_id", "region": "path_region", "year": "year", "month": "month", "day": "day"}

FLOW_PATH_RE = r"AWSLogs/([^/]+)/vpcflowlogs/([^/]+)/(\d{4})/(\d{1,2})/(\d{1,2})/"
DNS_PATH_RE = r"AWSLogs/([^/]+)/vpcdnsquerylogs/([^/]+)/(\d{4})/(\d{1,2})/(\d{1,2})/"

RAW_DNS_SCHEMA = T.StructType([
    T.StructField("version", T.StringType()),
    T.StructField("account_id", T.StringType()),
    T.StructField("region", T.StringType()),
    T.StructField("vpc_id", T.StringType()),
    T.StructField("query_timestamp", T.StringType()),
    T.StructField("query_name", T.StringType()),
    T.StructField("query_type", T.StringType()),
    T.StructField("query_class", T.StringType()),
    T.StructField("rcode", T.StringType()),
    T.StructField("answers", T.ArrayType(T.StructType([
        T.StructField("Rdata", T.StringType()),
        T.StructField("Type", T.StringType()),
        T.StructField("Class", T.StringType()),
    ]))),
    T.StructField("srcaddr", T.StringType()),
    T.StructField("srcport", T.StringType()),
    T.StructField("transport", T.StringType()),
    # which source asked: names such as "instance" to ids
    T.StructField("srcids", T.MapType(T.StringType(), T.StringType())),
])
DNS_CURATED = [
    "account_id", "region", "vpc_id", "srcaddr", "srcport", "srcids", "query_name", "query_type", "query_class",
    "query_timestamp", "answers", "rcode", "transport", "version", "residue", "year", "month", "day",
]


def parse_process_date(text: str) -> tuple[str, str, str]:
    """Job date parameter ('2026/02/15', '2026-2-15', '20260215') ->
    zero-padded (year, month, day) partition strings."""
    digits = [p for p in text.replace("-", "/").split("/") if p]
    if len(digits) == 1 and len(digits[0]) == 8:
        digits = [digits[0][:4], digits[0][4:6], digits[0][6:]]
    if len(digits) != 3:
        raise ValueError(f"not a date: {text!r}")
    y, m, d = digits
    return y.zfill(4), m.zfill(2), d.zfill(2)


def flow_log_paths(root: str, day: tuple[str, str, str], accounts=None, regions=None) -> list[str]:
    """Input globs of one day in the aws layout: one per listed account (so
    other accounts' prefixes are never listed), or a wildcard."""
    y, m, d = day
    accts = list(accounts) if accounts else ["*"]
    regs = list(regions) if regions else ["*"]
    return [f"{root.rstrip('/')}/AWSLogs/{a}/vpcflowlogs/{r}/{y}/{m}/{d}/" for a in accts for r in regs]


def dns_log_paths(root: str, days, accounts=None, vpcs=None) -> list[str]:
    accts = list(accounts) if accounts else ["*"]
    vs = list(vpcs) if vpcs else ["*"]
    return [f"{root.rstrip('/')}/AWSLogs/{a}/vpcdnsquerylogs/{v}/{y}/{m}/{d}/"
            for (y, m, d) in days for a in accts for v in vs]


def curated_name(raw: str) -> str:
    name = raw.replace("-", "_").lower()
    name = RESERVED_RENAMES.get(name, name)
    return PATH_COLLISIONS.get(name, name)


def raw_name(curated: str) -> str:
    inverse = {v: k for k, v in PATH_COLLISIONS.items()}
    inverse.update({v: k for k, v in RESERVED_RENAMES.items()})
    return inverse.get(curated, curated).replace("_", "-")


def _empty(spark: SparkSession, ddl: str) -> DataFrame:
    return spark.createDataFrame([], ddl)


def _path_parts(layout: str, pattern: str, names: list[str], hive_names: dict | None = None,
                path: Column | None = None) -> dict[str, Column]:
    if layout == "hive":
        hive_names = hive_names or {}
        return {n: F.col(hive_names.get(n, n)) for n in names}
    if layout != "aws":
        raise ValueError(f"unknown layout {layout!r}")
    path = F.col("_metadata.file_path") if path is None else path
    parts = {n: F.regexp_extract(path, pattern, i + 1) for i, n in enumerate(names)}
    for n in ("month", "day"):
        if n in parts:
            parts[n] = F.lpad(parts[n], 2, "0")
    return {n: F.when(c != "", c) for n, c in parts.items()}


def flow_schema_ddl() -> str:
    cols = FLOW_COLUMNS + [(p, "string") for p in FLOW_PARTITIONS]
    return ", ".join(f"{n} {t}" for n, t in cols)


def existing_paths(spark: SparkSession, paths) -> tuple[list[str], list[str]]:
    """(paths or globs that match something, those that don't), resolved one by
    one through the Hadoop FileSystem API of the session: one silent account or
    day must not hide the others."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    found, missing = [], []
    for path in [paths] if isinstance(paths, str) else list(paths):
        p = jvm.org.apache.hadoop.fs.Path(path)
        matches = p.getFileSystem(conf).globStatus(p)
        (found if matches is not None and len(matches) else missing).append(path)
    return found, missing


def _report(missing: list[str]) -> None:
    if missing:
        log.warning("no input at %d of the listed paths: %s", len(missing), ", ".join(missing))


LARGE_FILE = 1 << 20      # bytes


def _files(lines: DataFrame) -> tuple[int, int]:
    """(number, bytes) of the files behind a plain scan; the list stays in the JVM."""
    return len(lines._jdf.inputFiles()), int(str(lines._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def small_inputs(spark: SparkSession, paths, large: int = LARGE_FILE) -> bool:
    """Whether the raw files have less than ``large`` bytes on average, so that their rows are worth
    bringing together by partition. A raw file's rows all belong to the partition its
    folder names, so written as they are they make no more files than came in."""
    found, _ = existing_paths(spark, paths)
    n_files, size = _files(spark.read.text(found)) if found else (0, 0)
    return size < large * n_files or not n_files


def read_flow_logs(spark: SparkSession, paths, layout: str = "aws", default_fields: list[str] | None = None,
                   probe_from: int = LARGE_FILE) -> DataFrame:
    """Raw flow-log text -> curated columns (typed, '-' -> NULL, raw account
    and region kept as log_account_id/log_region, partitions from the path).
    Listed paths without input are reported and left out; if none has any, the
    result is an empty frame with the curated schema. Files without a header line
    are read in the order of ``default_fields`` (default: ``RAW_FLOW_FIELDS``).
    Headers are probed file by file if the files have ``probe_from`` bytes on average."""
    found, missing = existing_paths(spark, paths)
    _report(missing)
    if not found:
        return _empty(spark, flow_schema_ddl())
    lines = spark.read.text(found)
    n_files, size = _files(lines)
    if n_files == 0:
        return _empty(spark, flow_schema_ddl())
    path_cols = [RAW_HIVE_FLOW_KEYS[c] for c in FLOW_PARTITIONS if layout == "hive"]
    staged = lines.select(F.col("_metadata.file_path").alias("_file"), "value", *path_cols)
    return normalize_lines(staged, layout, n_files, default_fields, first_lines(spark, found) if size >= probe_from * n_files else None)


# one task per file, which hands over a few rows at a time
PROBE_CONF = {"spark.sql.files.openCostInBytes": str(1 << 40), "spark.sql.execution.arrow.maxRecordsPerBatch": "16"}


def _first_line(batches):
    """The first line that isn't blank, if the split begins its file; the rest is
    left unread, which ends the task."""
    for b in batches:
        for k, (start, value) in enumerate(zip(b.column("start").to_pylist(), b.column("value").to_pylist())):
            if start:
                return
            if value.strip():
                yield b.slice(k, 1)
                return


def first_lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(_file, value): the first line of every file, written once. Each file
    is opened and read up to its first rows."""
    with with_conf(spark, PROBE_CONF):
        lines = spark.read.text(paths).select(
            F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("start"), "value")
        return materialize(lines.mapInArrow(_first_line, "_file string, start long, value string"), "headers").select("_file", "value")


def normalize_lines(staged: DataFrame, layout: str, n_files: int | None, default_fields: list[str] | None = None,
                    first: DataFrame | None = None) -> DataFrame:
    """Lines (``_file``, ``value`` and, for the hive layout, the directory
    columns) -> curated flow columns. ``first``: the first line of each file (else
    headers are looked for in all lines). ``n_files`` bounds the per-file header
    table (one row per file); it is broadcast when the bound is small."""
    # lines are chosen by their text, so that each is split once
    value, words = F.col("value"), F.concat(F.lit(" "), "value", F.lit(" "))
    is_header = value.contains("srcaddr") & words.contains(" srcaddr ") & words.contains(" dstaddr ")
    full = staged.where((value != "") & ~value.startswith(" "))
    # one row per file: the 0-based position of every curated column in that
    # file's header (-1 when the file does not carry it)
    names = [c for c, _ in FLOW_COLUMNS]
    heads = full if first is None else first
    headers = heads.where(is_header).select("_file", F.split("value", " ").alias("_tok")).groupBy("_file").agg(F.min("_tok").alias("_hdr")).select(
        "_file",
        F.struct(*[(F.array_position("_hdr", raw_name(c)).cast("int") - 1).alias(c) for c in names]).alias("_pos"),
    )
    if n_files is not None and n_files * MAX_HEADER_BYTES <= 256 * 1024 * 1024:
        headers = F.broadcast(headers)
    # a file without a header keeps its rows: they are read in the default order
    order = list(default_fields or RAW_FLOW_FIELDS)
    default = F.struct(*[F.lit(order.index(raw_name(c)) if raw_name(c) in order else -1).alias(c) for c in names])
    others = [c for c in staged.columns if c not in ("_file", "value")]
    tok = full.where(~is_header).select("_file", F.split("value", " ").alias("_tok"), *others)
    data = tok.join(headers, "_file", "left").withColumn("_pos", F.coalesce("_pos", default))
    parts = _path_parts(layout, FLOW_PATH_RE, FLOW_PARTITIONS, RAW_HIVE_FLOW_KEYS, path=F.col("_file"))
    cols = []
    for name, dtype in FLOW_COLUMNS:
        v = F.nullif(F.get(F.col("_tok"), F.col(f"_pos.{name}")), F.lit(MISSING))
        cols.append((v if dtype == "string" else v.try_cast(dtype)).alias(name))
    return data.select(*cols, *[parts[p].alias(p) for p in FLOW_PARTITIONS])


def _plain_record() -> str:
    """A pattern of JSON objects that hold nothing beside ``RAW_DNS_SCHEMA``: its text fields as strings
    without escapes or as whole numbers, answers of its fields in order, at most one source
    id. Lines of any other form may still hold nothing else."""
    text = r'"[^"\\\x00-\x1F]*+"'
    plain = [f.name for f in RAW_DNS_SCHEMA if isinstance(f.dataType, T.StringType)]
    rdata, *more = [f.name for f in RAW_DNS_SCHEMA["answers"].dataType.elementType]
    answer = rf'\{{"{rdata}":{text}' + "".join(rf'(?:,"{m}":{text})?+' for m in more) + r"\}"
    member = "|".join([
        rf'"(?:{"|".join(plain)})":(?:{text}|-?(?:0|[1-9][0-9]{{0,17}}+))',
        rf'"answers":\[(?:{answer}(?:,(?=\{{)|(?=\])))*+\]',
        rf'"srcids":\{{(?:{text}:{text})?+\}}'])
    return rf'\A\{{(?:(?:{member})(?:,(?=")|(?=\}})))*+\}}\z'


PLAIN_RECORD = _plain_record()
PLAIN_BYTES = 1 << 20


def _residue(line: Column, fields: Column) -> Column:
    """What a record holds beside ``RAW_DNS_SCHEMA``, as one VARIANT object (NULL: nothing):
    unknown fields, ``answers`` whole if an answer has unknown fields, and under
    ``malformed`` a line that is no JSON object. Records that a pattern tells to hold nothing else aren't parsed for it."""
    plain = (F.octet_length(line) <= PLAIN_BYTES) & line.rlike(PLAIN_RECORD)
    known = [f.name for f in RAW_DNS_SCHEMA]
    answer = [f.name for f in RAW_DNS_SCHEMA["answers"].dataType.elementType]
    every = F.from_json(line, "map<string,variant>")
    of_answers = F.from_json(F.get_json_object(line, "$.answers"), "array<map<string,variant>>")
    odd_answer = F.exists(of_answers, lambda a: F.size(F.array_except(F.map_keys(a), F.array(*map(F.lit, answer)))) > 0)
    once = lambda c, use: F.transform(F.array(c), use)[0]  # noqa: E731  (a column read several times, computed once)
    other = lambda e: F.map_filter(e, lambda k, v: ~k.isin(known) | ((k == "answers") & F.coalesce(odd_answer, F.lit(False))))
    broken = F.create_map(F.lit("malformed"), line.cast("variant"))
    found = once(every, lambda e: F.when(e.isNull() & (F.trim(line) != ""), F.to_variant_object(broken)).otherwise(
        once(other(e), lambda o: F.when(F.size(o) > 0, F.to_variant_object(o)))))
    return F.when(~plain, found)


def read_dns_logs(spark: SparkSession, paths, layout: str = "aws") -> DataFrame:
    """Raw resolver JSON lines -> curated DNS columns. ``account_id`` comes
    from the record (aws layout); vpc_id, year, month, day from the path; nothing
    of a line is lost (``residue``)."""
    found, missing = existing_paths(spark, paths)
    _report(missing)
    if not found:
        return _empty(spark, DNS_DDL)
    names = ["account_id", "vpc_id", "year", "month", "day"]
    lines = spark.read.text(found).where("value <> ''")
    if layout == "hive":
        parts = {n: F.col(n) for n in names}
    else:
        parts = _path_parts("aws", DNS_PATH_RE, names)
    fields = F.from_json("value", RAW_DNS_SCHEMA)
    raw = lines.select(fields.alias("f"), _residue(F.col("value"), fields).alias("residue"), *[c.alias(n) for n, c in parts.items()])
    return raw.select(
        "account_id" if layout == "hive" else "f.account_id", "f.region", "vpc_id", "f.srcaddr",
        F.col("f.srcport").try_cast("int").alias("srcport"), "f.srcids", "f.query_name", "f.query_type", "f.query_class",
        "f.query_timestamp", "f.answers", "f.rcode", "f.transport", "f.version", "residue",
        "year", "month", "day",
    )


DNS_DDL = (
    "account_id string, region string, vpc_id string, srcaddr string, srcport int, "
    "srcids map<string,string>, query_name string, query_type string, query_class string, query_timestamp string, "
    "answers array<struct<Rdata:string,Type:string,Class:string>>, rcode string, "
    "transport string, version string, residue variant, year string, month string, day string"
)


def read_curated(spark: SparkSession, root: str, year=None, month=None, day=None, accounts=None) -> DataFrame:
    """Hive-partitioned curated Parquet; partition filters prune directories
    (partition values stay strings: type inference is off in ``prepare``)."""
    df = spark.read.option("basePath", root).option("mergeSchema", "false").parquet(root)
    for name, value in (("year", year), ("month", month), ("day", day)):
        if value is not None:
            df = df.where(F.col(name) == F.lpad(F.lit(str(value)), 4 if name == "year" else 2, "0"))
    if accounts is not None:
        df = df.where(F.col("account_id").isin(list(accounts)))
    return df
