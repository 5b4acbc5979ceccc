"""DuckDB SQL for the fixture adapters (FIXTURES.md part B) and shared
snippets. Every oracle query is ``WITH <adapters>, <its own CTEs> SELECT ...``
over the pre-registered driver views (lineitem, part, nation)."""

from __future__ import annotations


def ip_int(col: str) -> str:
    """IPv4 text -> BIGINT, NULL unless exactly four octets 0..255."""
    o = [f"TRY_CAST(split_part({col}, '.', {i}) AS BIGINT)" for i in (1, 2, 3, 4)]
    return (
        f"(CASE WHEN regexp_full_match({col}, '\\d{{1,3}}\\.\\d{{1,3}}\\.\\d{{1,3}}\\.\\d{{1,3}}') "
        f"AND {o[0]} <= 255 AND {o[1]} <= 255 AND {o[2]} <= 255 AND {o[3]} <= 255 "
        f"THEN {o[0]} * 16777216 + {o[1]} * 65536 + {o[2]} * 256 + {o[3]} END)"
    )


def public_egress(alias: str = "") -> str:
    a = f"{alias}." if alias else ""
    return (
        f"{a}flow_direction = 'egress' AND {a}dstaddr NOT LIKE '10.%' "
        f"AND {a}dstaddr NOT LIKE '172.16.%' AND {a}dstaddr NOT LIKE '192.168.%'"
    )


def log_date(alias: str = "") -> str:
    a = f"{alias}." if alias else ""
    return f"CAST(concat({a}year, '-', lpad({a}month, 2, '0'), '-', lpad({a}day, 2, '0')) AS DATE)"


def gb(expr: str, digits: int | None = None) -> str:
    v = f"CAST({expr} AS DOUBLE) / 1073741824.0"
    return v if digits is None else f"round({v}, {digits})"


def mb(expr: str, digits: int | None = None) -> str:
    v = f"CAST({expr} AS DOUBLE) / 1048576.0"
    return v if digits is None else f"round({v}, {digits})"


def port_label(col: str) -> str:
    return (
        f"CASE {col} WHEN 443 THEN '443 / HTTPS' WHEN 80 THEN '80 / HTTP' WHEN 53 THEN '53 / DNS' "
        f"WHEN 22 THEN '22 / SSH' WHEN 3306 THEN '3306 / MySQL' WHEN 5432 THEN '5432 / PostgreSQL' "
        f"WHEN 6379 THEN '6379 / Redis' WHEN 8080 THEN '8080 / HTTP-Alt' "
        f"ELSE concat(CAST({col} AS VARCHAR), ' / Other') END"
    )


FLOWS_BASE = """
fb0 AS (
  SELECT l_orderkey AS _k, l_linenumber AS _n, l_partkey AS _p, l_suppkey AS _s,
         l_quantity, l_extendedprice, l_returnflag, l_linestatus,
         CAST(1771113600 + (l_orderkey * 37 + l_linenumber * 911) % 86400 AS BIGINT) AS _start,
         lpad(CAST(l_suppkey % 4 + 1 AS VARCHAR), 12, '0') AS _acct,
         CASE l_suppkey % 3 WHEN 0 THEN 'us-east-1' WHEN 1 THEN 'us-west-1' ELSE 'eu-west-1' END AS _region,
         concat('10.0.', l_suppkey % 4, '.', l_partkey % 50) AS _src,
         CASE WHEN l_partkey % 97 = 0 THEN '2600:1f18::1'
              WHEN l_partkey % 10 = 0 THEN concat('192.168.1.', l_partkey % 100)
              WHEN l_partkey % 10 = 1 THEN concat('10.9.0.', l_partkey % 100)
              WHEN l_partkey % 10 = 2 THEN concat('172.16.0.', l_partkey % 100)
              WHEN l_partkey % 10 = 3 THEN concat('172.20.0.', l_partkey % 100)
              ELSE concat(l_partkey % 200 + 20, '.', (l_partkey % 7) * 36, '.', l_suppkey % 3, '.', l_partkey % 100)
         END AS _dst
  FROM lineitem
),
flows_base AS (
  SELECT _k, _n, _p,
    CAST(5 AS INTEGER) AS version,
    _acct AS log_account_id,
    concat('eni-', _s % 20) AS interface_id,
    _src AS srcaddr,
    _dst AS dstaddr,
    CAST(1024 + _k % 4000 AS INTEGER) AS srcport,
    CAST(CASE _p % 9 WHEN 0 THEN 443 WHEN 1 THEN 80 WHEN 2 THEN 53 WHEN 3 THEN 22 WHEN 4 THEN 3306
                     WHEN 5 THEN 5432 WHEN 6 THEN 6379 WHEN 7 THEN 8080 ELSE 9000 END AS INTEGER) AS dstport,
    CAST(CASE _n % 3 WHEN 0 THEN 6 WHEN 1 THEN 17 ELSE 1 END AS INTEGER) AS protocol,
    CASE WHEN _k % 50 <> 0 THEN CAST(round(l_quantity) AS BIGINT) END AS packets,
    CASE WHEN _k % 50 <> 0 THEN CAST(round(l_extendedprice * 1000) AS BIGINT) END AS bytes,
    _start AS start_time,
    _start + 60 AS end_time,
    CASE WHEN l_returnflag = 'R' THEN 'REJECT' ELSE 'ACCEPT' END AS action,
    CASE WHEN _k % 50 = 0 THEN 'NODATA' ELSE 'OK' END AS log_status,
    concat('vpc-', _s % 6) AS vpc_id,
    concat('subnet-', _s % 9) AS subnet_id,
    CASE WHEN _n <> 7 THEN concat('i-', _p % 40) END AS instance_id,
    CAST(CASE _k % 2 WHEN 0 THEN 2 ELSE 18 END AS INTEGER) AS tcp_flags,
    'IPv4' AS type,
    _src AS pkt_srcaddr,
    _dst AS pkt_dstaddr,
    _region AS log_region,
    concat('az-', _s % 3) AS az_id,
    CAST(NULL AS VARCHAR) AS sublocation_type,
    CAST(NULL AS VARCHAR) AS sublocation_id,
    CAST(NULL AS VARCHAR) AS pkt_src_aws_service,
    CASE _s % 5 WHEN 0 THEN 'S3' WHEN 1 THEN 'EC2' WHEN 2 THEN '' WHEN 3 THEN 'DYNAMODB' END AS pkt_dst_aws_service,
    CASE WHEN l_linestatus = 'O' THEN 'egress' ELSE 'ingress' END AS flow_direction,
    CAST(_n % 3 AS INTEGER) AS traffic_path,
    _acct AS account_id,
    _region AS region,
    '2026' AS year, '02' AS month, '15' AS day
  FROM fb0
),
flows AS (
  SELECT * EXCLUDE (_k, _n, _p) FROM flows_base
),
dns0 AS (
  SELECT *, TIMESTAMP '1970-01-01 00:00:00' + to_seconds(start_time - _k % 900) AS _ts
  FROM flows_base
),
dns AS (
  SELECT account_id, region, vpc_id, srcaddr, srcport, instance_id,
    concat('host', _p % 60, '.example.com') AS query_name,
    'A' AS query_type,
    strftime(_ts, '%Y-%m-%dT%H:%M:%SZ') AS query_timestamp,
    CASE WHEN _k % 22 = 0 THEN CAST(NULL AS STRUCT(Rdata VARCHAR)[])
         WHEN _k % 11 = 0 THEN CAST([] AS STRUCT(Rdata VARCHAR)[])
         ELSE [{'Rdata': if(_n <= 3, dstaddr, concat('198.51.100.', _p % 100))}] END AS answers,
    CASE WHEN _k % 11 = 0 THEN 'NXDOMAIN' ELSE 'NOERROR' END AS rcode,
    'UDP' AS transport, '1.100000' AS version,
    strftime(_ts, '%Y') AS year, strftime(_ts, '%m') AS month, strftime(_ts, '%d') AS day
  FROM dns0
),
ec2_details AS (
  SELECT lpad(CAST(p_partkey % 3 + 1 AS VARCHAR), 12, '0') AS account_id,
    CASE CAST(floor(p_partkey / 3.0) AS BIGINT) % 3 WHEN 0 THEN 'us-east-1' WHEN 1 THEN 'us-west-1' ELSE 'eu-west-1' END AS region,
    concat('i-', p_partkey % 45) AS instance_id,
    concat('acct-', p_partkey % 3 + 1) AS account_name,
    p_type AS biz_unit,
    concat('app-', p_partkey % 8) AS application_id
  FROM part
),
blocks AS (
  SELECT p_partkey AS p, p_partkey // 180 AS j,
         CAST(if(p_partkey // 180 < 64, 262144, 256) AS BIGINT) AS width,
         CAST((p_partkey % 180 + 20) * 16777216 + (p_partkey // 180) % 64 * 262144
              + if(p_partkey // 180 < 64, 0, (p_partkey // 180 // 64) % 1024 * 256) AS BIGINT) AS lo
  FROM part
),
geo_blocks AS (
  SELECT lo AS network_start_integer, lo + width - 1 AS network_end_integer, CAST(p % 30 AS BIGINT) AS geoname_id FROM blocks
),
geo_names AS (
  SELECT CAST(n_nationkey AS BIGINT) AS geoname_id, n_name AS country_name FROM nation
  UNION ALL
  SELECT CAST(n_nationkey AS BIGINT), lower(n_name) FROM nation WHERE n_nationkey % 2 = 0
),
geo_locations AS (SELECT geoname_id, min(country_name) AS country_name FROM geo_names GROUP BY geoname_id),
geo_asn AS (
  SELECT lo + half * (width // 2) AS network_start_integer, lo + (half + 1) * (width // 2) - 1 AS network_end_integer,
         concat('AS-', (p + half * 13) % 40) AS autonomous_system_organization
  FROM blocks, (VALUES (0), (1)) AS halves(half)
),
cloud0 AS (
  SELECT (CAST(n_nationkey AS BIGINT) * 8 + 20) * 16777216 AS network_start_int,
         (CAST(n_nationkey AS BIGINT) * 8 + 20) * 16777216 + 2 * 16777216 - 1 AS network_end_int,
         CASE n_nationkey % 3 WHEN 0 THEN 'S3' WHEN 1 THEN 'EC2' ELSE 'DYNAMODB' END AS service,
         CASE n_nationkey % 2 WHEN 0 THEN 'us-east-1' ELSE 'us-west-1' END AS region
  FROM nation
),
cloud_ranges AS (
  SELECT * FROM cloud0
  UNION ALL
  SELECT network_start_int, network_end_int, 'AMAZON' AS service, 'GLOBAL' AS region FROM cloud0
),
resolved_names AS (
  SELECT DISTINCT if(_p % 3 <> 0, dstaddr, concat('203.0.113.', _p % 100)) AS dstaddr,
    concat(if(_p % 11 = 0, 'second-', 'rev-'), replace(replace(dstaddr, '.', '-'), ':', '-'), '.example.net') AS domain
  FROM flows_base
),
resolved_ips AS (SELECT dstaddr, min(domain) AS domain FROM resolved_names GROUP BY dstaddr),
acct AS (
  SELECT account_id, min(account_name) AS account_name FROM ec2_details GROUP BY account_id
),
inst AS (
  SELECT account_id, region, instance_id, account_name, biz_unit, application_id FROM (
    SELECT *, row_number() OVER (PARTITION BY account_id, region, instance_id
      ORDER BY account_name ASC NULLS LAST, biz_unit ASC NULLS LAST, application_id ASC NULLS LAST) AS rn
    FROM ec2_details) WHERE rn = 1
),
fallback AS (
  SELECT account_id, region, account_name, biz_unit FROM (
    SELECT *, row_number() OVER (PARTITION BY account_id, region
      ORDER BY account_name ASC NULLS LAST, biz_unit ASC NULLS LAST) AS rn
    FROM ec2_details) WHERE rn = 1
)
"""


def with_adapters(body: str) -> str:
    """Prefix a query body (``name AS (...), ... SELECT ...`` or a bare
    ``SELECT``) with the adapter CTEs."""
    body = body.strip()
    if body.upper().startswith("SELECT"):
        return f"WITH {FLOWS_BASE}\n{body}"
    return f"WITH {FLOWS_BASE},\n{body}"
