"""Building blocks of the oracle statements: what is known about an address, a
client's look-ups and an owner, each as one relation with one row per key
(ordered aggregates pick the row). Statements attach them to single flow records
and aggregate once at the end."""

from __future__ import annotations

from .adapters import ip_int, public_egress

# every destination address, and per address the narrowest country block, network block and cloud range
ADDRESS = f"""
address AS (SELECT DISTINCT dstaddr, {ip_int('dstaddr')} AS n FROM flows),
country_of AS (
  SELECT n, first(geoname_id ORDER BY network_end_integer - network_start_integer, geoname_id) AS geoname_id
  FROM address JOIN geo_blocks ON n >= network_start_integer AND n <= network_end_integer GROUP BY n
),
network_of AS (
  SELECT n, first(autonomous_system_organization
                  ORDER BY network_end_integer - network_start_integer, autonomous_system_organization) AS asn_org
  FROM address JOIN geo_asn ON n >= network_start_integer AND n <= network_end_integer GROUP BY n
),
own_cloud AS (
  SELECT n, service, first(region ORDER BY network_end_int - network_start_int, region) AS aws_region
  FROM address JOIN cloud_ranges ON n >= network_start_int AND n <= network_end_int GROUP BY n, service
),
known AS (
  SELECT dstaddr, n, country_name, asn_org
  FROM address LEFT JOIN country_of USING (n) LEFT JOIN geo_locations USING (geoname_id) LEFT JOIN network_of USING (n)
)"""

# the name a client most often asked for that day, per answered address
LOOKUP = """
asked AS (
  SELECT account_id, vpc_id, srcaddr, got.Rdata AS dstaddr, query_name, year, month, day, count(*) AS times
  FROM dns, unnest(answers) AS one(got) WHERE rcode = 'NOERROR' GROUP BY ALL
),
favourite AS (
  SELECT account_id, vpc_id, srcaddr, dstaddr, year, month, day, first(query_name ORDER BY times DESC, query_name) AS name
  FROM asked GROUP BY ALL
)"""

# accepted-status public egress, record by record, with owner labels and that name
RECORDS = f"""
records AS (
  SELECT flows.*, name,
    coalesce(inst.account_name, fallback.account_name, 'UNKNOWN') AS owner,
    coalesce(inst.biz_unit, fallback.biz_unit, 'UNKNOWN') AS unit,
    coalesce(inst.application_id, 'UNKNOWN') AS application
  FROM flows
  LEFT JOIN favourite USING (account_id, vpc_id, srcaddr, dstaddr, year, month, day)
  LEFT JOIN inst USING (account_id, region, instance_id)
  LEFT JOIN fallback USING (account_id, region)
  WHERE {public_egress('flows')} AND log_status = 'OK'
)"""

# scope of the traffic given the cloud range's region (null: no such range)
SCOPE = """CASE WHEN aws_region IS NOT DISTINCT FROM records.region THEN 'Same-Region'
                WHEN aws_region IS NULL THEN 'Internet' ELSE 'Cross-Region' END"""
OWN_CLOUD = "LEFT JOIN own_cloud ON own_cloud.n = known.n AND own_cloud.service = {t}.pkt_dst_aws_service"
