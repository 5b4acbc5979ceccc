"""As-of join of flows to DNS answers.

Each flow gets the latest DNS answer for the same (account, vpc, client,
resolved address) whose time lies in [flow_start - tolerance, flow_start]
(closed). ``same_hour=True`` also requires the DNS time to fall in the flow's
clock hour (reference parity: answers from the previous hour are not used).

Linear: flows and answers are put into one table, dealt by (key, hour) and sorted
by time, and a running ``last`` carries the newest answer to every flow; it is
then tested against the tolerance. The newest answer at or before a flow decides:
if it is too old, so are all others. One shuffle, each side read once, every flow
kept; the largest unit of work is one client-address pair in one hour, which the
sort spills. Answers are copied into following hours when ``same_hour`` is off.
Times have microsecond resolution on the DNS side.
"""

from __future__ import annotations


from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import iso_to_micros
from .dns import explode_answers

PAIR_KEYS = ["account_id", "vpc_id", "_src", "_dst"]


def dns_answer_times(dns: DataFrame) -> DataFrame:
    """(account, vpc, client, resolved, time in microseconds) -> smallest domain."""
    rows = explode_answers(
        dns.select("account_id", "vpc_id", "srcaddr", "query_name", "query_timestamp", "answers"),
        keep_empty=True,
    ).where(F.col("resolved_ip").isNotNull())
    return (
        rows.select(
            "account_id", "vpc_id", F.col("srcaddr").alias("_src"), F.col("resolved_ip").alias("_dst"),
            iso_to_micros("query_timestamp").alias("_dns_t"), F.col("query_name").alias("_dom"),
        )
        .where(F.col("_dns_t").isNotNull())
        .groupBy(*PAIR_KEYS, "_dns_t")
        .agg(F.min("_dom").alias("_dom"))
    )


def asof_dns_join(
    flows: DataFrame,
    dns: DataFrame,
    src: str = "pkt_srcaddr",
    dst: str = "pkt_dstaddr",
    start: str = "start_time",
    tolerance_s: int = 600,
    same_hour: bool = True,
    name: str = "domain",
) -> DataFrame:
    """``flows`` plus a ``name`` column (NULL when no answer qualifies)."""
    micros, hour_us = 1_000_000, 3_600_000_000
    f = flows.withColumns({"_src": F.col(src), "_dst": F.col(dst), "_t": F.col(start).cast("bigint") * micros})
    keyed = F.col("_t").isNotNull()
    for c in PAIR_KEYS:
        keyed = keyed & F.col(c).isNotNull()
    # flows that can't match are spread, not gathered under the null key
    f = f.withColumn("_hour", F.when(keyed, F.floor(F.col("_t") / hour_us)).otherwise(-1 - F.pmod(F.xxhash64(*flows.columns), F.lit(4096))))
    d = dns_answer_times(dns)
    first = F.floor(F.col("_dns_t") / hour_us)
    hours = F.array(first) if same_hour else F.sequence(first, F.floor((F.col("_dns_t") + tolerance_s * micros) / hour_us))
    d = d.select(*PAIR_KEYS, F.col("_dns_t").alias("_t"), F.explode(hours).alias("_hour"),
                 F.struct("_dns_t", "_dom").alias("_answer"))
    rows = f.withColumn("_kind", F.lit(1)).unionByName(d.withColumn("_kind", F.lit(0)), allowMissingColumns=True)
    running = Window.partitionBy(*PAIR_KEYS, "_hour").orderBy("_t", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    newest = rows.withColumn("_newest", F.last("_answer", ignorenulls=True).over(running)).where("_kind = 1")
    fits = F.col("_t") - F.col("_newest._dns_t") <= tolerance_s * micros
    return newest.select(*flows.columns, F.when(fits, F.col("_newest._dom")).alias(name))
