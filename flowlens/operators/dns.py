"""Resolver-log operators: answer explosion, daily query counts, the primary
(most queried) domain per client and resolved address, and the equi-join that
attaches it to flows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .lookups import unique_lookup

DAY = ["year", "month", "day"]
SUMMARY_KEYS = ["account_id", "vpc_id", "client_ip", "resolved_ip", *DAY]


def explode_answers(dns: DataFrame, keep_empty: bool = False) -> DataFrame:
    """One row per answer; ``keep_empty`` keeps queries without answers (NULL
    resolved_ip) like LEFT JOIN UNNEST, otherwise they are dropped like
    LATERAL VIEW EXPLODE."""
    gen = F.explode_outer if keep_empty else F.explode
    return dns.select("*", gen("answers").alias("_ans")).select(
        *[c for c in dns.columns if c != "answers"], F.col("_ans.Rdata").alias("resolved_ip")
    )


def dns_daily_summary(dns: DataFrame) -> DataFrame:
    """Successful queries per (account, vpc, client, domain, answer, day)."""
    ok = dns.where(F.col("rcode") == "NOERROR").select(
        "account_id", "vpc_id", "srcaddr", "query_name", "answers", *DAY
    )
    return (
        explode_answers(ok)
        .groupBy(
            "account_id", "vpc_id", F.col("srcaddr").alias("client_ip"),
            F.col("query_name").alias("domain"), "resolved_ip", *DAY,
        )
        .agg(F.count(F.lit(1)).alias("query_count"))
    )


def primary_domain(summary: DataFrame) -> DataFrame:
    """Most queried domain per (account, vpc, client, resolved ip, day); ties
    go to the smallest domain. A hash aggregate of a struct, not a window."""
    best = F.min(F.struct((-F.col("query_count")).alias("neg"), F.col("domain").alias("domain")))
    return summary.groupBy(*SUMMARY_KEYS).agg(best.alias("_b")).select(
        *SUMMARY_KEYS, F.col("_b.domain").alias("primary_domain")
    )


def with_primary_domain(flows: DataFrame, domains: DataFrame, src: str = "srcaddr", dst: str = "dstaddr", name: str = "domain") -> DataFrame:
    """Left equi-join on (dst = resolved, src = client, account, vpc, day)."""
    d = domains.select(
        F.col("account_id").alias("_d_acct"), F.col("vpc_id").alias("_d_vpc"),
        F.col("client_ip").alias("_d_client"), F.col("resolved_ip").alias("_d_res"),
        F.col("year").alias("_d_y"), F.col("month").alias("_d_m"), F.col("day").alias("_d_d"),
        F.col("primary_domain").alias(name),
    )
    cond = (
        (flows[dst] == d["_d_res"]) & (flows[src] == d["_d_client"])
        & (flows["account_id"] == d["_d_acct"]) & (flows["vpc_id"] == d["_d_vpc"])
        & (flows["year"] == d["_d_y"]) & (flows["month"] == d["_d_m"]) & (flows["day"] == d["_d_d"])
    )
    return flows.join(d, cond, "left").drop("_d_acct", "_d_vpc", "_d_client", "_d_res", "_d_y", "_d_m", "_d_d")


def with_reverse_domain(df: DataFrame, resolved: DataFrame, ip: str = "destination_ip", name: str = "domain") -> DataFrame:
    """Left-join the reverse name; of several names of an address the smallest
    counts, so no row is multiplied."""
    r = unique_lookup(resolved, ["dstaddr"], ["domain"]).select(F.col("dstaddr").alias("_r_ip"), F.col("domain").alias(name))
    return df.join(r, df[ip] == r["_r_ip"], "left").drop("_r_ip")
