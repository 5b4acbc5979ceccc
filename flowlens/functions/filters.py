"""Row predicates shared by the aggregates (all pushed down by Catalyst)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .ipmath import ip_to_int, is_rfc1918

# The textual private-destination prefixes of the reference.
PRIVATE_PREFIXES = ("10.", "172.16.", "192.168.")


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_public_dst(c="dstaddr", mode: str = "literal") -> Column:
    """``literal``: reference parity (three text prefixes; 172.17-172.31 leak
    through). ``rfc1918``: the full private blocks on the integer form."""
    c = _col(c)
    if mode == "literal":
        pred = None
        for prefix in PRIVATE_PREFIXES:
            p = ~c.startswith(prefix)
            pred = p if pred is None else pred & p
        return pred
    if mode == "rfc1918":
        return c.isNotNull() & ~F.coalesce(is_rfc1918(ip_to_int(c)), F.lit(False))
    raise ValueError(f"unknown mode {mode!r}")


def is_egress(c="flow_direction") -> Column:
    return _col(c) == "egress"


def public_egress(mode: str = "literal") -> Column:
    return is_egress() & is_public_dst("dstaddr", mode)


def status_ok(c="log_status") -> Column:
    return _col(c) == "OK"


def connection_start() -> Column:
    """TCP SYN or any UDP record."""
    return (F.col("tcp_flags") == 2) | (F.col("protocol") == 17)


def on_day(year: str | None = None, month: str | None = None, day: str | None = None) -> Column:
    """Equality on the string partition columns (pruned at the scan)."""
    pred = F.lit(True)
    for name, value in (("year", year), ("month", month), ("day", day)):
        if value is not None:
            pred = pred & (F.col(name) == value)
    return pred


def in_values(column: str, values) -> Column:
    return F.lit(True) if values is None else F.col(column).isin(list(values))


def report_filter(date=None, action=None, service=None, ip=None, date_col="log_date") -> Column:
    """Dashboard filters as Column expressions (never string splicing)."""
    pred = F.lit(True)
    if date is not None:
        pred = pred & (F.col(date_col) == F.lit(date).cast("date"))
    if action not in (None, "All"):
        pred = pred & (F.col("action") == action)
    if service:
        pred = pred & (
            F.coalesce(F.col("pkt_src_aws_service").contains(service), F.lit(False))
            | F.coalesce(F.col("pkt_dst_aws_service").contains(service), F.lit(False))
        )
    if ip:
        pred = pred & ((F.col("srcaddr") == ip) | (F.col("dstaddr") == ip))
    return pred
