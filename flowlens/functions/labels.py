"""Label derivations used by the daily aggregates and reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's output labels.
PROTOCOL_NAMES = {6: "TCP", 17: "UDP", 1: "ICMP"}
PORT_LABELS = {
    443: "443 / HTTPS",
    80: "80 / HTTP",
    53: "53 / DNS",
    22: "22 / SSH",
    3306: "3306 / MySQL",
    5432: "5432 / PostgreSQL",
    6379: "6379 / Redis",
    8080: "8080 / HTTP-Alt",
}
OTHER_PORT_SUFFIX = " / Other"
NON_CLOUD = "NON-AWS"
GENERAL_TRAFFIC = "General Traffic"
CLOUD_ASN_ORG = "Amazon.com, Inc."
UNKNOWN_ASN = "Unknown ASN"
UNKNOWN = "UNKNOWN"
SCOPE_INTERNET = "Internet"
SCOPE_SAME = "Same-Region"
SCOPE_CROSS = "Cross-Region"
SCOPE_UNKNOWN = "Unknown"

BYTES_PER_GB = 1073741824.0
BYTES_PER_MB = 1048576.0


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _lookup(c: Column, mapping: dict, default: Column) -> Column:
    expr = None
    for key, label in mapping.items():
        expr = F.when(c == key, F.lit(label)) if expr is None else expr.when(c == key, F.lit(label))
    return expr.otherwise(default)


def protocol_name(c) -> Column:
    c = _col(c)
    return _lookup(c, PROTOCOL_NAMES, c.cast("string"))


def port_label(c) -> Column:
    c = _col(c)
    return _lookup(c, PORT_LABELS, F.concat(c.cast("string"), F.lit(OTHER_PORT_SUFFIX)))


def blank_to_null(c) -> Column:
    c = _col(c)
    return F.when(c != "", c)


def service_label(c, default: str = NON_CLOUD) -> Column:
    """Empty or NULL service -> ``default``."""
    return F.coalesce(blank_to_null(c), F.lit(default))


def has_service(c) -> Column:
    c = _col(c)
    return c.isNotNull() & (c != "")


def asn_org_label(service, org) -> Column:
    """Any packet-level cloud service overrides the ASN name."""
    return F.when(has_service(service), F.lit(CLOUD_ASN_ORG)).otherwise(
        F.coalesce(_col(org), F.lit(UNKNOWN_ASN))
    )


def final_service(matched_service) -> Column:
    return F.coalesce(_col(matched_service), F.lit(NON_CLOUD))


def region_scope(matched_service, cloud_region, src_region, strict: bool = True) -> Column:
    svc, cr, sr = _col(matched_service), _col(cloud_region), _col(src_region)
    expr = F.when(svc.isNull(), F.lit(SCOPE_INTERNET)).when(cr == sr, F.lit(SCOPE_SAME))
    if not strict:
        return expr.otherwise(F.lit(SCOPE_CROSS))
    return expr.when(cr.isNotNull() & (cr != sr), F.lit(SCOPE_CROSS)).otherwise(F.lit(SCOPE_UNKNOWN))


def gb(c, digits: int | None = None) -> Column:
    v = _col(c).cast("double") / BYTES_PER_GB
    return v if digits is None else F.round(v, digits)


def mb(c, digits: int | None = None) -> Column:
    v = _col(c).cast("double") / BYTES_PER_MB
    return v if digits is None else F.round(v, digits)
