"""IPv4 text <-> integer helpers, written as built-in Column expressions so they
stay inside whole-stage codegen (no Python UDF)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

IPV4_PATTERN = r"^\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}$"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ip_to_int(c) -> Column:
    """Dotted IPv4 text -> BIGINT in [0, 2^32).

    Anything that is not exactly four decimal octets 0..255 (IPv6, '', NULL,
    '1.2.3', '256.1.1.1', ...) gives NULL instead of raising under ANSI mode.
    """
    c = _col(c)
    parts = F.split(c, r"\.")
    octets = [F.try_element_at(parts, F.lit(i)).try_cast("bigint") for i in (1, 2, 3, 4)]
    in_range = octets[0] <= 255
    for o in octets[1:]:
        in_range = in_range & (o <= 255)
    value = octets[0] * 16777216 + octets[1] * 65536 + octets[2] * 256 + octets[3]
    return F.when(c.rlike(IPV4_PATTERN) & in_range, value)


def prefix_bucket(ip_int, bits: int) -> Column:
    """Top ``bits`` bits of a 32-bit address (bits=8 gives the first octet)."""
    return F.shiftright(_col(ip_int), 32 - bits)


def is_rfc1918(ip_int) -> Column:
    """10/8, 172.16/12 and 192.168/16 on the integer form."""
    ip = _col(ip_int)
    return (
        (F.shiftright(ip, 24) == 10)
        | (F.shiftright(ip, 20) == (172 * 16 + 1))
        | (F.shiftright(ip, 16) == (192 * 256 + 168))
    )
