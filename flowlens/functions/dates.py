"""Date/time derivations. Output timestamps are TIMESTAMP_NTZ computed by
epoch arithmetic, so results do not depend on any session or JVM time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F



def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def log_date(year="year", month="month", day="day") -> Column:
    """DATE from string partition values that may arrive unpadded ('2')."""
    text = F.concat_ws("-", _col(year), F.lpad(_col(month), 2, "0"), F.lpad(_col(day), 2, "0"))
    return F.try_to_date(text, "yyyy-MM-dd")


def epoch_to_ntz(seconds) -> Column:
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_add("SECOND", _col(seconds), epoch)


def hour_floor(seconds) -> Column:
    s = _col(seconds)
    return s - F.pmod(s, F.lit(3600))


def hour_bucket(seconds) -> Column:
    """date_trunc('hour', from_unixtime(seconds)) as TIMESTAMP_NTZ (UTC wall clock)."""
    return epoch_to_ntz(hour_floor(seconds))


def iso_to_micros(text) -> Column:
    """ISO-8601 'yyyy-MM-ddTHH:mm:ss[.ffffff]Z' -> microseconds since the epoch (BIGINT)."""
    return F.unix_micros(F.try_to_timestamp(_col(text)))
