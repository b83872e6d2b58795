"""Time, rounding and text helpers as native column expressions.

Event times are ``TIMESTAMP_NTZ`` holding UTC wall-clock time.  Arithmetic on
them goes through microseconds since the epoch so no session time zone is
involved.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"

_UNITS = {
    "microsecond": 1, "millisecond": 1_000, "second": 1_000_000, "minute": 60_000_000,
    "hour": 3_600_000_000, "day": 86_400_000_000, "week": 7 * 86_400_000_000,
}


def interval_micros(text: str) -> int:
    """'60 seconds' / '4 hours' / '1 day' -> microseconds."""
    m = re.fullmatch(r"\s*(\d+)\s*([a-zA-Z]+?)s?\s*", text)
    if not m:
        raise ValueError(f"unsupported interval {text!r}")
    n, unit = int(m.group(1)), m.group(2).lower()
    if unit not in _UNITS:
        raise ValueError(f"unsupported interval unit in {text!r}")
    return n * _UNITS[unit]


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def epoch_micros(col) -> Column:
    """Microseconds since 1970-01-01 of a TIMESTAMP_NTZ column."""
    return F.timestamp_diff("MICROSECOND", F.expr(EPOCH_NTZ), _c(col))


def from_epoch_micros(col) -> Column:
    """TIMESTAMP_NTZ from microseconds since the epoch."""
    return F.timestamp_add("MICROSECOND", _c(col), F.expr(EPOCH_NTZ))


def floor_time(col, step: str) -> Column:
    """Truncate a TIMESTAMP_NTZ to a multiple of ``step`` counted from the epoch."""
    us = interval_micros(step)
    return from_epoch_micros(F.floor(epoch_micros(col) / F.lit(us)) * F.lit(us))


def to_utc_ntz(col) -> Column:
    """Absolute instant (TIMESTAMP) -> TIMESTAMP_NTZ in UTC, independent of session zone."""
    return from_epoch_micros(F.unix_micros(_c(col)))


def round_half_up(col, digits: int) -> Column:
    """floor(x * 10^d + 0.5) / 10^d in doubles.

    Spark's and DuckDB's ``round(double)`` disagree on a few ties; this form
    gives the same bits in both engines.
    """
    scale = float(10 ** digits)
    return F.floor(_c(col).cast("double") * F.lit(scale) + F.lit(0.5)) / F.lit(scale)


_HOUR_RE = r"^[0-9]{4}-?[0-9]{2}-?[0-9]{2}[T ]([0-9]{2})"
_DATE_ONLY_RE = r"^[0-9]{4}-?[0-9]{2}-?[0-9]{2}$"


def hour_as_written(col) -> Column:
    """Hour of day as written in ISO-8601 text, before any zone conversion.

    Extended and compact forms both work; date-only text is hour 0; anything
    else (or an hour above 23) is NULL.
    """
    text = _c(col)
    hour = F.regexp_extract(text, _HOUR_RE, 1).try_cast("int")
    return F.when(hour <= 23, hour).when(text.rlike(_DATE_ONLY_RE), F.lit(0))

