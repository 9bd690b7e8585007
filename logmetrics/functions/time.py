"""Time helpers on TIMESTAMP_NTZ columns.

Event time stays a wall-clock UTC ``TIMESTAMP_NTZ`` throughout the library, so nothing
depends on the session time zone.  Epoch arithmetic uses ``timestampdiff`` /
``timestampadd`` against the NTZ epoch, which are codegen'd JVM expressions.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"
_UNITS = {
    "microsecond": 1,
    "millisecond": 1000,
    "second": 1_000_000,
    "minute": 60_000_000,
    "hour": 3_600_000_000,
    "day": 86_400_000_000,
    "week": 7 * 86_400_000_000,
}

# Wire format of the log ``timestamp`` field (UTC, microseconds, literal Z).
ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"
# Parse pattern: the fraction is optional (Python's isoformat drops it at 0 us), and the
# zone is Z or an offset, so a string names one instant.
ISO_PARSE_FORMAT = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][.SSS]XXX"


def interval_micros(duration: str | int) -> int:
    """'15 seconds' / '1 hour' / '5m' / integer micros -> micros."""
    if isinstance(duration, int):
        return duration
    m = re.fullmatch(r"\s*(\d+)\s*([a-zA-Z]+)\s*", duration)
    if not m:
        raise ValueError(f"bad duration: {duration!r}")
    n, unit = int(m.group(1)), m.group(2).lower()
    short = {"us": "microsecond", "ms": "millisecond", "s": "second", "m": "minute", "h": "hour", "d": "day", "w": "week"}
    unit = short.get(unit, unit.rstrip("s"))
    if unit not in _UNITS:
        raise ValueError(f"bad duration unit: {duration!r}")
    return n * _UNITS[unit]


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def epoch_micros(col) -> Column:
    """Microseconds since 1970-01-01 of an NTZ timestamp (BIGINT), from its date and
    time-of-day fields, so no session time zone is involved."""
    c = _c(col)
    day = F.unix_date(F.to_date(c)).cast("long") * F.lit(86_400_000_000)
    tod = (F.hour(c).cast("long") * F.lit(3_600_000_000) + F.minute(c).cast("long") * F.lit(60_000_000)
           + (F.date_part(F.lit("SECOND"), c) * F.lit(1_000_000)).cast("long"))
    return day + tod


def add_micros(col, micros) -> Column:
    """NTZ timestamp plus a number of microseconds (literal or column)."""
    m = micros if isinstance(micros, Column) else F.lit(int(micros))
    return F.timestamp_add("MICROSECOND", m, _c(col))


def from_epoch_micros(micros) -> Column:
    m = micros if isinstance(micros, Column) else F.lit(int(micros))
    return F.timestamp_add("MICROSECOND", m, F.expr(_EPOCH))


def bucket_start(col, step: str | int) -> Column:
    """Start of the epoch-aligned step containing ``col`` (same as tumbling ``window``)."""
    s = interval_micros(step)
    us = epoch_micros(col)
    return from_epoch_micros(us - F.pmod(us, F.lit(s)))


def bucket_end(col, step: str | int) -> Column:
    """End of the epoch-aligned step containing ``col`` (exclusive end of [start, end))."""
    return add_micros(bucket_start(col, step), interval_micros(step))


def iso_utc(col) -> Column:
    """Render an NTZ timestamp in the log wire format."""
    return F.date_format(_c(col), ISO_FORMAT)


def parse_instant(col) -> Column:
    """The log ``timestamp`` string as TIMESTAMP; NULL when unparseable.  The one parser of
    batch and streaming jobs: bad input never raises, also under ANSI."""
    return F.try_to_timestamp(_c(col), F.lit(ISO_PARSE_FORMAT))


def parse_iso_utc(col) -> Column:
    """The log ``timestamp`` string as UTC wall clock (NTZ); NULL when unparseable."""
    return from_epoch_micros(F.unix_micros(parse_instant(col)))


def ntz_literal(value) -> Column:
    """A wall-clock NTZ literal from a datetime / date / 'YYYY-MM-DD HH:MM:SS' string
    (no session time zone involved); a column stays as it is."""
    if isinstance(value, Column):
        return value
    if hasattr(value, "isoformat"):
        value = value.isoformat(sep=" ") if hasattr(value, "hour") else value.isoformat()
    return F.lit(str(value)).cast("timestamp_ntz")
