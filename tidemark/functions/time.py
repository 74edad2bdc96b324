"""Time functions: change-time parsing, UTC-3 shift, partition values, calendar.

All timestamps are ``TIMESTAMP_NTZ``. Text is built from the zone-free
field functions (``year``, ``month``, ``hour``, ...) rather than
``date_format``, which converts through the session time zone and shifts
wall-clock times that fall into a daylight-saving gap of that zone. Results
are therefore the same in every session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.config import (
    EXTRACT_AT_PARSE,
    LOCAL_OFFSET_HOURS,
    PARTITION_COLS,
)


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_extract_at(c: str | Column = "extract_at") -> Column:
    """Landed change-time text -> TIMESTAMP_NTZ (0, 3 or 6 fraction digits).

    Under ANSI mode (Spark 4 default) malformed text fails the job instead of
    silently becoming null.
    """
    return F.to_timestamp_ntz(_c(c), F.lit(EXTRACT_AT_PARSE))


def _pad(c: Column, n: int) -> Column:
    return F.lpad(c.cast("string"), n, "0")


def format_extract_at(c: str | Column) -> Column:
    """TIMESTAMP_NTZ -> ``yyyy-MM-dd HH:mm:ss.SSSSSS`` text, zone-free.

    Casting an NTZ value to string involves no time zone; it drops trailing
    fraction zeros, which are padded back to the fixed six digits.
    """
    s = _c(c).cast("string")
    return F.when(F.length(s) == 19, F.concat(s, F.lit(".000000"))).otherwise(F.rpad(s, 26, "0"))


def time_key(c: str | Column, grain: str) -> Column:
    """Compact partition text of a timestamp: yyyyMM, yyyyMMdd or yyyyMMddHH."""
    ts = _c(c)
    parts = [_pad(F.year(ts), 4), _pad(F.month(ts), 2)]
    if grain in ("day", "hour"):
        parts.append(_pad(F.dayofmonth(ts), 2))
    if grain == "hour":
        parts.append(_pad(F.hour(ts), 2))
    return F.concat(*parts)


def shift_local(c: str | Column, hours: int = LOCAL_OFFSET_HOURS) -> Column:
    """UTC wall clock -> fixed UTC-3 wall clock."""
    return _c(c) - F.make_dt_interval(F.lit(0), F.lit(hours))


def partition_values(ts: str | Column, hours: int = LOCAL_OFFSET_HOURS) -> list[Column]:
    """Four string landing partition values of a UTC change time, in UTC-3."""
    local = shift_local(ts, hours)
    parts = (_pad(F.year(local), 4), _pad(F.month(local), 2), _pad(F.dayofmonth(local), 2),
             _pad(F.hour(local), 2))
    return [p.alias(n) for p, n in zip(parts, PARTITION_COLS)]


def year_month(c: str | Column) -> Column:
    """yyyyMM of a timestamp as bigint (e.g. 202402)."""
    ts = _c(c)
    return (F.year(ts) * 100 + F.month(ts)).cast("bigint")


# English month names, January first.
MONTH_NAMES = ("January", "February", "March", "April", "May", "June", "July",
               "August", "September", "October", "November", "December")


def calendar_attributes(c: str | Column) -> list[Column]:
    """Calendar columns of the sales mart, derived from one timestamp."""
    ts = _c(c)
    names = F.array(*[F.lit(m) for m in MONTH_NAMES])
    return [
        F.month(ts).cast("bigint").alias("calendar_month_number"),
        F.element_at(names, F.month(ts)).alias("calendar_monthname_full"),
        # Two-digit month number, although the column name says "short name".
        _pad(F.month(ts), 2).alias("calendar_monthname_short"),
        F.quarter(ts).cast("bigint").alias("calendar_quarter"),
        F.year(ts).cast("bigint").alias("calendar_year"),
    ]


def hour_bucket(c: str | Column) -> Column:
    """Hidden-partition transform hour(ts): the timestamp truncated to its hour."""
    ts = _c(c)
    return F.make_timestamp_ntz(F.year(ts), F.month(ts), F.dayofmonth(ts), F.hour(ts),
                                F.lit(0), F.lit(0))


def month_bucket(c: str | Column) -> Column:
    """Hidden-partition transform month(ts): first instant of its month."""
    ts = _c(c)
    return F.make_timestamp_ntz(F.year(ts), F.month(ts), F.lit(1), F.lit(0), F.lit(0), F.lit(0))
