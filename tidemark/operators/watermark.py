"""High watermarks and incremental filters.

The watermark is one aggregate over the target. It is fetched once as fixed
width *text* (one row, one value) and put back into the plan as a literal
cast to ``TIMESTAMP_NTZ``: a literal is what lets Spark prune hour partitions
at planning time and push ``extract_at > '<text>'`` into the Parquet reader
(row groups below the watermark are skipped), and text keeps the value
independent of the session time zone. The exact filter on the parsed change
time is always kept; the text filter is a redundant, necessary condition
(fixed-width ISO text sorts like time).

When the target's maximum is already known (partitioned tables log it when
they publish), ``high_watermark`` text is passed in and nothing is scanned.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.time import format_extract_at, parse_extract_at


def table_high_watermark(target: DataFrame, col: str = "extract_at") -> DataFrame:
    """One row, one column ``high_watermark``: max of ``col`` (null if empty)."""
    return target.agg(F.max(col).alias("high_watermark"))


def threshold_text(target: DataFrame, col: str = "extract_at", offset_hours: int = 0,
                   replay_hours: int = 0) -> str | None:
    """``max(col) + offset - replay`` as fixed-width text; None if the target is empty."""
    wm = F.max(col)
    delta = offset_hours - replay_hours
    if delta:
        wm = wm + F.make_dt_interval(F.lit(0), F.lit(delta))
    return target.agg(format_extract_at(wm).alias("t")).first()["t"]


def shift_text(text: str | None, hours: int) -> str | None:
    """Fixed-width change-time text moved by whole hours (naive arithmetic)."""
    if text is None or not hours:
        return text
    fmt = "%Y-%m-%d %H:%M:%S.%f"
    return (dt.datetime.strptime(text, fmt) + dt.timedelta(hours=hours)).strftime(fmt)


def above_watermark(
    bronze: DataFrame,
    target: DataFrame | None,
    col: str = "extract_at",
    offset_hours: int = 0,
    replay_hours: int = 0,
    high_watermark: str | None = None,
) -> DataFrame:
    """Change rows newer than the target's high watermark (minus replay).

    ``target is None``  -> every row (initial build).
    Empty target        -> every row: a null watermark means "load all", not
                           "load nothing".
    ``high_watermark``  -> the target's max ``col`` as text when already known
                           (e.g. from the table's publish log): no scan.
    """
    if target is None:
        return bronze
    if high_watermark is not None:
        text = shift_text(high_watermark, offset_hours - replay_hours)
    else:
        text = threshold_text(target, col, offset_hours, replay_hours)
    if text is None:
        return bronze
    return bronze.where(
        (F.col("extract_at") > F.lit(text))  # pushed into the Parquet scan
        & (parse_extract_at("extract_at") > F.lit(text).cast("timestamp_ntz"))
    )


def above_time(df: DataFrame, ts_col: str, target: DataFrame, target_col: str,
               high_watermark: str | None = None) -> DataFrame:
    """Rows whose ``ts_col`` is above max(target_col); all rows if the target is empty."""
    text = high_watermark
    if text is None:
        text = target.agg(format_extract_at(F.max(target_col)).alias("t")).first()["t"]
    if text is None:
        return df
    return df.where(F.col(ts_col) > F.lit(text).cast("timestamp_ntz"))
