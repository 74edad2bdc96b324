"""Silver jobs: bronze change feed -> latest image per key, merged into a table.

Plan of one run (``silver``):

    scan (op filter and text watermark pushed into Parquet)
      -> exact watermark filter (the watermark is a literal)
      -> conform (casts, defaults, UTC-3 shift, lineage)
      -> latest per key (partial WindowGroupLimit, one shuffle on the key)
      -> upsert (anti join on the key + union) when a target exists

``target=None`` is the initial / full-refresh build (no watermark, no merge).
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.config import ALL_OPS, LINEAGE_COLS, LOCAL_OFFSET_HOURS, ORDERDETAILS, ORDERS, TableSpec
from tidemark.functions.scalar import lineage_constants
from tidemark.operators.cdc import cdc_filter, conform, latest_per_key
from tidemark.operators.merge import upsert
from tidemark.functions.time import time_key
from tidemark.operators.watermark import above_watermark


def incremental_rows(bronze: DataFrame, spec: TableSpec, target: DataFrame | None,
                     high_watermark: str | None = None) -> DataFrame:
    """Operation filter + watermark with the spec's offset and replay window."""
    rows = cdc_filter(bronze, spec.ops)
    offset = LOCAL_OFFSET_HOURS if spec.shift_ts else 0
    return above_watermark(rows, target, "extract_at", offset, spec.replay_hours, high_watermark)


def silver_batch(spec: TableSpec, bronze: DataFrame, target: DataFrame | None = None,
                 dedupe: bool | None = None, high_watermark: str | None = None,
                 helpers: tuple[str, ...] = ()) -> DataFrame:
    """The rows one run merges: conformed, and deduped per key by default.

    ``helpers``: ordering helpers kept for the store (``_op``: the operation rank,
    with which a later batch breaks ties as this one does)."""
    rows = conform(incremental_rows(bronze, spec, target, high_watermark), spec)
    keep = [*spec.output_columns, *helpers]
    if spec.dedupe if dedupe is None else dedupe:
        # Constants need no shuffle, and the stored change time orders as ``_ts`` does.
        rows = latest_per_key(rows.drop("_ts", *LINEAGE_COLS), spec.keys, ts="extract_at", tiebreak=spec.tiebreak)
        constant = dict(zip(LINEAGE_COLS, lineage_constants(spec.name), strict=True))
        return rows.select(*(constant.get(c, F.col(c)) for c in keep))
    return rows.select(*keep)


def silver(spec: TableSpec, bronze: DataFrame, target: DataFrame | None = None,
           dedupe: bool | None = None) -> DataFrame:
    """Full silver table after one run (initial build when ``target`` is None)."""
    batch = silver_batch(spec, bronze, target, dedupe)
    if target is None:
        return batch
    return upsert(target.select(*spec.output_columns), batch, spec.keys)


def latest_orders(orders_bronze: DataFrame) -> DataFrame:
    """Latest image of every order over the whole order history (deletes too)."""
    rows = conform(cdc_filter(orders_bronze, ALL_OPS), ORDERS)
    return latest_per_key(rows, ORDERS.keys, tiebreak=ORDERS.tiebreak, keep=ORDERS.output_columns)


def order_dates(orders_bronze: DataFrame) -> DataFrame:
    """Order number and date of every order's latest image."""
    return latest_orders(orders_bronze).select("ordernumber", "orderdate")


def latest_lines(details_bronze: DataFrame, target: DataFrame | None = None,
                 high_watermark: str | None = None, helpers: tuple[str, ...] = (),
                 ops: tuple[str, ...] = ORDERDETAILS.ops) -> DataFrame:
    """Latest image of the order lines of one run, without the order's date."""
    spec = replace(ORDERDETAILS, ops=ops, columns=tuple(c for c in ORDERDETAILS.columns if c[0] != "orderdate"))
    return silver_batch(spec, details_bronze, target, high_watermark=high_watermark, helpers=helpers)


def silver_orderdetails_batch(details_bronze: DataFrame, dates: DataFrame,
                              target: DataFrame | None = None, high_watermark: str | None = None,
                              helpers: tuple[str, ...] = (), ops: tuple[str, ...] = ORDERDETAILS.ops) -> DataFrame:
    """Order lines of one run, each with the date of its order from ``dates``
    (ordernumber, orderdate; one row per order).

    Lines are deduped *before* the join (the order side is unique per order
    number, so the result is the same). A line whose order is unknown keeps a
    null order date.
    """
    lines = latest_lines(details_bronze, target, high_watermark, helpers, ops)
    joined = lines.join(dates.select("ordernumber", "orderdate"), "ordernumber", "left")
    return joined.select(*ORDERDETAILS.output_columns, *helpers)


def silver_orderdetails(details_bronze: DataFrame, orders_bronze: DataFrame,
                        target: DataFrame | None = None, dates: DataFrame | None = None) -> DataFrame:
    """Full order-line table after one run. ``dates``: order dates that are stored
    already (the silver orders), instead of the whole order history."""
    dates = order_dates(orders_bronze) if dates is None else dates
    batch = silver_orderdetails_batch(details_bronze, dates, target)
    if target is None:
        return batch
    return upsert(target.select(*ORDERDETAILS.output_columns), batch, ORDERDETAILS.keys)


def with_partition(df: DataFrame, spec: TableSpec, grain: str = "hour") -> DataFrame:
    """Add the derived partition value (text of the source column at ``grain``)."""
    if spec.partition is None:
        return df
    col, src = spec.partition
    return df.withColumn(col, time_key(src, grain))
