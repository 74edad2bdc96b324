"""Maintenance by what changed: line dates and mart groups.

A ``Lakehouse(..., maintain=True)`` writes, before each merge, what the merge is about to
change into two change logs beside the tables:

* ``moved``    per merged order: its number, the date of its stored image (null if it is
               new) and its new date;
* ``touched``  the order dates whose mart groups the merge may change: old and new dates
               of merged orders, dates of merged lines' orders.

``repair_lines`` gives lines the dates of orders that came or moved after them, without
any change of the lines: such lines lie in the partition of null dates or in those of the
orders' old dates, so only these are read. ``recompute_groups`` builds the mart's groups
of the touched dates anew, from the order and line partitions of those dates, and
replaces them; groups that are left without lines go, other dates are neither read nor
written (but for those that share a month partition of the mart).

A log entry is one small written table. It is there before its merge changes anything and
is removed only after its reader's table is in place, so a run that dies in between leaves
entries that the next run reads again; both readers build what the tables hold by then, so
reading an entry twice changes nothing. A full refresh of the mart clears what it covers.
Changes of customers, employees and offices are not followed (``recompute_from`` is for
these).
"""

from __future__ import annotations

import uuid
from typing import TYPE_CHECKING

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.config import GOLD_KEYS, SPECS
from tidemark.functions.time import format_extract_at, time_key
from tidemark.operators.merge import assert_unique_keys, partition_in, upsert
from tidemark.plans.gold import gold_batch
from tidemark.plans.silver import with_partition
from tidemark.sources.files import Files
from tidemark.sources.storage import materialize

if TYPE_CHECKING:
    from tidemark.plans.jobs import Lakehouse

NTZ = T.TimestampNTZType()
MOVED = T.StructType([T.StructField("ordernumber", T.LongType()), T.StructField("old_date", NTZ), T.StructField("new_date", NTZ)])
TOUCHED = T.StructType([T.StructField("orderdate", NTZ)])


class ChangeLog:
    """Written tables of one schema, kept until their reader is done with them."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType):
        self.spark, self.path, self.schema = spark, path, schema
        self.files = Files(spark)

    def append(self, rows: DataFrame) -> DataFrame:
        path = f"{self.path}/{uuid.uuid4().hex}"
        rows.select(*self.schema.fieldNames()).write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(self.schema).parquet(path)

    def entries(self) -> list[str]:
        """Entries that are written whole; one that a lost run left half written belongs
        to a merge that changed nothing."""
        return [n for n in self.files.names(self.path) if self.files.exists(f"{self.path}/{n}/_SUCCESS")]

    def read(self, entries: list[str]) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(*(f"{self.path}/{n}" for n in entries))

    def clear(self, entries: list[str]) -> None:
        for n in entries:
            self.files.delete(f"{self.path}/{n}")


def moved_log(house: Lakehouse) -> ChangeLog:
    return ChangeLog(house.spark, f"{house.root}/changes/moved", MOVED)


def touched_log(house: Lakehouse) -> ChangeLog:
    return ChangeLog(house.spark, f"{house.root}/changes/touched", TOUCHED)


def record(house: Lakehouse, table: str, target: DataFrame | None, rows: DataFrame) -> None:
    """Log what merging ``rows`` into ``target`` is about to change."""
    if table == "orders":
        new = rows.select("ordernumber", F.col("orderdate").alias("new_date"))
        if target is None:
            changes = new.withColumn("old_date", F.lit(None).cast(NTZ))
        else:
            changes = new.join(target.select("ordernumber", F.col("orderdate").alias("old_date")), "ordernumber", "left")
        changes = moved_log(house).append(changes)
        dates = changes.select(F.explode(F.array("old_date", "new_date")).alias("orderdate"))
    elif table == "orderdetails":
        dates = rows.select("orderdate")
    else:
        return
    touched_log(house).append(dates.where("orderdate is not null").distinct())


def partitions_of(dates: DataFrame, col: str, grain: str) -> set[str]:
    """Partition values of dates; never more than the table has partitions."""
    return {r[0] for r in dates.select(time_key(col, grain).alias("p")).distinct().collect()}


def repair_lines(house: Lakehouse) -> None:
    """Give lines the current dates of orders that came or moved since the last repair."""
    log, spec, store = moved_log(house), SPECS["orderdetails"], house.stored("orderdetails")
    entries = log.entries()
    lines = store.read()
    if not entries or lines is None:
        log.clear(entries)
        return
    columns = [c for c in store.schema.fieldNames() if c not in store.constants]
    lines = lines.select(*columns)
    moved = materialize(log.read(entries).where("not (old_date <=> new_date)").distinct(), "moved-orders")
    held_in = partitions_of(moved.where("old_date is not null"), "old_date", house.grain) | {None}
    now_in = partitions_of(moved.where("new_date is not null"), "new_date", house.grain)
    orders, p = house.stored("orders"), store.partition_col
    current = orders.read().where(partition_in(orders.partition_col, now_in)).select("ordernumber", F.col("orderdate").alias("_date"))
    current = current.join(moved.select("ordernumber").distinct(), "ordernumber", "left_semi")
    stale = lines.where(partition_in(p, held_in)).join(current, "ordernumber").where("not (orderdate <=> _date)")
    fixed = with_partition(stale.withColumn("orderdate", F.col("_date")), spec, house.grain).select(*columns)
    fixed = materialize(fixed, "repaired-lines")
    if not fixed.isEmpty():
        touched_log(house).append(fixed.select("orderdate").distinct())
        house.locator("orderdetails").add(fixed)
        into = {r[0] for r in fixed.select(p).distinct().collect()}
        merged = upsert(lines.where(partition_in(p, held_in | into)), fixed, spec.keys)
        store.replace_partitions(merged, (), store.high_watermark(), held_in)
    log.clear(entries)


def touched_groups(house: Lakehouse, dates: DataFrame) -> DataFrame:
    """The mart's groups of ``dates`` (one column, distinct), from their partitions alone."""
    wanted = partitions_of(dates, "orderdate", house.grain)
    orders = house.live("orders").where(partition_in(house.stored("orders").partition_col, wanted))
    orders = orders.join(dates, "orderdate", "left_semi")
    lines = house.live("orderdetails").where(partition_in(house.stored("orderdetails").partition_col, wanted))
    lines = lines.join(orders.select("ordernumber"), "ordernumber", "left_semi")
    return gold_batch(lines, orders, *(house.silver_table(t) for t in ("customers", "employees", "offices")))


def recompute_groups(house: Lakehouse, month_col: str) -> None:
    """Build the groups of all touched dates anew and replace them in the mart."""
    repair_lines(house)
    log, mart = touched_log(house), house.gold.read()
    entries = log.entries()
    if not entries:
        return
    dates = materialize(log.read(entries).where("orderdate is not null").distinct(), "touched-dates")
    months = partitions_of(dates, "orderdate", "month")
    month = time_key("calendar_sales_date", "month")
    batch = touched_groups(house, dates).withColumn(month_col, month)
    kept = mart.where(partition_in(month_col, months))
    kept = kept.join(dates.withColumnRenamed("orderdate", "calendar_sales_date"), "calendar_sales_date", "left_anti")
    rows = materialize(kept.select(*batch.columns).unionByName(batch), "mart-groups")
    assert_unique_keys(rows, GOLD_KEYS)
    last = rows.agg(format_extract_at(F.max("calendar_sales_date")).alias("m")).first()["m"]
    left = {r[0] for r in rows.select(month_col).distinct().collect()}
    house.replace_mart(rows, [v for v in house.gold.partitions() if v in months and v not in left], last)
    log.clear(entries)
