"""Bronze -> silver -> gold as one Spark application.

Each step reads back what the previous one wrote (``sources.storage``), so a
failed step can be rerun alone and a rerun of a finished batch changes
nothing. Silver scans list only the landing hours at or above each
table's watermark (minus its replay window); merges into the hour- and
month-partitioned tables rewrite only the partitions a batch touches.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.config import ALL_OPS, GOLD_KEYS, LINEAGE_COLS, LOCAL_OFFSET_HOURS, OP_DELETE, OP_RANK, SPECS
from tidemark.functions.scalar import lineage_constants
from tidemark.functions.time import format_extract_at, time_key
from tidemark.operators.merge import assert_unique_keys, newer_source, partition_in, upsert_partitions
from tidemark.operators.watermark import shift_text
from tidemark.plans.dashboards import Dashboards
from tidemark.plans.gold import gold_batch, gold_recompute
from tidemark.plans.maintain import record, recompute_groups, repair_lines, touched_log
from tidemark.plans.silver import silver_batch, silver_orderdetails_batch, with_partition
from tidemark.sources import bronze as B
from tidemark.sources.feeds import feed
from tidemark.sources.files import Files
from tidemark.sources.locator import KeyLocator
from tidemark.sources.schemas import GOLD_SCHEMA, create_table_ddl, silver_schema
from tidemark.sources.storage import StoredTable, materialize, materialize_with, scratch_dir

SILVER_TABLES = ("customers", "employees", "offices", "orders", "products", "orderdetails")
GOLD_INPUTS = ("orderdetails", "orders", "customers", "employees", "offices")
MART_PARTITION = "sales_month"
WHOLE = "part"  # constant partition of the dimension tables


class Lakehouse:
    """Zone roots of one deployment: bronze path, silver and gold tables.

    Orders and order lines are partitioned by the hour of the order date and
    the mart by month, as in the table DDL; a run rewrites only the
    partitions its batch touches. The small dimension tables are one partition
    each.
    """

    def __init__(self, spark: SparkSession, root: str, partition_grain: str = "hour", layout: str = "kv",
                 maintain: bool = False, apply_deletes: bool = False, dashboards: bool = False):
        """``partition_grain`` of orders and order lines: ``hour`` (the table
        DDL; right when an hour holds enough data and a batch touches few
        hours), ``day`` or ``month`` for sparse histories. ``layout`` of the
        landed hours: see ``scan_bronze``.

        ``maintain``: line dates and mart groups follow late and changed orders and
        lines (``plans.maintain``), instead of staying as they were first loaded.

        ``apply_deletes``: a key whose newest image is a delete is no row of its table.
        The image stays stored as a tombstone, so that an older image that comes late, or
        again, does not bring the key back; a newer insert does. All merges then go by
        the newest image. To be used from a table's first run on.

        ``dashboards``: keep the dashboard sums of the mart's months (``plans.dashboards``)
        with every change of the mart."""
        self.spark = spark
        self.maintain = maintain
        self.apply_deletes = apply_deletes
        self.root = root.rstrip("/")
        self.grain = partition_grain
        self.layout = layout
        self.bronze_root = f"{self.root}/bronze"
        self.gold = StoredTable(
            spark, f"{self.root}/gold/sales_dataset",
            T.StructType(GOLD_SCHEMA.fields + [T.StructField(MART_PARTITION, T.StringType())]),
            MART_PARTITION)
        self.dashboards = Dashboards(self) if dashboards else None

    def stored(self, table: str) -> StoredTable:
        """The silver table as stored: its columns, the operation rank of each row's
        image and the partition value."""
        spec = SPECS[table]
        col = spec.partition[0] if spec.partition else WHOLE
        schema = T.StructType(silver_schema(table).fields
                              + [T.StructField("_op", T.IntegerType()), T.StructField(col, T.StringType())])
        return StoredTable(self.spark, f"{self.root}/silver/{table}", schema, col,
                           dict(zip(LINEAGE_COLS, lineage_constants(table), strict=True)))

    def locator(self, table: str) -> KeyLocator:
        """Where the keys of a table that is partitioned by a date are. Both tables go by
        the order number: the lines of an order lie together but for few, so its places
        are theirs."""
        store = self.stored(table)
        path = f"{self.root}/silver/_keys/{table}" + ("" if table == "orders" else "-by-order")
        return KeyLocator(self.spark, path, store.schema, SPECS[table].keys[:1], store.partition_col,
                          repeated=len(SPECS[table].keys) > 1)

    # -- bronze -------------------------------------------------------------------
    def land(self, sf_dir: str, tables: Sequence[str] = SILVER_TABLES) -> None:
        """Land the feeds that the test tables stand for (rerun-safe). Their histories
        are thousands of tiny hours, which all cores write side by side."""
        tasks = self.spark.sparkContext.defaultParallelism
        for t in tables:
            B.land_hourly(feed(self.spark, sf_dir, t), self.bronze_root, t, num_tasks=tasks, files_per_hour=1, replace=True)

    def register_hour(self, run_at: dt.datetime, overrides: dict | None = None, database: str = "raw") -> None:
        """The scheduled bronze step: register the run's landing hour of every table."""
        for t in SILVER_TABLES:
            B.activate_partition(self.spark, self.bronze_root, t, run_at, overrides, database, self.layout)

    def bronze(self, table: str, high_watermark: str | None = None) -> DataFrame:
        """Landed changes of ``table``; with a watermark, of the hours that the next
        run can need."""
        since = None
        if high_watermark is not None:
            spec = SPECS[table]
            offset = LOCAL_OFFSET_HOURS if spec.shift_ts else 0
            since = shift_text(high_watermark, offset - spec.replay_hours)
        return B.scan_bronze(self.spark, self.bronze_root, table, since=since, layout=self.layout)

    # -- silver -------------------------------------------------------------------
    def live(self, table: str) -> DataFrame | None:
        """The stored rows of a table with their helpers, without tombstones."""
        df = self.stored(table).read()
        return df.where(F.col("_op") != OP_RANK[OP_DELETE]) if df is not None and self.apply_deletes else df

    def silver_table(self, table: str) -> DataFrame | None:
        df = self.live(table)
        return None if df is None else df.select(*SPECS[table].output_columns)

    def run_silver(self, tables: Sequence[str] = SILVER_TABLES, full_refresh: bool = False) -> None:
        for t in tables:
            store = self.stored(t)
            wm = None if full_refresh else store.high_watermark()
            self.merge(t, self.batch(t, self.bronze(t, wm), wm), full_refresh=full_refresh)
        if self.maintain:
            repair_lines(self)

    def batch(self, table: str, changes: DataFrame, high_watermark: str | None = None) -> DataFrame:
        """Latest images among ``changes`` above the watermark, as stored rows."""
        spec = SPECS[table]
        target = None if high_watermark is None else changes  # the watermark is known: no table is read for it
        if table == "orderdetails":
            dates = self.silver_table("orders")  # refreshed before the lines in every run
            if dates is None:
                dates = self.spark.createDataFrame([], silver_schema("orders"))
            return silver_orderdetails_batch(changes, dates, target, high_watermark, helpers=("_op",),
                                             ops=ALL_OPS if self.apply_deletes else spec.ops)
        if self.apply_deletes:
            spec = replace(spec, ops=ALL_OPS)
        return silver_batch(spec, changes, target, high_watermark=high_watermark, helpers=("_op",))

    def merge(self, table: str, batch: DataFrame, newer_only: bool = False, full_refresh: bool = False) -> None:
        """Merge a batch into its table. The batch is computed once and written; its
        keys must be unique. ``newer_only``: an image replaces another only if it is
        newer by time, operation and payload, in whatever order batches come."""
        spec, store = SPECS[table], self.stored(table)
        if full_refresh:
            store.forget()
        rows = with_partition(batch, spec, self.grain) if spec.partition else batch.withColumn(WHOLE, F.lit("all"))
        columns = [c for c in store.schema.fieldNames() if c not in store.constants]
        rows, seen = materialize_with(rows.select(*columns), f"batch-{table}", format_extract_at(F.max("extract_at")).alias("last"))
        last = seen["last"]
        if last is None and not full_refresh:
            return  # nothing new
        assert_unique_keys(rows, spec.keys)
        target, places, near = None if full_refresh else store.read(), None, None
        target = None if target is None else target.select(*columns)
        locator = self.locator(table) if spec.partition else None
        if locator and target is None:
            locator.forget()
        if target is not None:
            near = target  # the rows that may have a key of the batch
            if locator:
                if not locator.exists():
                    locator.add(target)
                places = locator.places(rows)
                near = target.where(partition_in(store.partition_col, places))
        if (newer_only or self.apply_deletes) and target is not None:
            rows = materialize(newer_source(near, rows, spec.keys, ["extract_at", "_op", *spec.tiebreak]), f"newer-{table}")
        if self.maintain:
            record(self, table, near, rows)
        if locator:
            locator.add(rows)
        if full_refresh:
            present = {r[0] for r in rows.select(store.partition_col).distinct().collect()}
            store.replace_partitions(rows, [v for v in store.partitions() if v not in present], last)
        else:
            merged, covered = upsert_partitions(target, rows, spec.keys, store.partition_col, spec.partition is not None, places)
            store.replace_partitions(merged, (), last, covered)

    # -- gold ---------------------------------------------------------------------
    def mart(self) -> DataFrame | None:
        df = self.gold.read()
        return None if df is None else df.select(*GOLD_SCHEMA.fieldNames())

    def replace_mart(self, rows: DataFrame, emptied: Sequence[str | None], high_watermark: str | None) -> None:
        """Replace the mart's partitions of ``rows``, a written table, and remove ``emptied``."""
        if self.dashboards:
            self.dashboards.announce({r[0] for r in rows.select(MART_PARTITION).distinct().collect()} | set(emptied))
        self.gold.replace_partitions(rows, emptied, high_watermark)

    def run_gold(self, full_refresh: bool = False, recompute_from: str | None = None) -> None:
        """See ``build_gold``; the dashboard sums follow, if they are kept."""
        self.build_gold(full_refresh, recompute_from)
        if self.dashboards:
            self.dashboards.refresh()

    def build_gold(self, full_refresh: bool = False, recompute_from: str | None = None) -> None:
        """Add the order dates above the mart's newest; or build the mart, or its
        dates from ``recompute_from`` on, anew (late orders and lines count then).
        A mart that has no finished run is built whole, whatever date is given. With
        ``maintain`` the groups of all dates that changed since the last run are built
        anew, those of new dates included."""
        stored = self.gold.read()
        wm = None if full_refresh or stored is None else self.gold.high_watermark()
        if self.maintain:
            if wm is not None and recompute_from is None:
                recompute_groups(self, MART_PARTITION)
                return
            repair_lines(self)
        logged = touched_log(self).entries() if self.maintain and wm is None else []
        inputs = [self.silver_table(t) for t in GOLD_INPUTS]
        month = time_key("calendar_sales_date", "month")
        low = ""  # first month that is built anew
        if wm is None:
            batch = gold_batch(*inputs)
        elif recompute_from is not None:
            low = recompute_from[:7].replace("-", "")
            inputs[1] = self.orders_from(recompute_from)
            batch = gold_recompute(*inputs, target=stored.where(F.col(MART_PARTITION) >= low), since=recompute_from)
        else:
            inputs[1] = self.orders_from(wm)
            batch = gold_batch(*inputs, target=stored, high_watermark=wm)
        rows = materialize(batch.withColumn(MART_PARTITION, month), "batch-mart")
        last = rows.agg(format_extract_at(F.max("calendar_sales_date")).alias("m")).first()["m"]
        assert_unique_keys(rows, GOLD_KEYS)
        if wm is None or recompute_from is not None:
            present = {r[0] for r in rows.select(MART_PARTITION).distinct().collect()}
            gone = [v for v in self.gold.partitions() if (low if v is None else v) >= low and v not in present]
            if full_refresh:
                self.gold.forget()
            self.replace_mart(rows, gone, last)
            touched_log(self).clear(logged)
        elif last is not None:
            merged, _ = upsert_partitions(stored, rows, GOLD_KEYS, MART_PARTITION, movable=False)
            self.replace_mart(merged, (), last)

    def orders_from(self, text: str) -> DataFrame:
        """Orders of the partitions that can hold order dates from ``text`` on."""
        digits = re.sub(r"\D", "", text)[: {"hour": 10, "day": 8, "month": 6}[self.grain]]
        col = self.stored("orders").partition_col
        return self.live("orders").where(F.col(col) >= digits).select(*SPECS["orders"].output_columns)

    # -- catalog ------------------------------------------------------------------
    def register_catalog(self, raw: str = "raw", ods: str = "ods", dwh: str = "dwh") -> None:
        """Declare every zone's tables in the session catalog at their roots and
        register the partitions found there. Tables that have not landed yet are left
        out. A table of the same name that lies elsewhere is an error, before anything
        is declared, and stays as it is."""
        files = Files(self.spark)
        stores = [(dwh, "sales_dataset", self.gold)] + [(ods, t, self.stored(t)) for t in SILVER_TABLES]
        landed = [t for t in SILVER_TABLES if files.exists(B.table_root(self.bronze_root, t))]
        stores = [(db, name, store) for db, name, store in stores if store.read() is not None]
        for db in (raw, ods, dwh):
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}")
        for db, name, path in [(db, name, store.path) for db, name, store in stores] + [(raw, t, B.table_root(self.bronze_root, t)) for t in landed]:
            B.refuse_foreign_table(self.spark, db, name, path)
        for t in landed:
            B.recover_partitions(self.spark, self.bronze_root, t, raw)
        for db, name, store in stores:
            self.spark.sql(create_table_ddl(db, name, store.schema, store.path, partitioned_by=(store.partition_col,)))
            self.spark.sql(f"MSCK REPAIR TABLE {db}.{name} SYNC PARTITIONS")

    def run(self, steps: Sequence[str] = ("bronze", "silver", "gold"), sf_dir: str | None = None,
            full_refresh: bool = False, recompute_from: str | None = None,
            run_at: dt.datetime | None = None, overrides: dict | None = None) -> None:
        """Run the steps in order; the first failure stops the run.

        bronze  registers the landing hour of ``run_at`` (with ``overrides``); with
                ``sf_dir`` it first lands the test tables' feeds
        silver  merges what landed since each table's watermark (``full_refresh``:
                builds the tables anew)
        gold    see ``run_gold``
        """
        unknown = [s for s in steps if s not in ("bronze", "silver", "gold")]
        if unknown:
            raise ValueError(f"unknown step(s) {unknown}")
        for step in steps:
            if step == "bronze":
                if sf_dir is None and run_at is None:
                    raise ValueError("the bronze step needs a run time or a source directory")
                if sf_dir is not None:
                    self.land(sf_dir)
                if run_at is not None:
                    self.register_hour(run_at, overrides)
            elif step == "silver":
                self.run_silver(full_refresh=full_refresh)
            else:
                self.run_gold(full_refresh, recompute_from)


def pipeline_bronze_to_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The driver's order history spans seven years with a handful of orders
    # per hour: month partitions keep files at a sensible size.
    house = Lakehouse(spark, scratch_dir(spark, "lakehouse"), partition_grain="month")
    house.run(("bronze", "silver", "gold"), sf_dir=sf_dir)
    return house.mart()


def _register() -> None:
    from tidemark.plans.catalog import QUERIES
    QUERIES["pipeline_bronze_to_gold"] = pipeline_bronze_to_gold


_register()
