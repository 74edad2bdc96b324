"""Query catalogue: one named query per operator of the pipeline.

Every query takes ``(spark, sf_dir)``, derives the change feeds from the
driver's tables in ``sf_dir`` (``sources.feeds``) and returns a DataFrame over
all of their rows. The matching DuckDB oracle text is in ``plans.oracle``.
Queries that land files (bronze, pipeline, stream) write below the shared
checkpoint directory of the session, in a fresh folder per call.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.config import (
    ALL_OPS,
    CUSTOMERS,
    EMPLOYEES,
    ORDERDETAILS,
    ORDERS,
    PARTITION_COLS,
    SPECS,
    UPSERT_OPS,
)
from tidemark.functions import scalar as S
from tidemark.functions import time as T
from tidemark.operators.cdc import cdc_filter, latest_per_key, op_rank
from tidemark.operators.merge import upsert
from tidemark.operators.watermark import above_watermark, table_high_watermark
from tidemark.plans import gold as G
from tidemark.plans.silver import latest_lines, latest_orders, silver, silver_batch, silver_orderdetails
from tidemark.sources import bronze as B
from tidemark.sources.drift import schema_drift
from tidemark.sources.feeds import feed
from tidemark.sources.schemas import BRONZE_PAYLOAD
from tidemark.sources.storage import materialize, scratch_dir

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Fixed split points of the history, used to build "previous run" targets:
# change text for the versioned feeds, change text for order lines, and the
# mart's order date.
FEED_CUTOFF = "2024-01-08 00:00:00.000000"
DETAILS_CUTOFF = "1999-01-01 00:00:00.000000"
GOLD_CUTOFF = "1998-01-01 00:00:00"
# Partitions of a spreading shuffle before AQE packs or splits them; up to 200, Spark's
# shuffle writers stream rows to files instead of keeping them.
SPREAD = 200


def query(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return deco


# --- shared building blocks -------------------------------------------------------

def silver_table(spark: SparkSession, d: str, name: str) -> DataFrame:
    if name == "orderdetails":
        return silver_orderdetails(feed(spark, d, "orderdetails"), feed(spark, d, "orders"))
    return silver(SPECS[name], feed(spark, d, name))


def gold_inputs(spark: SparkSession, d: str) -> tuple[DataFrame, ...]:
    # The mart takes order dates from the orders table; the lines come without.
    return (latest_lines(feed(spark, d, "orderdetails")),) + tuple(
        silver_table(spark, d, t) for t in ("orders", "customers", "employees", "offices"))


def raw_tiebreak(table: str) -> list[str]:
    keys = SPECS[table].keys
    return [n for n, _ in BRONZE_PAYLOAD[table] if n not in keys]


def latest_raw(spark: SparkSession, d: str, table: str) -> DataFrame:
    """Newest landed image per key, as landed (a pure top-1-per-group)."""
    spec = SPECS[table]
    rows = cdc_filter(feed(spark, d, table), spec.ops).select(
        "*", T.parse_extract_at().alias("_ts"), op_rank().alias("_op"))
    # Wide rows: a scan task may hold a large row group and would sort all its images for the
    # limit per key. Spread by key and time they come in bounded tasks, a hot key's too.
    rows = rows.hint("rebalance", SPREAD, *spec.keys, "_ts")
    return latest_per_key(rows, spec.keys, tiebreak=raw_tiebreak(table)).drop("_ts", "_op")


# --- bronze -------------------------------------------------------------------------

@query("bronze_partition_values")
def q_bronze_partition_values(spark, d):
    f = feed(spark, d, "orders")
    return f.select("ordernumber", "op", "extract_at",
                    *T.partition_values(T.parse_extract_at()))


@query("bronze_land_hourly")
def q_bronze_land_hourly(spark, d):
    root = scratch_dir(spark, "bronze")
    B.land_hourly(feed(spark, d, "orders").drop(*PARTITION_COLS), root, "orders")
    return B.scan_bronze(spark, root, "orders")


@query("bronze_scan")
def q_bronze_scan(spark, d):
    root = scratch_dir(spark, "bronze")
    B.land_hourly(feed(spark, d, "orderdetails"), root, "orderdetails")
    return B.scan_bronze(spark, root, "orderdetails")


@query("bronze_partition_inventory")
def q_bronze_partition_inventory(spark, d):
    root, out = scratch_dir(spark, "bronze"), None
    for t in SPECS:
        B.land_hourly(feed(spark, d, t), root, t)
        one = B.partition_inventory(B.scan_bronze(spark, root, t), t)
        out = one if out is None else out.unionByName(one)
    return out


# The only scheduled hour whose registrations took place, in the reconciliation query.
REGISTERED_HOUR = "03"


@query("bronze_unregistered_hours")
def q_bronze_unregistered_hours(spark, d):
    """All landed hours of all feeds against a catalog that knows those of one schedule."""
    root, out = scratch_dir(spark, "bronze"), None
    db = "raw_" + root.rsplit("-", 1)[1]
    for t in SPECS:
        f = feed(spark, d, t)
        B.land_hourly(f, root, t, num_tasks=spark.sparkContext.defaultParallelism, files_per_hour=1)
        B.register_table(spark, root, t, db)
        known = f.where(F.col("hour_stream") == REGISTERED_HOUR).select(*PARTITION_COLS).distinct().collect()
        for stmt in B.register_partitions_sql(t, root, [tuple(r) for r in known], db):
            spark.sql(stmt)
        one = B.hours_status(spark, root, t, db)
        out = one if out is None else out.unionByName(one)
    spark.sql(f"DROP DATABASE {db} CASCADE")  # the tables are external; the landed files stay
    return out


@query("bronze_backfill_fixed_partition")
def q_bronze_backfill(spark, d):
    root = scratch_dir(spark, "bronze")
    manifest = scratch_dir(spark, "manifest")
    B.drop_full_load(feed(spark, d, "products"), root, "products")
    B.backfill(spark, root, "products", manifest)
    B.backfill(spark, root, "products", manifest)  # rerun: lands nothing twice
    return B.scan_bronze(spark, root, "products")


@query("bronze_backfill_to_silver")
def q_bronze_backfill_to_silver(spark, d):
    """A full load that arrives when the table's watermark is later than the fixed
    partition: its rows must reach silver by their own change times."""
    house = _jobs.Lakehouse(spark, scratch_dir(spark, "late-load"), partition_grain="month")
    f = feed(spark, d, "products")
    later = f.withColumn("extract_at", F.regexp_replace("extract_at", "^2024", "2026"))
    early, rest = later.where("extract_at <= '2026-01-03'"), later.where("extract_at > '2026-01-03'")
    B.land_hourly(early.drop(*PARTITION_COLS), house.bronze_root, "products", replace=True)
    house.run_silver(["products"])
    B.drop_full_load(rest, house.bronze_root, "products")
    B.backfill(spark, house.bronze_root, "products", f"{house.root}/manifest")
    house.run_silver(["products"])
    return house.silver_table("products")


@query("partition_transform_hour")
def q_partition_transform_hour(spark, d):
    o = silver_table(spark, d, "orders")
    return o.select("ordernumber", "orderdate",
                    T.hour_bucket("orderdate").cast("timestamp_ntz").alias("orderdate_hour"))


@query("partition_transform_month")
def q_partition_transform_month(spark, d):
    g = G.gold_sales(*gold_inputs(spark, d))
    return g.select("locality_officecode", "interval_portsales", "calendar_sales_date",
                    T.month_bucket("calendar_sales_date").cast("timestamp_ntz").alias("sales_month"))


# --- scalar -------------------------------------------------------------------------

@query("lineage_constants")
def q_lineage_constants(spark, d):
    out = None
    for t, spec in SPECS.items():
        key = F.concat_ws("/", *[F.col(k).cast("string") for k in spec.keys]).alias("key")
        one = feed(spark, d, t).select(key, "extract_at", *S.lineage_constants(t))
        out = one if out is None else out.unionByName(one)
    return out


@query("null_default_salesrep")
def q_null_default_salesrep(spark, d):
    return feed(spark, d, "customers").select(
        "customernumber", "extract_at",
        S.null_to_zero("salesrepemployeenumber").alias("salesrepemployeenumber"))


@query("null_default_reportsto")
def q_null_default_reportsto(spark, d):
    return feed(spark, d, "employees").select(
        "employeenumber", "extract_at", S.null_to_zero("reportsto").alias("reportsto"))


@query("blank_to_null_state")
def q_blank_to_null_state(spark, d):
    return feed(spark, d, "offices").select(
        "officecode", "extract_at", "state", S.blank_to_null("state").alias("locality_state"))


@query("bucket_portsales")
def q_bucket_portsales(spark, d):
    f = feed(spark, d, "orderdetails")
    amount = S.line_amount("quantityordered", "priceeach")
    return f.select("ordernumber", "productcode", "orderlinenumber", "extract_at",
                    amount.alias("amount"), S.sale_bucket(amount).alias("interval_portsales"))


@query("cast_officecode")
def q_cast_officecode(spark, d):
    off = feed(spark, d, "offices").select(
        F.lit("offices").alias("dataset"), "extract_at", F.col("officecode").alias("officecode_text"))
    emp = feed(spark, d, "employees").select(
        F.lit("employees").alias("dataset"), "extract_at", F.col("officecode").alias("officecode_text"))
    both = off.unionByName(emp)
    return both.select("*", F.col("officecode_text").cast("bigint").alias("officecode"))


@query("cast_prices")
def q_cast_prices(spark, d):
    return feed(spark, d, "products").select(
        "productcode", "extract_at",
        F.col("buyprice").cast("double").alias("buyprice"),
        F.col("msrp").cast("double").alias("msrp"))


@query("line_amount")
def q_line_amount(spark, d):
    return feed(spark, d, "orderdetails").select(
        "ordernumber", "productcode", "orderlinenumber", "extract_at", "quantityordered",
        F.col("priceeach").cast("double").alias("priceeach"),
        S.line_amount("quantityordered", "priceeach").alias("amount"))


@query("parse_extract_at")
def q_parse_extract_at(spark, d):
    return feed(spark, d, "orders").select(
        "ordernumber", "extract_at", T.parse_extract_at().alias("extract_ts"))


@query("shift_utc_minus_3")
def q_shift_utc_minus_3(spark, d):
    return feed(spark, d, "orders").select(
        "ordernumber", "extract_at",
        T.shift_local(T.parse_extract_at()).alias("extract_local"),
        T.shift_local("orderdate").alias("orderdate_local"))


@query("order_year_month")
def q_order_year_month(spark, d):
    local = T.shift_local("orderdate")
    return feed(spark, d, "orders").select(
        "ordernumber", "extract_at", local.alias("orderdate"),
        T.year_month(local).alias("orderyearmonth"))


@query("calendar_attributes")
def q_calendar_attributes(spark, d):
    o = silver_table(spark, d, "orders")
    return o.select("ordernumber", "orderdate", *T.calendar_attributes("orderdate"))


# --- filters ------------------------------------------------------------------------

@query("cdc_filter_iu")
def q_cdc_filter_iu(spark, d):
    return cdc_filter(feed(spark, d, "customers"), UPSERT_OPS)


@query("cdc_filter_iud")
def q_cdc_filter_iud(spark, d):
    return cdc_filter(feed(spark, d, "orders"), ALL_OPS)


@query("table_high_watermark")
def q_table_high_watermark(spark, d):
    out = None
    for name in ("customers", "employees", "offices", "orders", "products", "orderdetails"):
        one = table_high_watermark(silver_table(spark, d, name)).select(
            F.lit(name).alias("dataset"), "high_watermark")
        out = one if out is None else out.unionByName(one)
    return out


# Targets of incremental runs are read twice (watermark subquery and merge),
# so they are written once like a stored table (``materialize``); targets read
# once stay lazy.


def _before(df: DataFrame, cutoff: str) -> DataFrame:
    return df.where(F.col("extract_at") <= cutoff)


@query("watermark_filter_shifted")
def q_watermark_filter_shifted(spark, d):
    f = feed(spark, d, "orders")
    target = silver(ORDERS, _before(f, FEED_CUTOFF))
    return above_watermark(cdc_filter(f, ORDERS.ops), target, "extract_at",
                           offset_hours=3, replay_hours=ORDERS.replay_hours)


@query("watermark_filter_exact")
def q_watermark_filter_exact(spark, d):
    f = feed(spark, d, "orderdetails")
    target = silver_orderdetails(_before(f, DETAILS_CUTOFF), feed(spark, d, "orders"))
    return above_watermark(cdc_filter(f, ORDERDETAILS.ops), target, "extract_at", 0, 0)


# --- windows ------------------------------------------------------------------------

for _t in ("customers", "offices", "orders", "products", "orderdetails"):
    QUERIES[f"latest_{_t}"] = (lambda t: lambda spark, d: latest_raw(spark, d, t))(_t)


# --- joins --------------------------------------------------------------------------

@query("join_details_orders_left")
def q_join_details_orders_left(spark, d):
    lines = cdc_filter(feed(spark, d, "orderdetails"), UPSERT_OPS).select(
        "ordernumber", "productcode", "orderlinenumber", "op", "extract_at", "quantityordered")
    dates = latest_orders(feed(spark, d, "orders")).select("ordernumber", "orderdate")
    return lines.join(dates, "ordernumber", "left")


@query("join_details_orders_inner")
def q_join_details_orders_inner(spark, d):
    od = silver_table(spark, d, "orderdetails").select(
        "ordernumber", "productcode", "orderlinenumber", "quantityordered", "amount")
    o = silver_table(spark, d, "orders").select("ordernumber", "orderdate", "customernumber")
    return od.join(o, "ordernumber")


@query("join_orders_customers")
def q_join_orders_customers(spark, d):
    o = silver_table(spark, d, "orders").select("ordernumber", "orderdate", "customernumber")
    c = silver_table(spark, d, "customers").select("customernumber", "salesrepemployeenumber")
    return o.join(c, "customernumber")


@query("join_customers_employees")
def q_join_customers_employees(spark, d):
    c = silver_table(spark, d, "customers").select(
        "customernumber", F.col("salesrepemployeenumber").alias("employeenumber"))
    e = silver_table(spark, d, "employees").select("employeenumber", "officecode")
    return c.join(e, "employeenumber")


@query("join_sales_offices")
def q_join_sales_offices(spark, d):
    lines = G.sales_lines(*gold_inputs(spark, d))
    return lines.select(
        "ordernumber", "interval_portsales", F.col("qty").cast("bigint").alias("qty"),
        F.col("amt").cast("double").alias("amt"), "orderdate", "customernumber",
        "officecode", "city", "state", "country", "territory")


# --- load ---------------------------------------------------------------------------

@query("merge_upsert_single_key")
def q_merge_upsert_single_key(spark, d):
    f = feed(spark, d, "customers")
    target = silver(CUSTOMERS, _before(f, FEED_CUTOFF))
    source = silver_batch(CUSTOMERS, f.where(F.col("extract_at") > FEED_CUTOFF))
    return upsert(target, source, CUSTOMERS.keys)


@query("merge_upsert_composite_key")
def q_merge_upsert_composite_key(spark, d):
    f = feed(spark, d, "orderdetails")
    orders = feed(spark, d, "orders")
    target = silver_orderdetails(_before(f, DETAILS_CUTOFF), orders)
    source = silver_orderdetails(f.where(F.col("extract_at") > DETAILS_CUTOFF), orders)
    return upsert(target, source, ORDERDETAILS.keys)


for _t in ("customers", "employees", "offices", "orderdetails", "orders", "products"):
    QUERIES[f"silver_{_t}"] = (lambda t: lambda spark, d: silver_table(spark, d, t))(_t)


@query("silver_employees_nodedup")
def q_silver_employees_nodedup(spark, d):
    return silver(EMPLOYEES, feed(spark, d, "employees"), dedupe=False)


@query("silver_orders_incremental")
def q_silver_orders_incremental(spark, d):
    f = feed(spark, d, "orders")
    target = materialize(silver(ORDERS, _before(f, FEED_CUTOFF)), "target")
    return silver(ORDERS, f, target)


@query("silver_orderdetails_incremental")
def q_silver_orderdetails_incremental(spark, d):
    f = feed(spark, d, "orderdetails")
    orders = feed(spark, d, "orders")
    dates = materialize(silver(ORDERS, orders).select("ordernumber", "orderdate"), "dates")
    target = materialize(silver_orderdetails(_before(f, DETAILS_CUTOFF), orders, dates=dates), "target")
    return silver_orderdetails(f, orders, target, dates=dates)


@query("merge_moved_partition")
def q_merge_moved_partition(spark, d):
    """Stored merges in which keys move to other partitions: lines land before
    their orders (null dates) and orders change their dates between runs."""
    house = _jobs.Lakehouse(spark, scratch_dir(spark, "moved"), partition_grain="month")
    orders, lines = feed(spark, d, "orders"), feed(spark, d, "orderdetails")
    days = F.expr("INTERVAL 40 DAYS") * (F.col("ordernumber") % 3).cast("int")
    moved = _before(orders, FEED_CUTOFF).withColumn("orderdate", F.col("orderdate") - days)
    runs = [
        ("orderdetails", _before(lines, DETAILS_CUTOFF)),
        ("orders", moved),
        # The same changes again, later and with the true dates.
        ("orders", orders.withColumn("extract_at", F.regexp_replace("extract_at", "^2024-01", "2024-05"))),
        ("orderdetails", lines.withColumn("extract_at", F.regexp_replace("extract_at", "^1", "2"))),
    ]
    for table, changes in runs:
        house.merge(table, house.batch(table, changes))
    o = house.silver_table("orders").select(F.lit("orders").alias("dataset"), "ordernumber", F.lit(0).cast("long").alias("productcode"), F.lit(0).cast("long").alias("orderlinenumber"), "orderdate")
    od = house.silver_table("orderdetails").select(F.lit("orderdetails").alias("dataset"), "ordernumber", F.col("productcode").cast("long").alias("productcode"), F.col("orderlinenumber").cast("long").alias("orderlinenumber"), "orderdate")
    return o.unionByName(od)


@query("silver_orders_full_refresh")
def q_silver_orders_full_refresh(spark, d):
    """A table loaded wrongly, then built anew from everything that landed."""
    house = _jobs.Lakehouse(spark, scratch_dir(spark, "refresh"), partition_grain="month")
    house.land(d, ["orders"])
    bad = feed(spark, d, "orders").withColumn("orderdate", F.col("orderdate") + F.expr("INTERVAL 900 DAYS"))
    house.merge("orders", house.batch("orders", bad.withColumn("extract_at", F.lit("2031-01-01 00:00:00.000000"))))
    house.run_silver(["orders"], full_refresh=True)
    return house.silver_table("orders")


# --- maintenance by what changed --------------------------------------------------------

# Orders that come after this change time are late: their lines, or later orders, are there.
LATE_CUTOFF = "2024-01-03 00:00:00.000000"


def late_house(spark: SparkSession, d: str):
    """A mart built from part of the orders and lines; then the other lines come, before
    their orders, and last the other orders."""
    house = _jobs.Lakehouse(spark, scratch_dir(spark, "late"), partition_grain="month", maintain=True)
    orders, lines = feed(spark, d, "orders"), feed(spark, d, "orderdetails")
    for t in ("customers", "employees", "offices"):
        house.merge(t, house.batch(t, feed(spark, d, t)))
    house.merge("orders", house.batch("orders", orders.where(F.col("extract_at") <= LATE_CUTOFF)))
    house.merge("orderdetails", house.batch("orderdetails", _before(lines, DETAILS_CUTOFF)))
    house.run_gold()
    rest = [("orderdetails", lines.where(F.col("extract_at") > DETAILS_CUTOFF)), ("orders", orders.where(F.col("extract_at") > LATE_CUTOFF))]
    for table, changes in rest:
        house.merge(table, house.batch(table, changes), newer_only=True)
    return house


@query("gold_late_groups")
def q_gold_late_groups(spark, d):
    """The mart after late lines and orders of dates that it holds already."""
    house = late_house(spark, d)
    house.run_gold()
    return house.mart()


@query("lines_date_repair")
def q_lines_date_repair(spark, d):
    """Lines whose orders came after them, without a change of the lines."""
    house = late_house(spark, d)
    house.run_silver(())
    return house.silver_table("orderdetails")


def _with_deletes(spark: SparkSession, d: str, table: str) -> DataFrame:
    """Deletes applied; images come out of order and again."""
    house = _jobs.Lakehouse(spark, scratch_dir(spark, "deletes"), partition_grain="month", apply_deletes=True)
    f = feed(spark, d, table)
    late, middle = f.where(F.col("extract_at") > FEED_CUTOFF), _before(f, FEED_CUTOFF)
    for changes in (late, middle, f.where("op = 'D'"), middle):
        house.merge(table, house.batch(table, changes))
    return house.silver_table(table)


for _t in ("customers", "orders"):
    QUERIES[f"silver_{_t}_deletes"] = (lambda t: lambda spark, d: _with_deletes(spark, d, t))(_t)


# --- gold ---------------------------------------------------------------------------

@query("gold_sales_dataset")
def q_gold_sales_dataset(spark, d):
    return G.gold_sales(*gold_inputs(spark, d))


@query("gold_sales_incremental")
def q_gold_sales_incremental(spark, d):
    od, o, c, e, off = gold_inputs(spark, d)
    early = o.where(F.col("orderdate") <= F.lit(GOLD_CUTOFF).cast("timestamp_ntz"))
    target = materialize(G.gold_sales(od, early, c, e, off), "target")
    return G.gold_sales(od, o, c, e, off, target=target)


@query("gold_recompute_late")
def q_gold_recompute_late(spark, d):
    """A mart built before the late lines came, its dates from the cut on anew."""
    od, o, c, e, off = gold_inputs(spark, d)
    early = latest_lines(_before(feed(spark, d, "orderdetails"), DETAILS_CUTOFF))
    target = materialize(G.gold_sales(early, o, c, e, off), "target")
    return G.gold_recompute(od, o, c, e, off, target, GOLD_CUTOFF)


@query("bi_quantity_by_country")
def q_bi_quantity_by_country(spark, d):
    return G.bi_quantity_by_country(G.gold_sales(*gold_inputs(spark, d)))


@query("bi_quantity_total")
def q_bi_quantity_total(spark, d):
    return G.bi_quantity_total(G.gold_sales(*gold_inputs(spark, d)))


@query("bi_amount_by_territory_city")
def q_bi_amount_by_territory_city(spark, d):
    return G.bi_amount_by_territory_city(G.gold_sales(*gold_inputs(spark, d)))


@query("bronze_schema_drift")
def q_bronze_schema_drift(spark, d):
    """Landed hours of all six feeds; an hour of orders misspells a column, one holds
    a column as text and one of its own."""
    root = scratch_dir(spark, "drift")

    def land(table: str, df: DataFrame, day: str) -> None:
        hour = "/".join(f"{c}={v}" for c, v in zip(PARTITION_COLS, ("2024", "01", day, "00"), strict=True))
        df.drop(*PARTITION_COLS).write.parquet(f"{B.table_root(root, table)}/{hour}")

    for t in BRONZE_PAYLOAD:
        land(t, feed(spark, d, t).where("op = 'I'"), "01")
    orders = feed(spark, d, "orders")
    land("orders", orders.where("op = 'U'").withColumnRenamed("requireddate", "requirededate"), "02")
    land("orders", orders.where("op = 'D'").withColumn("customernumber", F.col("customernumber").cast("string")).withColumn("channel", F.lit(1)), "03")
    report = schema_drift(spark, root, list(BRONZE_PAYLOAD))
    return report.select(F.col("table").alias("dataset"), F.col("column").alias("column_name"), "declared", "found", "fault", F.col("rows").alias("n_rows"))


def dashboard_house(spark: SparkSession, d: str):
    """A mart after two runs and a recompute of its newer dates, for lines that came late."""
    house = _jobs.Lakehouse(spark, scratch_dir(spark, "dashboards"), partition_grain="month", dashboards=True)
    orders, lines = feed(spark, d, "orders"), feed(spark, d, "orderdetails")
    early = F.col("orderdate") <= F.lit(GOLD_CUTOFF).cast("timestamp_ntz")
    for t in ("customers", "employees", "offices"):
        house.merge(t, house.batch(t, feed(spark, d, t)))
    house.merge("orders", house.batch("orders", orders.where(early)))
    house.merge("orderdetails", house.batch("orderdetails", _before(lines, DETAILS_CUTOFF)))
    house.run_gold()
    house.merge("orders", house.batch("orders", orders.where(~early)))
    house.run_gold()
    house.merge("orderdetails", house.batch("orderdetails", lines.where(F.col("extract_at") > DETAILS_CUTOFF)))
    house.run_gold(recompute_from=GOLD_CUTOFF)
    return house


QUERIES["bi_quantity_by_country_maintained"] = lambda spark, d: dashboard_house(spark, d).dashboards.quantity_by_country()
QUERIES["bi_quantity_total_maintained"] = lambda spark, d: dashboard_house(spark, d).dashboards.quantity_total()
QUERIES["bi_amount_by_territory_city_maintained"] = lambda spark, d: dashboard_house(spark, d).dashboards.amount_by_territory_city()


# Pipeline and streaming queries register themselves on import.
from tidemark.plans import jobs as _jobs  # noqa: E402,F401
from tidemark.streaming import mart as _mart  # noqa: E402,F401
from tidemark.streaming import stream as _stream  # noqa: E402,F401

__all__ = ["QUERIES", "query", "FEED_CUTOFF", "DETAILS_CUTOFF", "GOLD_CUTOFF"]
