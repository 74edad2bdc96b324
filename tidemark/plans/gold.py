"""Gold sales mart and the dashboard aggregates read from it.

Plan (``gold_sales``):

  1. order lines -> partial+final aggregate per ordernumber, one conditional
     sum per sale-size bucket (map-side combine: an order with millions of
     lines ships one row per map task; the result is hash-partitioned on
     ordernumber)
  2. rep -> office dimension (employees JOIN offices), customers JOIN it on
     the sales rep; broadcasts only where AQE measured a side small
  3. orders (above the mart's watermark) JOIN customers on customernumber
  4. (1) JOIN (3) on ordernumber, reusing (1)'s partitioning; unpivot buckets
  5. final aggregate on the mart grain, calendar columns derived after it

Money is summed as exact decimals and converted to double once per group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.config import GOLD_COLUMNS, GOLD_KEYS
from tidemark.functions.scalar import blank_to_null, sale_bucket
from tidemark.functions.time import calendar_attributes
from tidemark.operators.merge import upsert
from tidemark.operators.watermark import above_time

MONEY_SUM = "decimal(38,2)"


BUCKETS = ("Small", "Medium", "Big")


def order_line_totals(details: DataFrame) -> DataFrame:
    """Per order: line count, quantity and exact amount of each sale-size bucket.

    Grouping on the order number alone (buckets as conditional sums) makes
    the aggregate's shuffle the same hash partitioning the join with orders
    needs, so order lines are exchanged once.
    """
    bucket = sale_bucket("amount")
    qty = F.col("quantityordered")
    amt = F.col("amount").cast(MONEY_SUM)
    aggs = []
    for b in BUCKETS:
        hit = bucket == b
        aggs += [
            F.count(F.when(hit, F.lit(1))).alias(f"n_{b}"),
            F.sum(F.when(hit, qty)).alias(f"q_{b}"),
            F.sum(F.when(hit, amt)).alias(f"a_{b}"),
        ]
    return details.groupBy("ordernumber").agg(*aggs)


def unpivot_buckets(df: DataFrame) -> DataFrame:
    """One row per (order, bucket present in the order)."""
    rest = [c for c in df.columns if not c.startswith(("n_", "q_", "a_"))]
    cells = F.array(*[
        F.struct(F.lit(b).alias("interval_portsales"), F.col(f"n_{b}").alias("_lines"),
                 F.col(f"q_{b}").alias("qty"), F.col(f"a_{b}").alias("amt"))
        for b in BUCKETS
    ])
    return df.select(*rest, F.inline(cells)).where(F.col("_lines") > 0).drop("_lines")


def rep_offices(employees: DataFrame, offices: DataFrame) -> DataFrame:
    """Sales rep -> office attributes (inner: reps without office drop out).

    Dimension joins carry no hint: AQE turns a join into a broadcast only
    after measuring the built side's shuffle output below
    ``spark.sql.adaptive.autoBroadcastJoinThreshold`` (a checked bound, no
    extra pass), and keeps the sort-merge join otherwise.
    """
    off = offices.select("officecode", "city", "state", "country", "territory")
    emp = employees.select("employeenumber", "officecode")
    return emp.join(off, "officecode")


def customer_offices(customers: DataFrame, employees: DataFrame, offices: DataFrame) -> DataFrame:
    cust = customers.select("customernumber", F.col("salesrepemployeenumber").alias("employeenumber"))
    return cust.join(rep_offices(employees, offices), "employeenumber").drop("employeenumber")


def sales_lines(details: DataFrame, orders: DataFrame, customers: DataFrame,
                employees: DataFrame, offices: DataFrame,
                target: DataFrame | None = None, high_watermark: str | None = None) -> DataFrame:
    """Per-order totals with order date and office: the input of the mart grain."""
    o = orders.select("ordernumber", "orderdate", "customernumber")
    if target is not None:
        o = above_time(o, "orderdate", target, "calendar_sales_date", high_watermark)
        # Only the lines of the new orders are aggregated.
        details = details.join(o.select("ordernumber"), "ordernumber", "left_semi")
    enriched = o.join(customer_offices(customers, employees, offices), "customernumber")
    return unpivot_buckets(order_line_totals(details).join(enriched, "ordernumber"))


def gold_batch(details: DataFrame, orders: DataFrame, customers: DataFrame,
               employees: DataFrame, offices: DataFrame,
               target: DataFrame | None = None, high_watermark: str | None = None) -> DataFrame:
    lines = sales_lines(details, orders, customers, employees, offices, target, high_watermark)
    grouped = lines.groupBy(
        "officecode", "city", "state", "country", "territory", "interval_portsales", "orderdate",
    ).agg(F.sum("qty").alias("qty"), F.sum("amt").alias("amt"))
    return mart_rows(grouped)


def mart_rows(grouped: DataFrame) -> DataFrame:
    """Sums per office, bucket and order date as rows of the mart."""
    return grouped.select(
        F.col("officecode").alias("locality_officecode"),
        F.col("city").alias("locality_city"),
        blank_to_null("state").alias("locality_state"),
        F.col("country").alias("locality_country"),
        F.col("territory").alias("locality_territory"),
        "interval_portsales",
        F.col("orderdate").alias("calendar_sales_date"),
        *calendar_attributes("orderdate"),
        F.col("qty").cast("bigint").alias("sales_quantityordered"),
        F.col("amt").cast("double").alias("sales_amount"),
    )


def gold_sales(details: DataFrame, orders: DataFrame, customers: DataFrame,
               employees: DataFrame, offices: DataFrame,
               target: DataFrame | None = None) -> DataFrame:
    """The mart after one run; merged on its grain when a target exists.

    Only order dates above the mart's newest date are loaded, so the merge
    inserts; the merge key is the full grain (office, bucket, date).
    """
    batch = gold_batch(details, orders, customers, employees, offices, target)
    if target is None:
        return batch
    return upsert(target.select(*GOLD_COLUMNS), batch, GOLD_KEYS)


def gold_recompute(details: DataFrame, orders: DataFrame, customers: DataFrame,
                   employees: DataFrame, offices: DataFrame, target: DataFrame, since: str) -> DataFrame:
    """The mart with every order date from ``since`` on built anew, so that lines
    and orders that came late or changed count; earlier dates stay as they are."""
    start = F.lit(since).cast("timestamp_ntz")
    recent = orders.where(F.col("orderdate") >= start)
    lines = details.join(recent.select("ordernumber"), "ordernumber", "left_semi")
    kept = target.select(*GOLD_COLUMNS).where(F.col("calendar_sales_date") < start)
    return kept.unionByName(gold_batch(lines, recent, customers, employees, offices))


# --- dashboard aggregates ------------------------------------------------------

def bi_quantity_by_country(mart: DataFrame) -> DataFrame:
    return mart.groupBy("locality_country").agg(
        F.sum("sales_quantityordered").cast("bigint").alias("total_quantity"))


def bi_quantity_total(mart: DataFrame) -> DataFrame:
    return mart.agg(F.sum("sales_quantityordered").cast("bigint").alias("total_quantity"))


def bi_amount_by_territory_city(mart: DataFrame) -> DataFrame:
    return mart.groupBy("locality_territory", "locality_city").agg(
        F.sum(F.col("sales_amount").cast(MONEY_SUM)).cast("double").alias("total_amount"))
