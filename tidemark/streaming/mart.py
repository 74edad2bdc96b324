"""The sales mart as a stream: signed sums from the changes of orders and lines.

``stream_gold`` reads the landed changes of orders and order lines as one stream. What a
batch changes in the mart is what its orders, and the orders of its lines, contributed
before, taken out, and what they contribute after it, put in. Only these orders' partitions
are read (found by the key locator), never the mart:

1. the old contributions are written under the batch's number;
2. the batch is merged into the silver tables, newer images only, and lines take the dates
   of orders that came or moved (``maintain``);
3. new contributions less old ones are appended to the sums (``sources.runs``), once per
   batch.

A batch that dies is repeated from the start: old contributions that are there whole are
kept (the tables may be merged in part by then), merging again changes nothing, and sums
that are appended already stay as they are. So the sums are exact after any failure.

The sums are kept by customer, sale-size bucket and order date. The mart's offices are
joined when it is read, so it also follows customers, sales reps and offices that change.
A lakehouse has its mart from here or from ``run_gold``, not both: the stream takes the
change log that ``run_gold`` would read. Orders and lines must come in through it alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.scalar import sale_bucket
from tidemark.operators.merge import partition_in
from tidemark.plans.gold import MONEY_SUM, customer_offices, mart_rows
from tidemark.plans.jobs import Lakehouse
from tidemark.plans.maintain import partitions_of, repair_lines, touched_log
from tidemark.sources import bronze as B
from tidemark.sources.feeds import feed
from tidemark.sources.files import Files
from tidemark.sources.runs import RunTable
from tidemark.sources.schemas import GOLD_SCHEMA, bronze_schema
from tidemark.sources.storage import materialize, scratch_dir

FEEDS = ("orders", "orderdetails")
GROUP = ["customernumber", "interval_portsales", "orderdate"]
#: Lines, lines with a quantity, quantity, lines with an amount, amount.
MEASURES = ["lines", "n_qty", "qty", "n_amt", "amt"]
SUMS = T.StructType(
    [T.StructField(c, t) for c, t in zip(GROUP, (T.LongType(), T.StringType(), T.TimestampNTZType()), strict=True)]
    + [T.StructField(m, T.DecimalType(38, 2) if m == "amt" else T.LongType()) for m in MEASURES])


def add_up(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*GROUP).agg(*(F.sum(m).cast(SUMS[m].dataType).alias(m) for m in MEASURES))


def sums_of(house: Lakehouse) -> RunTable:
    return RunTable(house.spark, f"{house.root}/gold/sales_sums", SUMS, add_up)


def contributions(house: Lakehouse, numbers: DataFrame) -> DataFrame:
    """What the orders ``numbers`` (one column, distinct) hold in the mart's sums now.

    After ``repair_lines`` the lines of an order lie in the partition of its date, so the
    partitions of these orders' dates are all that is read."""
    orders, lines = house.live("orders"), house.live("orderdetails")
    if orders is None or lines is None:
        return house.spark.createDataFrame([], SUMS)
    places = house.locator("orders").places(numbers.withColumn(house.stored("orders").partition_col, F.lit(None).cast("string")))
    orders = orders.where(partition_in(house.stored("orders").partition_col, places)).join(numbers, "ordernumber", "left_semi")
    orders = materialize(orders.select("ordernumber", "customernumber", "orderdate"), "mart-orders")
    held = partition_in(house.stored("orderdetails").partition_col, partitions_of(orders, "orderdate", house.grain))
    sold = lines.where(held).select("ordernumber", "quantityordered", "amount").join(orders, "ordernumber")
    return sold.groupBy("customernumber", sale_bucket("amount").alias("interval_portsales"), "orderdate").agg(
        F.count(F.lit(1)).alias("lines"),
        F.count("quantityordered").alias("n_qty"),
        F.coalesce(F.sum("quantityordered"), F.lit(0)).cast("long").alias("qty"),
        F.count("amount").alias("n_amt"),
        F.coalesce(F.sum(F.col("amount").cast(MONEY_SUM)), F.lit(0)).cast(MONEY_SUM).alias("amt"),
    )


def difference(old: DataFrame, new: DataFrame) -> DataFrame:
    """New sums less old ones, of the groups that differ."""
    out = old.select(*GROUP, *((-F.col(m)).cast(SUMS[m].dataType).alias(m) for m in MEASURES))
    changed = " or ".join(f"{m} <> 0" for m in MEASURES)
    return add_up(out.unionByName(new.select(*GROUP, *MEASURES))).where(changed)


class MartBatches:
    """Applies numbered batches of changes to the silver tables and the sums."""

    def __init__(self, house: Lakehouse, source: str):
        if not house.maintain:
            raise ValueError("a streamed mart needs a lakehouse that maintains line dates")
        self.house, self.source, self.files = house, source, Files(house.spark)

    def old_sums(self, numbers: DataFrame, number: int) -> DataFrame:
        path = f"{self.house.root}/changes/mart/{number}"
        if not self.files.exists(f"{path}/_SUCCESS"):
            contributions(self.house, numbers).select(*SUMS.fieldNames()).write.mode("overwrite").parquet(path)
        return self.house.spark.read.schema(SUMS).parquet(path)

    def apply(self, changes: dict[str, DataFrame], number: int) -> None:
        house, sums = self.house, sums_of(self.house)
        if not sums.holds(self.source, number):
            numbers = [changes[t].select("ordernumber") for t in FEEDS]
            numbers = materialize(numbers[0].unionByName(numbers[1]).where("ordernumber is not null").distinct(), "mart-numbers")
            old = self.old_sums(numbers, number)
            for t in FEEDS:
                house.merge(t, house.batch(t, changes[t]), newer_only=True)
            repair_lines(house)
            sums.append(difference(old, contributions(house, numbers)), self.source, number)
        # What is below belongs to batches that are in the sums.
        self.files.delete(f"{house.root}/changes/mart/{number}")
        touched_log(house).clear(touched_log(house).entries())


def stream_gold(house: Lakehouse, checkpoint: str, files_per_trigger: int | None = None,
                available_now: bool = True) -> StreamingQuery:
    """Stream landed changes of orders and order lines into silver and the mart's sums."""
    spark = house.spark
    batches = MartBatches(house, checkpoint)

    def source(table: str) -> DataFrame:
        reader = spark.readStream.schema(bronze_schema(table))
        if files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", files_per_trigger)
        return reader.parquet(B.table_root(house.bronze_root, table)).withColumn("_feed", F.lit(table))

    def on_batch(batch: DataFrame, epoch_id: int) -> None:
        rows = materialize(batch, "mart-batch")
        batches.apply({t: rows.where(F.col("_feed") == t).select(*bronze_schema(t).fieldNames()) for t in FEEDS}, epoch_id)

    both = source("orders").unionByName(source("orderdetails"), allowMissingColumns=True)
    w = both.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="15 minutes")
    return w.start()


def streamed_mart(house: Lakehouse) -> DataFrame:
    """The mart as the sums and the dimension tables stand now."""
    sums = sums_of(house).read().where("lines > 0")
    offices = customer_offices(*(house.silver_table(t) for t in ("customers", "employees", "offices")))
    grouped = sums.join(offices, "customernumber").groupBy(
        "officecode", "city", "state", "country", "territory", "interval_portsales", "orderdate",
    ).agg(F.expr("case when sum(n_qty) > 0 then sum(qty) end").alias("qty"),
          F.expr("case when sum(n_amt) > 0 then sum(amt) end").alias("amt"))
    return mart_rows(grouped).select(*GOLD_SCHEMA.fieldNames())


def q_stream_gold_sales(spark: SparkSession, d: str) -> DataFrame:
    """Changes in no order of time: versions of an order, and lines and their orders, come
    in different batches, so old contributions go out again."""
    house = Lakehouse(spark, scratch_dir(spark, "stream-mart"), partition_grain="month", maintain=True)
    for t in ("customers", "employees", "offices"):
        house.merge(t, house.batch(t, feed(spark, d, t)))
    tasks = spark.sparkContext.defaultParallelism
    for t in FEEDS:
        changes = feed(spark, d, t).select(*bronze_schema(t, with_partitions=False).fieldNames())
        changes.repartition(tasks, "extract_at").write.parquet(B.table_root(house.bronze_root, t))
    stream_gold(house, f"{house.root}/_checkpoint/mart", files_per_trigger=tasks // 3 + 1).awaitTermination()
    return streamed_mart(house)


def _register() -> None:
    from tidemark.plans.catalog import QUERIES
    QUERIES["stream_gold_sales"] = q_stream_gold_sales


_register()
