"""DDL and partition registration in the session catalog."""

from __future__ import annotations

import datetime as dt

from conftest import SF_SMALL

from tidemark.plans.jobs import Lakehouse
from tidemark.sources import bronze as B
from tidemark.sources.feeds import feed
from tidemark.sources.schemas import GOLD_SCHEMA, bronze_schema, create_table_ddl, silver_schema
from tidemark.sources.storage import scratch_dir


def test_schemas_and_ddl_text():
    assert bronze_schema("orders").fieldNames()[:2] == ["op", "extract_at"]
    assert bronze_schema("orders").fieldNames()[-4:] == list(B.PARTITION_COLS)
    assert silver_schema("customers")["creditlimit"].dataType.simpleString() == "double"
    assert silver_schema("offices")["officecode"].dataType.simpleString() == "bigint"
    assert len(GOLD_SCHEMA.fields) == 14
    ddl = create_table_ddl("raw", "orders", bronze_schema("orders"), "/x", B.PARTITION_COLS)
    assert ddl.startswith("CREATE TABLE IF NOT EXISTS raw.orders (") and "PARTITIONED BY" in ddl


def test_partition_for_run_and_overrides():
    run = dt.datetime(2024, 1, 2, 1, 30)
    assert B.partition_for_run(run) == ("2024", "01", "01", "22")
    assert B.partition_for_run(run, {"partition_date": " 2025-02-03 ", "partition_hour": "07"}) == \
        ("2025", "02", "03", "07")
    assert B.partition_for_run(run, {"partition_year": "2020"}) == ("2020", "01", "01", "22")


def test_activate_partition_is_idempotent(spark):
    root = scratch_dir(spark, "t-raw")
    B.land_hourly(feed(spark, SF_SMALL, "orders"), root, "orders")
    run = dt.datetime(2024, 1, 1, 3, 30)  # hour 00 of 2024-01-01 in UTC-3
    for _ in range(2):
        assert B.activate_partition(spark, root, "orders", run, database="raw_t").first()[0] == 1
    parts = [r.partition for r in spark.sql("SHOW PARTITIONS raw_t.orders").collect()]
    assert parts == ["year_stream=2024/month_stream=01/day_stream=01/hour_stream=00"]
    B.recover_partitions(spark, root, "orders", database="raw_t")
    assert spark.table("raw_t.orders").count() == feed(spark, SF_SMALL, "orders").count()


def test_pipeline_tables_in_catalog(spark):
    house = Lakehouse(spark, scratch_dir(spark, "t-cat"), partition_grain="month")
    house.run(("bronze", "silver", "gold"), sf_dir=SF_SMALL)
    house.register_catalog("raw_c", "ods_c", "dwh_c")
    assert spark.table("dwh_c.sales_dataset").count() == house.mart().count()
    assert spark.table("ods_c.orders").count() == house.silver_table("orders").count()
    assert spark.table("ods_c.customers").count() == house.silver_table("customers").count()
    assert spark.sql("SHOW PARTITIONS raw_c.orderdetails").count() > 0


def test_scan_slash_layout_takes_partitions_from_path(spark):
    from pyspark.sql import functions as F

    root = scratch_dir(spark, "t-slash")
    f = feed(spark, SF_SMALL, "orders")
    payload = bronze_schema("orders", with_partitions=False).fieldNames()
    hours = [tuple(r) for r in f.select(*B.PARTITION_COLS).distinct().orderBy(*B.PARTITION_COLS).limit(2).collect()]
    for y, m, d, h in hours:  # the landing service's plain YYYY/MM/DD/HH directories
        cond = (F.col("year_stream") == y) & (F.col("month_stream") == m) & \
               (F.col("day_stream") == d) & (F.col("hour_stream") == h)
        f.where(cond).select(*payload).write.parquet(f"{root}/orders/{y}/{m}/{d}/{h}")
    got = B.scan_bronze(spark, root, "orders", layout="slash")
    want = f.where(F.struct(*B.PARTITION_COLS).isin([F.struct(*[F.lit(v) for v in hr]) for hr in hours]))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.select(*got.columns).collect()))
