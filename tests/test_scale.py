"""Landing, backfill and deduplication stay bounded as tables grow."""

from __future__ import annotations

import re

import pytest
from conftest import SF_SMALL
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from tidemark.config import PARTITION_COLS
from tidemark.plans import catalog as C
from tidemark.plans.jobs import Lakehouse
from tidemark.sources import bronze as B
from tidemark.sources.feeds import feed
from tidemark.sources.files import Files
from tidemark.sources.schemas import bronze_schema
from tidemark.sources.storage import scratch_dir, tiny_files
from tidemark.streaming.stream import stream_silver


def _conf(spark, stack, **values):
    for k, v in values.items():
        key = "spark.sql." + k.replace("_", ".")
        old = spark.conf.get(key)
        spark.conf.set(key, v)
        stack.callback(lambda key=key, old=old: spark.conf.set(key, old))


@pytest.fixture
def settings(spark):
    from contextlib import ExitStack

    with ExitStack() as stack:
        yield lambda **values: _conf(spark, stack, **values)


def _lines(spark, days: int):
    """Some rows in every hour of ``days`` days, from eight map tasks."""
    schema = bronze_schema("orderdetails", with_partitions=False)
    hours = spark.range(0, days * 24 * 60, 1, 8).select((F.col("id") % (days * 24)).alias("h"), "id")
    at = F.timestamp_add("HOUR", F.col("h").cast("int"), F.lit("2024-01-01 03:00:00").cast("timestamp_ntz")).cast("string")
    given = {"op": F.lit("I"), "extract_at": F.concat(at, F.lit(".000000")), "ordernumber": F.col("id"), "productcode": F.col("id") * 7919 % 100003}
    return hours.select(*[given.get(f.name, F.col("id") % 977).cast(f.dataType).alias(f.name) for f in schema.fields])


def test_a_small_hour_is_one_file_however_large_the_table(spark, settings):
    settings(shuffle_partitions="2", adaptive_advisoryPartitionSizeInBytes="150k")
    root = scratch_dir(spark, "t-files")
    B.land_hourly(_lines(spark, 10), root, "orderdetails")
    files = Files(spark).walk(f"{root}/orderdetails", ".parquet")
    assert len(files) == 240
    landed = B.scan_bronze(spark, root, "orderdetails")
    assert landed.count() == 10 * 24 * 60
    assert landed.select(*PARTITION_COLS).distinct().count() == 240


def test_forced_writers_land_ranges_of_hours(spark):
    root = scratch_dir(spark, "t-ranges")
    B.land_hourly(_lines(spark, 20), root, "orderdetails", num_tasks=4, files_per_hour=1)
    files = Files(spark).walk(f"{root}/orderdetails", ".parquet")
    assert len(files) == 480
    writers = {(name.rpartition("/hour_stream=")[0], re.search(r"/part-(\d+)-", name)[1]) for name in files}
    assert len({w for _, w in writers}) == 4
    assert len(writers) <= 20 + 3  # a day has two writers only where a range ends in it
    B.land_hourly(_lines(spark, 2), root, "orderdetails", num_tasks=4, files_per_hour=2)
    assert sorted(B.scan_bronze(spark, root, "orderdetails").collect()) == sorted(B.with_partition_values(_lines(spark, 20).union(_lines(spark, 2))).collect())


def test_hours_of_paths_are_the_partitions(spark, bronze):
    root = scratch_dir(spark, "t-paths")
    rows = bronze("products", [{"op": "I", "extract_at": x, "productcode": n} for n, x in enumerate(("2024-01-01 00:00:00.000000", "2024-01-01 07:00:00.000000", None))])
    B.land_hourly(rows, root, "products")
    B.drop_full_load(rows.where("productcode = 0"), root, "products")
    payload = bronze_schema("products", with_partitions=False)
    got = B.hours_of_paths(spark.read.schema(payload).option("recursiveFileLookup", "true").parquet(B.table_root(root, "products")))
    want = spark.read.schema(bronze_schema("products")).parquet(B.table_root(root, "products"))
    order = ["productcode", "hour_stream"]
    assert got.orderBy(*order).collect() == want.orderBy(*order).collect()
    assert B.file_count(spark, root, "products") == len(want.inputFiles())


def test_streams_read_the_landed_rows_with_their_hours(spark, monkeypatch):
    """The hours come from the paths; settings for tiny files hold while batches run."""
    house = Lakehouse(spark, scratch_dir(spark, "t-stream"))
    B.land_hourly(_lines(spark, 2), house.bronze_root, "orderdetails", num_tasks=2, files_per_hour=1)
    seen, batch, before = [], Lakehouse.batch, {k: spark.conf.get(k) for k in ("spark.sql.files.openCostInBytes", "spark.sql.sources.parallelPartitionDiscovery.parallelism")}

    def watched(self, table, changes, *args):
        seen.append((changes.collect(), spark.conf.get("spark.sql.files.openCostInBytes")))
        return batch(self, table, changes, *args)

    monkeypatch.setattr(Lakehouse, "batch", watched)
    with tiny_files(spark):
        stream_silver(house, "orderdetails", f"{house.root}/_checkpoint", files_per_trigger=20).awaitTermination()
    assert [c for _, c in seen] == ["262144"] * 3
    assert sorted(r for rows, _ in seen for r in rows) == sorted(B.scan_bronze(spark, house.bronze_root, "orderdetails").collect())
    assert before == {k: spark.conf.get(k) for k in before}
    assert house.silver_table("orderdetails").count() == 2 * 24 * 60


def test_first_landing_replaces_nothing_and_a_second_one_whole_hours(spark):
    root = scratch_dir(spark, "t-twice")
    rows = feed(spark, SF_SMALL, "offices")
    for part in (rows, rows, rows.where("hour_stream = '21'")):
        B.land_hourly(part, root, "offices", replace=True)
        assert sorted(B.scan_bronze(spark, root, "offices").collect()) == sorted(rows.collect())


def test_whole_days_are_listed_by_their_directory(spark):
    root = scratch_dir(spark, "t-days")
    B.land_hourly(_lines(spark, 2), root, "orderdetails")
    base = B.table_root(root, "orderdetails")
    assert B.hours_glob(spark, base, None, "kv").endswith("/day_stream=*")
    since = B.scan_bronze(spark, root, "orderdetails", since="2024-01-01 12:30:00.000000")
    assert since.select(*PARTITION_COLS).distinct().count() == 48 - 10
    assert {f.rpartition("hour_stream=")[2][:2] for f in since.inputFiles() if "day_stream=01" in f} == {f"{h:02d}" for h in range(8, 24)}


def test_backfill_neither_sorts_nor_joins_its_rows(spark, bronze, monkeypatch):
    root, manifest = scratch_dir(spark, "t-fill"), scratch_dir(spark, "t-manifest")
    rows = bronze("products", [{"op": "I", "extract_at": f"2024-01-0{n} 00:00:00.000000", "productcode": n} for n in (1, 1, 2)])
    B.drop_full_load(rows, root, "products")

    def refuse(*_):
        raise AssertionError("sorts a task's rows by their partition")

    monkeypatch.setattr(DataFrameWriter, "partitionBy", refuse)
    assert B.backfill(spark, root, "products", manifest).count() > 0
    assert B.backfill(spark, root, "products", manifest).count() == 0
    landed = B.scan_bronze(spark, root, "products")
    assert sorted(r.productcode for r in landed.collect()) == [1, 1, 2]
    assert {tuple(r[c] for c in PARTITION_COLS) for r in landed.collect()} == {("2026", "01", "01", "00")}


@pytest.mark.parametrize("table", ["customers", "products"])
def test_wide_images_are_spread_before_they_are_sorted(spark, table):
    from test_plans import _explain

    plan = _explain(C.QUERIES[f"latest_{table}"](spark, SF_SMALL), "simple")
    below = plan[plan.index(", Partial"):]
    assert below.index("REBALANCE") < below.index("Scan parquet" if "Scan parquet" in below else "FileScan")
    assert below.index("Sort") < below.index("REBALANCE")
