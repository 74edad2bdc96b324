"""Late data, deletes, recovery: tables end as if everything had come at once."""

from __future__ import annotations

import re

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F
from test_equivalence import _keys, _line, _lines, _orders, rows
from test_plans import _explain

from tidemark.plans import catalog as C
from tidemark.plans import maintain as M
from tidemark.plans.jobs import Lakehouse
from tidemark.sources import bronze as B
from tidemark.sources.feeds import feed
from tidemark.sources.files import Files
from tidemark.sources.storage import scratch_dir


def house_of(spark, **more):
    return Lakehouse(spark, scratch_dir(spark, "t-maintain"), partition_grain="month", **more)


def load(house, table, changes, **more):
    house.merge(table, house.batch(table, changes), **more)


def dimensions(spark, house):
    """One customer (7), sales rep and office of the test tables each, under fixed keys."""
    for t in ("customers", "employees", "offices"):
        load(house, t, feed(spark, SF_SMALL, t))
    return house.silver_table("customers").where("salesrepemployeenumber > 0").join(
        house.silver_table("employees").select(F.col("employeenumber").alias("salesrepemployeenumber")), "salesrepemployeenumber").first().customernumber


def groups(house):
    return sorted((r.calendar_sales_date.strftime("%Y-%m-%d"), r.sales_quantityordered) for r in house.mart().collect())


def test_late_and_moved_orders_and_lines_reach_the_mart(spark):
    house = house_of(spark, maintain=True)
    c = dimensions(spark, house)
    load(house, "orders", _orders(spark, ("I", "2024-01-01 05:00:00.000000", 1, "2024-01-10 12:00:00", c), ("I", "2024-01-01 05:00:00.000000", 2, "2024-03-10 12:00:00", c)))
    load(house, "orderdetails", _lines(spark, _line(1, "2024-01-01 06:00:00.000000"), _line(2, "2024-01-01 06:00:00.000000"), _line(3, "2024-01-01 06:00:00.000000")))
    house.run_gold()
    assert groups(house) == [("2024-01-10", 1), ("2024-03-10", 1)]
    # A late line of an old date, a late order with its early line, an order that moves.
    load(house, "orderdetails", _lines(spark, _line(1, "2024-01-02 06:00:00.000000", product=2)))
    load(house, "orders", _orders(spark, ("I", "2024-01-03 05:00:00.000000", 3, "2024-02-10 12:00:00", c), ("U", "2024-01-03 05:00:00.000000", 2, "2024-05-10 12:00:00", c)))
    house.run_gold()
    assert groups(house) == [("2024-01-10", 2), ("2024-02-10", 1), ("2024-05-10", 1)]
    assert house.gold.partitions() == ["202401", "202402", "202405"]  # the emptied month is gone
    dates = {r.ordernumber: r.orderdate.strftime("%Y-%m-%d") for r in house.silver_table("orderdetails").collect()}
    assert dates == {1: "2024-01-10", 3: "2024-02-10", 2: "2024-05-10"}
    assert house.stored("orderdetails").partitions() == ["202401", "202402", "202405"]
    assert not M.moved_log(house).entries() and not M.touched_log(house).entries()
    before = groups(house)
    house.run_gold()
    assert groups(house) == before


def test_other_dates_are_not_read(spark):
    """The recomputed groups scan the order and line partitions of their dates alone."""
    house = house_of(spark, maintain=True)
    c = dimensions(spark, house)
    months = [f"2024-{m:02d}-10 12:00:00" for m in range(1, 7)]
    load(house, "orders", _orders(spark, *(("I", "2024-01-01 05:00:00.000000", i, d, c) for i, d in enumerate(months))))
    load(house, "orderdetails", _lines(spark, *(_line(i, "2024-01-01 06:00:00.000000") for i in range(6))))
    house.run_gold()

    def files():
        return {r[0] for r in house.gold.read().select(F.col("_metadata.file_path")).distinct().collect()}

    before = files()
    load(house, "orderdetails", _lines(spark, _line(2, "2024-01-02 06:00:00.000000", product=2)))
    log = M.touched_log(house)
    batch = M.touched_groups(house, log.read(log.entries()).distinct())
    scans = [s for s in _explain(batch, "formatted").split("Scan parquet")[1:] if "orderdate_hour" in s]
    assert scans and all(re.search(r"PartitionFilters: \[[^\n]*orderdate_hour#\d+ (= 202403|IN \(202403\))", s) for s in scans)
    house.run_gold()
    assert len(before - files()) == 1 and groups(house)[2] == ("2024-03-10", 2)


def test_run_that_dies_is_made_up_for(spark, monkeypatch):
    house = house_of(spark, maintain=True)
    c = dimensions(spark, house)
    load(house, "orders", _orders(spark, ("I", "2024-01-01 05:00:00.000000", 1, "2024-01-10 12:00:00", c)))
    load(house, "orderdetails", _lines(spark, _line(1, "2024-01-01 06:00:00.000000"), _line(2, "2024-01-01 06:00:00.000000")))
    house.run_gold()
    load(house, "orders", _orders(spark, ("I", "2024-01-02 05:00:00.000000", 2, "2024-02-10 12:00:00", c)))
    for broken in ("clear", "append"):
        with monkeypatch.context() as m:
            m.setattr(M.ChangeLog, broken, lambda *a: (_ for _ in ()).throw(OSError("lost")))
            with pytest.raises(OSError):
                house.run_gold()
                load(house, "orders", _orders(spark, ("U", "2024-01-03 05:00:00.000000", 2, "2024-02-11 12:00:00", c)))
    house.run_gold()
    assert groups(house) == [("2024-01-10", 1), ("2024-02-10", 1)]
    assert _keys(house.silver_table("orders"), "ordernumber") == [(1,), (2,)]


def test_full_refresh_ignores_the_recompute_date(spark):
    house = house_of(spark)
    for t in ("customers", "employees", "offices", "orders", "orderdetails"):
        load(house, t, feed(spark, SF_SMALL, t))
    want = rows(C.QUERIES["gold_sales_dataset"](spark, SF_SMALL))
    house.run_gold(recompute_from="1996-01-01 00:00:00")  # no mart yet: everything is built
    assert rows(house.mart()) == want
    house.run_gold(full_refresh=True, recompute_from="1996-01-01 00:00:00")
    assert rows(house.mart()) == want
    house.gold.forget()  # as after a run that died before its progress file
    house.run_gold(recompute_from="1996-01-01 00:00:00")
    assert rows(house.mart()) == want


def test_deletes_are_not_undone_by_late_or_repeated_images(spark):
    house = house_of(spark, apply_deletes=True)
    insert = ("I", "2024-01-01 05:00:00.000000", 1, "2024-01-10 12:00:00", 7)
    update = ("U", "2024-01-02 05:00:00.000000", 1, "2024-01-11 12:00:00", 8)
    delete = ("D", "2024-01-03 05:00:00.000000", 1, "2024-01-11 12:00:00", 8)
    load(house, "orders", _orders(spark, insert, ("I", "2024-01-01 05:00:00.000000", 2, "2024-01-10 12:00:00", 7)))
    load(house, "orders", _orders(spark, delete))
    for image in (update, insert, delete):
        load(house, "orders", _orders(spark, image))
        assert _keys(house.silver_table("orders"), "ordernumber") == [(2,)]
    load(house, "orders", _orders(spark, ("I", "2024-01-04 05:00:00.000000", 1, "2024-01-12 12:00:00", 9)))
    assert _keys(house.silver_table("orders"), "ordernumber", "customernumber") == [(1, 9), (2, 7)]


def test_deleted_orders_and_lines_leave_the_mart(spark):
    house = house_of(spark, maintain=True, apply_deletes=True)
    c = dimensions(spark, house)
    load(house, "orders", _orders(spark, *(("I", "2024-01-01 05:00:00.000000", i, f"2024-0{i}-10 12:00:00", c) for i in (1, 2))))
    load(house, "orderdetails", _lines(spark, _line(1, "2024-01-01 06:00:00.000000"), _line(1, "2024-01-01 06:00:00.000000", product=2), _line(2, "2024-01-01 06:00:00.000000")))
    house.run_gold()
    load(house, "orderdetails", _lines(spark, ("D", *_line(1, "2024-01-02 06:00:00.000000")[1:])))
    load(house, "orders", _orders(spark, ("D", "2024-01-02 05:00:00.000000", 2, "2024-02-10 12:00:00", c)))
    house.run_gold()
    assert groups(house) == [("2024-01-10", 1)]


def test_catalog_leaves_foreign_tables_alone(spark):
    house = house_of(spark)
    load(house, "orders", _orders(spark, ("I", "2024-01-01 05:00:00.000000", 1, "2024-01-10 12:00:00", 7)))
    house.register_catalog("raw_f", "ods_f", "dwh_f")  # nothing has landed: only the silver table
    assert spark.table("ods_f.orders").count() == 1 and not spark.catalog.tableExists("raw_f.orders")
    house.register_catalog("raw_f", "ods_f", "dwh_f")
    spark.sql("CREATE DATABASE IF NOT EXISTS ods_g")
    spark.range(5).write.mode("overwrite").saveAsTable("ods_g.orders")
    with pytest.raises(ValueError, match="ods_g.orders exists"):
        house.register_catalog("raw_g", "ods_g", "dwh_g")
    assert spark.table("ods_g.orders").columns == ["id"] and spark.table("ods_g.orders").count() == 5


def test_landing_lists_only_the_fixed_partition(spark, monkeypatch):
    root = scratch_dir(spark, "t-append")
    f = feed(spark, SF_SMALL, "offices")
    B.land_hourly(f, root, "offices", replace=True)
    monkeypatch.setattr(B, "scan_bronze", lambda *a, **k: pytest.fail("scans the history"))
    before = Files(spark).names(f"{root}/offices")
    B.land_hourly(f, root, "offices", replace=True)
    assert Files(spark).names(f"{root}/offices") == before


def test_planning_a_query_starts_no_job(spark):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("t-plan", "planning")
    try:
        C.QUERIES["gold_sales_dataset"](spark, SF_SMALL)
        C.QUERIES["bi_quantity_by_country"](spark, SF_SMALL)
        assert not tracker.getJobIdsForGroup("t-plan")
    finally:
        spark.sparkContext._jsc.clearJobGroup()


def test_merge_finds_keys_without_a_key_scan(spark, monkeypatch):
    """The locator's buckets of the batch are read, and its partitions of the table."""
    from tidemark.sources import locator as L

    house = house_of(spark)
    dates = [f"2024-{m:02d}-10 12:00:00" for m in range(1, 13)]
    load(house, "orders", _orders(spark, *(("I", "2024-01-01 05:00:00.000000", i, d, 7) for i, d in enumerate(dates))))
    held = house.locator("orders")
    batch = house.stored("orders").read().where("ordernumber = 4")
    assert held.places(batch) == {"202405"}
    plan = _explain(held.near(batch), "formatted")
    assert re.search(r"PartitionFilters: \[[^\n]*_bucket#\d+ = \d+", plan)
    monkeypatch.setattr(L, "GENERATIONS", 3)
    for day in (11, 12, 13, 14):  # the key moves on; generations are written anew as one
        load(house, "orders", _orders(spark, ("U", f"2024-02-{day} 05:00:00.000000", 4, f"2024-{day - 2:02d}-20 12:00:00", 8)))
        assert _keys(house.silver_table("orders").where("ordernumber = 4"), "ordernumber", "customernumber") == [(4, 8)]
    assert house.silver_table("orders").count() == 12
    assert len(held._generations()) < 3 and "202412" in held.places(house.stored("orders").read().where("ordernumber = 4"))


def test_locator_that_knows_too_much_does_no_harm(spark, monkeypatch):
    """A run that died after the locator was told and before the table was written."""
    house = house_of(spark)
    load(house, "orders", _orders(spark, ("I", "2024-01-01 05:00:00.000000", 1, "2024-01-10 12:00:00", 7)))
    with monkeypatch.context() as m:
        m.setattr(type(house.stored("orders")), "replace_partitions", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            load(house, "orders", _orders(spark, ("U", "2024-01-02 05:00:00.000000", 1, "2024-02-10 12:00:00", 8)))
    load(house, "orders", _orders(spark, ("U", "2024-01-03 05:00:00.000000", 1, "2024-03-10 12:00:00", 9)))
    assert _keys(house.silver_table("orders"), "ordernumber", "customernumber") == [(1, 9)]
    assert house.stored("orders").partitions() == ["202403"]
    house.locator("orders").forget()  # as in a table of an earlier version
    load(house, "orders", _orders(spark, ("U", "2024-01-04 05:00:00.000000", 1, "2024-04-10 12:00:00", 9)))
    assert house.stored("orders").partitions() == ["202404"]


def test_a_merge_shuffles_no_constants_and_finds_lines_by_order(spark):
    """Lineage literals are added after the shuffles; the locator of lines has a row per order and place."""
    house = house_of(spark)
    load(house, "orders", _orders(spark, ("I", "2024-01-01 05:00:00.000000", 1, "2024-01-10 12:00:00", 7)))
    batch = house.batch("orderdetails", _lines(spark, *(_line(1, "2024-01-01 06:00:00.000000", product=p) for p in range(1, 4))))
    shuffles = [s.split("\n\n")[0] for s in _explain(batch, "formatted").split(") Exchange\n")[1:]]
    assert shuffles and not any("zone_area" in s for s in shuffles)
    house.merge("orderdetails", batch)
    held = house.locator("orderdetails")._read()
    assert held.columns[0] == "ordernumber" and "productcode" not in held.columns and held.count() == 1
    assert house.silver_table("orderdetails").select("zone_area", "dataset").distinct().collect() == [("silver", "orderdetails")]


def test_partitions_that_a_merge_empties_are_seen_by_its_write(spark):
    """Two orders leave their months, one of them to the null partition; the third stays."""
    house = house_of(spark)
    load(house, "orders", _orders(spark, *(("I", "2024-01-01 05:00:00.000000", i, f"2024-0{i}-10 12:00:00", 7) for i in (1, 2, 3))))
    load(house, "orders", _orders(spark, ("U", "2024-01-02 05:00:00.000000", 1, "2024-05-10 12:00:00", 7), ("U", "2024-01-02 05:00:00.000000", 2, None, 7)))
    assert set(house.stored("orders").partitions()) == {"202403", "202405", None}
    load(house, "orders", _orders(spark, ("U", "2024-01-03 05:00:00.000000", 2, "2024-03-11 12:00:00", 7)))
    assert set(house.stored("orders").partitions()) == {"202403", "202405"}
    assert _keys(house.silver_table("orders"), "ordernumber") == [(1,), (2,), (3,)]


def test_stored_tables_locators_and_logs_are_written_with_zstd(spark, tmp_path):
    import pyarrow.parquet as pq
    from pyspark.sql import types as T

    from tidemark.plans.maintain import TOUCHED, ChangeLog
    from tidemark.sources.locator import KeyLocator
    from tidemark.sources.storage import StoredTable

    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("p", T.StringType())])
    rows = spark.createDataFrame([(1, "a"), (2, None)], schema)
    table = StoredTable(spark, f"{tmp_path}/table", schema, "p")
    table.replace_partitions(rows)
    KeyLocator(spark, f"{tmp_path}/keys", schema, ["k"], "p").add(rows)
    ChangeLog(spark, f"{tmp_path}/log", TOUCHED).append(spark.sql("SELECT timestamp_ntz'2024-01-01 00:00:00' AS orderdate"))
    assert {tuple(r) for r in table.read().collect()} == {(1, "a"), (2, None)}
    for name in ("table", "keys", "log"):
        files = list((tmp_path / name).rglob("*.parquet"))
        assert files
        for f in files:
            part = pq.ParquetFile(f).metadata.row_group(0)
            assert {part.column(i).compression for i in range(part.num_columns)} == {"ZSTD"}
