"""Operator tests on hand-made change rows (one per edge case of the pipeline)."""

from __future__ import annotations

import pytest
from conftest import money, ts
from pyspark.sql import functions as F

from tidemark.config import CUSTOMERS, EMPLOYEES, OFFICES, ORDERS
from tidemark.functions.scalar import blank_to_null, sale_bucket
from tidemark.functions.time import parse_extract_at, partition_values
from tidemark.operators.merge import DuplicateKeyError, assert_unique_keys, newer_source, upsert
from tidemark.plans.gold import gold_sales
from tidemark.plans.silver import silver, silver_batch, silver_orderdetails


def order(op, at, num=1, date="2024-03-01 12:00:00", cust=7):
    return {"op": op, "extract_at": at, "ordernumber": num, "orderdate": ts(date),
            "customernumber": cust}


def test_last_image_wins(bronze):
    feed = bronze("orders", [
        order("I", "2024-01-01 00:00:00.000000", cust=1),
        order("U", "2024-01-01 01:00:00.000000", cust=2),
        order("U", "2024-01-01 02:00:00.000000", cust=3),
    ])
    rows = silver(ORDERS, feed).collect()
    assert [r.customernumber for r in rows] == [3]


def test_delete_ignored_for_customers(bronze):
    feed = bronze("customers", [
        {"op": "I", "extract_at": "2024-01-01 00:00:00.000000", "customernumber": 5, "customername": "a"},
        {"op": "D", "extract_at": "2024-01-02 00:00:00.000000", "customernumber": 5, "customername": "b"},
    ])
    assert [r.customername for r in silver(CUSTOMERS, feed).collect()] == ["a"]


def test_delete_image_kept_for_orders(bronze):
    feed = bronze("orders", [
        order("I", "2024-01-01 00:00:00.000000", cust=1),
        order("D", "2024-01-02 00:00:00.000000", cust=2),
    ])
    assert [r.customernumber for r in silver(ORDERS, feed).collect()] == [2]


def test_equal_change_time_is_deterministic(bronze):
    at = "2024-01-01 00:00:00.000000"
    rows = [order("I", at, cust=9), order("U", at, cust=1), order("U", at, cust=4)]
    # Same result whatever the input order: U beats I, then payload desc.
    for perm in (rows, rows[::-1], rows[1:] + rows[:1]):
        assert [r.customernumber for r in silver(ORDERS, bronze("orders", perm)).collect()] == [4]


def test_employee_versions_dedupe_and_nodedup(bronze):
    feed = bronze("employees", [
        {"op": "I", "extract_at": "2024-01-01 00:00:00.000000", "employeenumber": 3, "officecode": "1",
         "extension": "x0"},
        {"op": "U", "extract_at": "2024-01-01 05:00:00.000000", "employeenumber": 3, "officecode": "1",
         "extension": "x1"},
    ])
    assert [r.extension for r in silver(EMPLOYEES, feed).collect()] == ["x1"]
    assert silver(EMPLOYEES, feed, dedupe=False).count() == 2
    r = silver(EMPLOYEES, feed).collect()[0]
    assert r.reportsto == 0 and r.officecode == 1


def test_product_on_two_lines_and_unknown_order(bronze):
    at = "2024-01-01 00:00:00.000000"
    details = bronze("orderdetails", [
        {"op": "I", "extract_at": at, "ordernumber": 1, "productcode": 10, "quantityordered": 2,
         "priceeach": money(1.5), "orderlinenumber": 1},
        {"op": "I", "extract_at": at, "ordernumber": 1, "productcode": 10, "quantityordered": 1,
         "priceeach": money(2), "orderlinenumber": 2},
        {"op": "I", "extract_at": at, "ordernumber": 99, "productcode": 10, "quantityordered": 1,
         "priceeach": money(2), "orderlinenumber": 1},
    ])
    orders = bronze("orders", [order("I", at, num=1, date="2024-03-01 12:00:00")])
    out = {(r.ordernumber, r.orderlinenumber): r for r in silver_orderdetails(details, orders).collect()}
    assert len(out) == 3
    assert out[(1, 1)].amount == 3.0 and out[(1, 1)].orderdate == ts("2024-03-01 09:00:00")
    assert out[(99, 1)].orderdate is None


def test_bucket_bounds(spark):
    df = spark.createDataFrame([(50000.0,), (50000.01,), (75000.0,), (75000.01,), (None,)], "a double")
    got = [r.b for r in df.select(sale_bucket("a").alias("b")).collect()]
    assert got == ["Small", "Medium", "Medium", "Big", "Big"]


def test_blank_state(spark):
    df = spark.createDataFrame([("",), (" ",), (None,)], "s string")
    assert [r.x for r in df.select(blank_to_null("s").alias("x")).collect()] == [None, " ", None]


def test_year_month_uses_local_date(bronze):
    feed = bronze("orders", [order("I", "2024-03-01 02:10:00.000000", date="2024-03-01 02:10:00")])
    r = silver(ORDERS, feed).collect()[0]
    assert r.orderyearmonth == 202402
    assert r.extract_at == ts("2024-02-29 23:10:00")


def test_parse_extract_at_digits_and_junk(spark):
    df = spark.createDataFrame([("2024-01-01 00:00:00",), ("2024-01-01 00:00:00.5",),
                                ("2024-01-01 00:00:00.123456",)], "extract_at string")
    got = [r.t for r in df.select(parse_extract_at().alias("t")).collect()]
    assert got == [ts("2024-01-01 00:00:00"), ts("2024-01-01 00:00:00.5"),
                   ts("2024-01-01 00:00:00.123456")]
    bad = spark.createDataFrame([("yesterday",)], "extract_at string")
    with pytest.raises(Exception):
        bad.select(parse_extract_at()).collect()


def test_partition_hour_is_utc_minus_3(spark):
    df = spark.createDataFrame([("2024-01-02 01:30:00.000000",)], "extract_at string")
    r = df.select(*partition_values(parse_extract_at())).collect()[0]
    assert (r.year_stream, r.month_stream, r.day_stream, r.hour_stream) == ("2024", "01", "01", "22")


def test_bad_officecode_fails(bronze):
    feed = bronze("offices", [{"op": "I", "extract_at": "2024-01-01 00:00:00.000000", "officecode": "x"}])
    with pytest.raises(Exception):
        silver(OFFICES, feed).collect()


def test_replay_window_orders_vs_details(bronze):
    """A row 2 h older than the newest loaded one: re-read for orders, skipped for lines."""
    first = bronze("orders", [order("I", "2024-01-01 10:00:00.000000", num=1, cust=1)])
    target = silver(ORDERS, first)
    late = bronze("orders", [order("I", "2024-01-01 10:00:00.000000", num=1, cust=1),
                             order("I", "2024-01-01 08:00:00.000000", num=2, cust=2)])
    assert sorted(r.ordernumber for r in silver(ORDERS, late, target).collect()) == [1, 2]

    line = {"productcode": 1, "quantityordered": 1, "priceeach": money(1), "orderlinenumber": 1}
    d1 = bronze("orderdetails", [{"op": "I", "extract_at": "2024-01-01 10:00:00.000000",
                                  "ordernumber": 1, **line}])
    tgt = silver_orderdetails(d1, first)
    d2 = bronze("orderdetails", [{"op": "I", "extract_at": "2024-01-01 10:00:00.000000", "ordernumber": 1, **line},
                                 {"op": "I", "extract_at": "2024-01-01 08:00:00.000000", "ordernumber": 2, **line}])
    assert sorted(r.ordernumber for r in silver_orderdetails(d2, first, tgt).collect()) == [1]


def test_empty_target_loads_everything(bronze, spark):
    feed = bronze("orders", [order("I", "2024-01-01 10:00:00.000000", num=n) for n in (1, 2)])
    empty = silver(ORDERS, feed).limit(0)
    assert silver(ORDERS, feed, empty).count() == 2


def test_same_batch_twice_is_identical(bronze):
    feed = bronze("orders", [order("I", "2024-01-01 10:00:00.000000", num=n, cust=n) for n in (1, 2, 3)])
    once = silver(ORDERS, feed)
    twice = silver(ORDERS, feed, once)
    assert sorted(once.collect()) == sorted(twice.collect())


def test_newer_only_guard_ignores_replayed_old_images(bronze):
    new = silver(ORDERS, bronze("orders", [order("U", "2024-01-02 00:00:00.000000", cust=2)]))
    old_batch = bronze("orders", [order("I", "2024-01-01 00:00:00.000000", cust=1)])
    # The watermark alone already drops the older row ...
    assert [r.customernumber for r in silver(ORDERS, old_batch, new).collect()] == [2]
    # ... a replayed micro-batch (no watermark) needs the guard.
    rows = silver_batch(ORDERS, old_batch)
    guard = ["extract_at"] + ORDERS.tiebreak
    assert newer_source(new, rows, ORDERS.keys, guard).count() == 0
    assert [r.customernumber for r in upsert(new, rows, ORDERS.keys, newer_only=guard).collect()] == [2]
    assert [r.customernumber for r in upsert(new, rows, ORDERS.keys).collect()] == [1]


def test_upsert_composite_key_and_unique_check(spark):
    t = spark.createDataFrame([(1, 1, "a"), (1, 2, "b")], "k1 long, k2 long, v string")
    s = spark.createDataFrame([(1, 2, "B"), (2, 1, "c")], "k1 long, k2 long, v string")
    got = sorted((r.k1, r.k2, r.v) for r in upsert(t, s, ["k1", "k2"]).collect())
    assert got == [(1, 1, "a"), (1, 2, "B"), (2, 1, "c")]
    with pytest.raises(DuplicateKeyError):
        assert_unique_keys(s.union(s), ["k1", "k2"])


def test_customer_without_rep_is_zero_and_leaves_gold(bronze):
    at = "2024-01-01 00:00:00.000000"
    customers = bronze("customers", [
        {"op": "I", "extract_at": at, "customernumber": 1, "salesrepemployeenumber": None},
        {"op": "I", "extract_at": at, "customernumber": 2, "salesrepemployeenumber": 3},
    ])
    employees = bronze("employees", [{"op": "I", "extract_at": at, "employeenumber": 3, "officecode": "4"}])
    offices = bronze("offices", [{"op": "I", "extract_at": at, "officecode": "4", "city": "c", "state": "",
                                  "country": "X", "territory": "T"}])
    orders = bronze("orders", [order("I", at, num=10, cust=1), order("I", at, num=11, cust=2)])
    line = {"op": "I", "extract_at": at, "productcode": 1, "quantityordered": 2, "priceeach": money(10),
            "orderlinenumber": 1}
    details = bronze("orderdetails", [{**line, "ordernumber": 10}, {**line, "ordernumber": 11}])
    c = silver(CUSTOMERS, customers)
    assert sorted(r.salesrepemployeenumber for r in c.collect()) == [0, 3]
    mart = gold_sales(silver_orderdetails(details, orders), silver(ORDERS, orders), c,
                      silver(EMPLOYEES, employees), silver(OFFICES, offices)).collect()
    assert len(mart) == 1
    m = mart[0]
    assert (m.locality_officecode, m.locality_state, m.sales_quantityordered, m.sales_amount) == (4, None, 2, 20.0)
    assert (m.calendar_monthname_full, m.calendar_monthname_short, m.calendar_quarter) == ("March", "03", 1)


def test_backfill_lands_once(spark):
    from tidemark.sources import bronze as B
    from tidemark.sources.storage import scratch_dir

    root, manifest = scratch_dir(spark, "t-bronze"), scratch_dir(spark, "t-manifest")
    rows = spark.createDataFrame(
        [("I", "2024-01-01 00:00:00.000000", 1, "p")],
        "op string, extract_at string, productcode long, productname string")
    full = rows.select(*[F.col(c) for c in rows.columns])
    from tidemark.sources.schemas import bronze_schema
    payload = bronze_schema("products", with_partitions=False)
    full = full.select(*[(F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                         for f in payload.fields])
    B.drop_full_load(full, root, "products")
    assert B.backfill(spark, root, "products", manifest).count() == 1
    assert B.backfill(spark, root, "products", manifest).count() == 0
    landed = B.scan_bronze(spark, root, "products").collect()
    assert len(landed) == 1
    assert (landed[0].year_stream, landed[0].month_stream, landed[0].day_stream, landed[0].hour_stream) == \
        ("2026", "01", "01", "00")


def test_landing_the_same_hours_again_changes_nothing(spark, bronze):
    from tidemark.sources import bronze as B
    from tidemark.sources.storage import scratch_dir

    root = scratch_dir(spark, "t-land")
    rows = bronze("orders", [order("I", "2024-01-01 10:00:00.000000", num=n) for n in (1, 2)]
                  + [order("I", "2026-01-01 03:10:00.000000", num=3)])  # one in the full-load hour
    for _ in range(2):
        B.land_hourly(rows, root, "orders", replace=True)
    assert sorted(r.ordernumber for r in B.scan_bronze(spark, root, "orders").collect()) == [1, 2, 3]


def test_backfill_that_died_before_its_manifest_adds_nothing(spark, bronze):
    from tidemark.sources import bronze as B
    from tidemark.sources.storage import scratch_dir

    root = scratch_dir(spark, "t-died")
    rows = bronze("orders", [order("I", "2024-01-01 10:00:00.000000", num=n) for n in (1, 2)])
    B.drop_full_load(rows, root, "orders")
    for _ in range(2):  # another manifest each time: the first was lost
        B.backfill(spark, root, "orders", scratch_dir(spark, "t-manifest"))
    assert B.scan_bronze(spark, root, "orders").count() == 2


def test_scan_since_keeps_full_loads_and_lists_no_older_hour(spark, bronze):
    from tidemark.sources import bronze as B
    from tidemark.sources.storage import scratch_dir

    root = scratch_dir(spark, "t-since")
    times = ["2023-12-31 10", "2024-01-30 10", "2024-02-10 10", "2024-02-10 23", "2024-02-11 01", "2024-03-01 10", "2025-01-01 10", "2026-07-01 10"]
    B.land_hourly(bronze("orders", [order("I", f"{t}:00:00.000000", num=n) for n, t in enumerate(times)]), root, "orders")
    B.drop_full_load(bronze("orders", [order("I", "2026-07-02 10:00:00.000000", num=90), order("I", "2020-07-02 10:00:00.000000", num=91)]), root, "orders")
    B.backfill(spark, root, "orders", scratch_dir(spark, "t-manifest"))
    got = B.scan_bronze(spark, root, "orders", since="2024-02-10 22:00:00.000000")
    assert sorted(r.ordernumber for r in got.collect()) == [3, 4, 5, 6, 7, 90]
    assert not any("month_stream=01/day_stream=30" in f or "year_stream=2023" in f for f in got.inputFiles())
    late = B.scan_bronze(spark, root, "orders", since="2026-06-01 00:00:00.000000")
    assert sorted(r.ordernumber for r in late.collect()) == [7, 90]  # a full load is never pruned by its partition
    assert B.scan_bronze(spark, root, "customers", since="2024-01-01 00:00:00.000000").count() == 0


def test_shared_folder_is_needed_on_a_cluster():
    from types import SimpleNamespace

    from tidemark.sources.storage import shared_root

    none = SimpleNamespace(conf=SimpleNamespace(get=lambda *a: None),
                           sparkContext=SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_root(none)


def test_results_do_not_depend_on_session_time_zone(spark):
    from conftest import SF_SMALL

    from tidemark.plans import catalog as C

    names = ("bronze_partition_values", "silver_orders", "gold_sales_dataset", "calendar_attributes")
    results = {}
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/New_York", "America/Sao_Paulo"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            results[zone] = {n: sorted(tuple(r) for r in C.QUERIES[n](spark, SF_SMALL).collect())
                             for n in names}
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert results["UTC"] == results["America/New_York"] == results["America/Sao_Paulo"]


def test_dst_gap_wall_clock_is_kept(spark):
    from tidemark.functions.time import format_extract_at

    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        df = spark.createDataFrame([("2024-03-10 05:30:00.000000",)], "extract_at string")
        r = df.select(format_extract_at(parse_extract_at()).alias("t"),
                      *partition_values(parse_extract_at())).collect()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert r.t == "2024-03-10 05:30:00.000000" and r.hour_stream == "02"


def test_newer_source_is_one_join_and_orders_nulls_last(spark):
    """Full ties win, nulls lose to values, null keys match nothing."""
    fields = "k long, t long, v double, w string"
    target = spark.createDataFrame([(1, 5, 1.0, "a"), (2, 5, None, "a"), (3, None, 1.0, "a"), (4, 5, float("nan"), "a"), (5, 5, 1.0, "a"), (None, 9, 9.0, "a")], fields)
    source = spark.createDataFrame([(1, 5, 1.0, "b"), (2, 5, 0.0, "b"), (3, None, None, "b"), (4, 5, 7.0, "b"), (5, 4, 9.0, "b"), (6, None, None, "b"), (None, 1, 1.0, "b")], fields)
    newer = newer_source(target, source, ["k"], ["t", "v"])
    assert sorted(newer.collect(), key=str) == sorted(source.where("k in (1, 2, 6) or k is null").collect(), key=str)
    plan = newer._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and plan.count("Join ") == 1
