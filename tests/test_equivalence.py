"""Equivalence tests: incremental = full build, reruns change nothing."""

from __future__ import annotations

import decimal

import pytest
from conftest import SF_SMALL, ts
from pyspark.sql import functions as F

from tidemark.config import ORDERS, SPECS
from tidemark.operators.merge import DuplicateKeyError
from tidemark.plans import catalog as C
from tidemark.plans.jobs import Lakehouse
from tidemark.plans.silver import silver, silver_orderdetails
from tidemark.sources import bronze as B
from tidemark.sources.feeds import feed
from tidemark.sources.files import Files
from tidemark.sources.schemas import bronze_schema
from tidemark.sources.storage import materialize, scratch_dir

CUTS = ("2024-01-04 00:00:00.000000", "2024-01-09 12:00:00.000000")
LINE_CUTS = ("1997-01-01 00:00:00.000000", "1999-06-01 00:00:00.000000")


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def _batches(df, cuts):
    """What has landed at each run: everything up to each cut, then all."""
    for hi in cuts:
        yield df.where(F.col("extract_at") <= hi)
    yield df


def test_three_batches_equal_full_build(spark):
    """Each run sees everything landed so far; the watermark picks the new rows."""
    for name in ("orders", "customers", "employees", "offices", "products"):
        spec = SPECS[name]
        f = feed(spark, SF_SMALL, name)
        target = None
        for landed in _batches(f, CUTS):
            target = materialize(silver(spec, landed, target), "t-eq")
        assert rows(target) == rows(silver(spec, f)), name


def test_order_lines_batches_equal_full_build(spark):
    lines, orders = feed(spark, SF_SMALL, "orderdetails"), feed(spark, SF_SMALL, "orders")
    target = None
    for landed in _batches(lines, LINE_CUTS):
        target = materialize(silver_orderdetails(landed, orders, target), "t-eq")
    assert rows(target) == rows(silver_orderdetails(lines, orders))


def test_pipeline_rerun_is_idempotent_and_matches_catalogue(spark):
    house = Lakehouse(spark, scratch_dir(spark, "t-pipe"), partition_grain="month")
    house.run(("bronze", "silver", "gold"), sf_dir=SF_SMALL)
    first_gold = rows(house.mart())
    first_orders = rows(house.silver_table("orders"))
    house.run(("silver", "gold"))
    assert rows(house.mart()) == first_gold
    assert rows(house.silver_table("orders")) == first_orders
    assert first_gold == rows(C.QUERIES["gold_sales_dataset"](spark, SF_SMALL))


def test_gold_total_equals_joined_lines(spark):
    mart = C.QUERIES["gold_sales_dataset"](spark, SF_SMALL)
    lines = C.QUERIES["join_details_orders_inner"](spark, SF_SMALL)
    total = mart.agg(F.sum("sales_quantityordered")).first()[0]
    # Gold keeps lines whose order, customer, rep and office all exist.
    assert 0 < total <= lines.agg(F.sum("quantityordered")).first()[0]


def test_stream_equals_batch(spark):
    got = rows(C.QUERIES["stream_silver_orders"](spark, SF_SMALL))
    assert got == rows(silver(ORDERS, feed(spark, SF_SMALL, "orders")))


def _line(order, extract_at, product=1, number=99):
    return ("I", extract_at, order, product, 1, decimal.Decimal("1.00"), number)


def _lines(spark, *rows):
    return spark.createDataFrame(list(rows), bronze_schema("orderdetails", with_partitions=False))


def _orders(spark, *rows):
    """(op, extract_at, ordernumber, order date, customer)"""
    schema = bronze_schema("orders", with_partitions=False)
    full = [{"op": o, "extract_at": at, "ordernumber": n, "orderdate": None if d is None else ts(d), "customernumber": c}
            for o, at, n, d, c in rows]
    return spark.createDataFrame([tuple(r.get(f.name) for f in schema.fields) for r in full], schema)


def _keys(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_incremental_run_rewrites_only_touched_partitions(spark):
    house = Lakehouse(spark, scratch_dir(spark, "t-part"), partition_grain="month")
    for t in ("orders", "orderdetails"):
        house.merge(t, house.batch(t, feed(spark, SF_SMALL, t)))
    table = house.stored("orderdetails")

    def files():
        return {(r.p, r.f) for r in table.read().select(
            F.col("orderdate_hour").alias("p"), F.col("_metadata.file_path").alias("f")).distinct().collect()}

    before, n_before = files(), table.read().count()
    some = house.silver_table("orders").orderBy("ordernumber").limit(3).collect()
    B.land_hourly(_lines(spark, *(_line(o.ordernumber, "2030-01-01 00:00:00.000000") for o in some)),
                  house.bronze_root, "orderdetails")
    house.run_silver(["orderdetails"])

    touched = {o.orderdate.strftime("%Y%m") for o in some}
    after = files()
    kept = {pf for pf in before if pf[0] not in touched}
    assert len({p for p, _ in before}) > len(touched)
    assert kept and kept <= after  # untouched partitions keep their files
    assert len(after) == len({p for p, _ in after})  # one file in each
    assert table.read().count() == n_before + 3
    assert table.high_watermark() == "2030-01-01 00:00:00.000000"


def test_keys_that_move_leave_no_row_behind(spark):
    house = Lakehouse(spark, scratch_dir(spark, "t-move"))  # hour partitions
    B.land_hourly(_lines(spark, _line(1, "2024-01-01 05:00:00.000000")), house.bronze_root, "orderdetails")
    house.run_silver(["orderdetails"])
    assert _keys(house.silver_table("orderdetails"), "ordernumber", "orderdate") == [(1, None)]
    B.land_hourly(_orders(spark, ("I", "2024-01-01 06:00:00.000000", 1, "2024-01-01 12:00:00", 7)), house.bronze_root, "orders")
    B.land_hourly(_lines(spark, _line(1, "2024-01-01 07:00:00.000000")), house.bronze_root, "orderdetails")
    house.run_silver(["orders", "orderdetails"])
    B.land_hourly(_orders(spark, ("U", "2024-01-02 06:00:00.000000", 1, "2024-01-03 12:00:00", 7)), house.bronze_root, "orders")
    B.land_hourly(_lines(spark, _line(1, "2024-01-02 07:00:00.000000")), house.bronze_root, "orderdetails")
    house.run_silver(["orders", "orderdetails"])
    moved = ts("2024-01-03 09:00:00")
    assert _keys(house.silver_table("orders"), "ordernumber", "orderdate") == [(1, moved)]
    assert _keys(house.silver_table("orderdetails"), "ordernumber", "orderdate") == [(1, moved)]
    assert house.stored("orders").partitions() == house.stored("orderdetails").partitions() == ["2024010309"]


def test_stream_breaks_ties_as_batch_does(spark):
    tie = "2024-01-01 05:00:00.000000"
    delete, update = ("D", tie, 1, "2024-01-01 12:00:00", 1), ("U", tie, 1, "2024-01-01 12:00:00", 2)
    want = [r.customernumber for r in silver(ORDERS, _orders(spark, delete, update)).collect()]
    for order in ([delete, update], [update, delete]):
        house = Lakehouse(spark, scratch_dir(spark, "t-tie"))
        for change in order:
            house.merge("orders", house.batch("orders", _orders(spark, change)), newer_only=True)
        assert [r.customernumber for r in house.silver_table("orders").collect()] == want == [1]


def test_interrupted_run_is_repeated(spark, monkeypatch):
    """A run that dies after the rows and before the progress changes nothing for good."""
    house = Lakehouse(spark, scratch_dir(spark, "t-dies"))
    B.land_hourly(_orders(spark, ("I", "2024-01-01 05:00:00.000000", 1, "2024-01-01 12:00:00", 7)), house.bronze_root, "orders")
    house.run_silver(["orders"])
    B.land_hourly(_orders(spark, ("U", "2024-01-05 05:00:00.000000", 1, "2024-02-01 12:00:00", 8),
                          ("I", "2024-01-05 06:00:00.000000", 2, "2024-02-02 12:00:00", 9)), house.bronze_root, "orders")
    with monkeypatch.context() as m:
        m.setattr(Files, "write_text", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            house.run_silver(["orders"])
    house.run_silver(["orders"])
    assert _keys(house.silver_table("orders"), "ordernumber", "customernumber") == [(1, 8), (2, 9)]
    assert house.stored("orders").high_watermark() == "2024-01-05 03:00:00.000000"


def test_damaged_progress_fails_the_run(spark):
    house = Lakehouse(spark, scratch_dir(spark, "t-damaged"))
    B.land_hourly(_orders(spark, ("I", "2024-01-01 05:00:00.000000", 1, "2024-01-01 12:00:00", 7)), house.bronze_root, "orders")
    house.run_silver(["orders"])
    store = house.stored("orders")
    store.files.write_text(store._progress(), "garbage")
    with pytest.raises(ValueError, match="damaged"):
        house.run_silver(["orders"])


def test_ambiguous_batch_is_refused(spark):
    house = Lakehouse(spark, scratch_dir(spark, "t-ambiguous"))
    batch = house.batch("orders", _orders(spark, ("I", "2024-01-01 05:00:00.000000", 1, "2024-01-01 12:00:00", 7)))
    with pytest.raises(DuplicateKeyError):
        house.merge("orders", batch.union(batch))


def test_full_refresh_removes_what_a_bad_load_left(spark):
    house = Lakehouse(spark, scratch_dir(spark, "t-refresh"))
    B.land_hourly(_orders(spark, ("I", "2024-01-01 05:00:00.000000", 1, "2024-01-01 12:00:00", 7)), house.bronze_root, "orders")
    house.merge("orders", house.batch("orders", _orders(spark, ("I", "2031-01-01 05:00:00.000000", 5, "2031-01-01 12:00:00", 7))))
    house.run_silver(["orders"])  # the bad load's watermark hides everything
    assert _keys(house.silver_table("orders"), "ordernumber") == [(5,)]
    house.run_silver(["orders"], full_refresh=True)
    assert _keys(house.silver_table("orders"), "ordernumber") == [(1,)]
    assert house.stored("orders").partitions() == ["2024010109"]
    assert house.stored("orders").high_watermark() == "2024-01-01 02:00:00.000000"


def test_gold_increment_reads_only_new_orders_lines_and_recompute_takes_late_ones(spark):
    house = Lakehouse(spark, scratch_dir(spark, "t-gold"), partition_grain="month")
    for t in ("customers", "employees", "offices", "orders"):
        house.merge(t, house.batch(t, feed(spark, SF_SMALL, t)))
    lines = feed(spark, SF_SMALL, "orderdetails")
    house.merge("orderdetails", house.batch("orderdetails", lines.where(F.col("extract_at") <= LINE_CUTS[1])))
    house.run_gold()
    first = rows(house.mart())
    house.merge("orderdetails", house.batch("orderdetails", lines))
    house.run_gold()  # late lines of old dates are not read again
    assert set(first) <= set(rows(house.mart()))
    house.run_gold(recompute_from="1900-01-01 00:00:00")
    assert rows(house.mart()) == rows(C.QUERIES["gold_sales_dataset"](spark, SF_SMALL))
