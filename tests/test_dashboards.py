"""Maintained dashboards equal those built from the mart, and read only what was replaced."""

from __future__ import annotations

import re

import pytest
from test_equivalence import _line, _lines, _orders
from test_maintain import dimensions, house_of, load
from test_plans import _explain

from tidemark.plans import gold as G
from tidemark.plans.dashboards import Dashboards
from tidemark.sources.storage import StoredTable


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def same(house):
    d, mart = house.dashboards, house.mart()
    return (rows(d.quantity_by_country()) == rows(G.bi_quantity_by_country(mart))
            and rows(d.quantity_total()) == rows(G.bi_quantity_total(mart))
            and rows(d.amount_by_territory_city()) == rows(G.bi_amount_by_territory_city(mart)))


def order(number, day, customer, at="2024-01-01 05:00:00.000000", op="I"):
    return (op, at, number, f"2024-{day} 12:00:00", customer)


def loaded(spark, **more):
    house = house_of(spark, dashboards=True, **more)
    c = dimensions(spark, house)
    load(house, "orders", _orders(spark, *(order(m, f"{m:02d}-10", c) for m in (1, 2, 3))))
    load(house, "orderdetails", _lines(spark, *(_line(m, "2024-01-01 06:00:00.000000") for m in (1, 2, 3, 4))))
    house.run_gold()
    return house, c


def test_sums_follow_increments_moves_recomputes_and_refreshes(spark):
    house, c = loaded(spark, maintain=True)
    assert house.dashboards.quantity_total().first()[0] == 3 and same(house)
    # A new order, one that moves and leaves its month empty.
    load(house, "orders", _orders(spark, order(4, "04-10", c), order(2, "03-11", c, "2024-01-02 05:00:00.000000", "U")))
    house.run_gold()
    assert house.dashboards.store.partitions() == house.gold.partitions() == ["202401", "202403", "202404"]
    assert house.dashboards.quantity_total().first()[0] == 4 and same(house)
    load(house, "orderdetails", _lines(spark, _line(1, "2024-01-02 06:00:00.000000", product=3)))
    house.run_gold(recompute_from="2024-01-01")
    assert house.dashboards.quantity_total().first()[0] == 5 and same(house)
    house.run_gold(full_refresh=True)
    house.run_gold()
    assert same(house) and not house.dashboards.log.entries()


def test_only_replaced_partitions_are_read(spark):
    house, c = loaded(spark)
    load(house, "orders", _orders(spark, order(4, "04-10", c)))
    load(house, "orderdetails", _lines(spark, _line(4, "2024-01-02 06:00:00.000000")))
    old = {n for m in ("202401", "202402", "202403") for n in house.dashboards.store.files.walk(f"{house.dashboards.store.path}/sales_month={m}")}
    house.run_gold()
    new = {n for m in ("202401", "202402", "202403") for n in house.dashboards.store.files.walk(f"{house.dashboards.store.path}/sales_month={m}")}
    assert old == new and same(house)
    plan = _explain(house.dashboards.of_months({"202404"}), "formatted")
    assert re.search(r"PartitionFilters: \[.*sales_month#\d+ (=|IN) \(?202404", plan)
    for df in (house.dashboards.quantity_by_country(), house.dashboards.amount_by_territory_city()):
        assert all("dashboard_sums" in f for f in df.inputFiles())


@pytest.mark.parametrize("lost_at", ["mart", "sums"])
def test_run_that_dies_is_made_up_for(spark, monkeypatch, lost_at):
    house, c = loaded(spark)
    load(house, "orders", _orders(spark, order(4, "04-10", c)))
    load(house, "orderdetails", _lines(spark, _line(4, "2024-01-02 06:00:00.000000")))
    with monkeypatch.context() as m:
        if lost_at == "mart":
            replace = StoredTable.replace_partitions
            m.setattr(StoredTable, "replace_partitions", lambda *a: (replace(*a), 1 / 0))
        else:
            m.setattr(Dashboards, "refresh", lambda self: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            house.run_gold()
    house.run_gold()  # nothing new for the mart
    assert same(house) and house.dashboards.quantity_total().first()[0] == 4


def test_mart_without_rows_and_dashboards_that_come_later(spark):
    empty = house_of(spark, dashboards=True)
    assert empty.dashboards.quantity_total().collect()[0][0] is None
    assert empty.dashboards.quantity_by_country().collect() == []
    house, _ = loaded(spark)
    house.dashboards.store.files.delete(house.dashboards.store.path)
    house.run_gold()
    assert same(house)
