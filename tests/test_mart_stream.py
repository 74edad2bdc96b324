"""The streamed mart against the batch mart, with late, moved and repeated images and lost runs."""

from __future__ import annotations

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F
from test_equivalence import _line, _lines, _orders, rows
from test_maintain import dimensions, house_of

from tidemark.plans import gold as G
from tidemark.plans import jobs as J
from tidemark.plans.maintain import touched_log
from tidemark.sources.feeds import feed
from tidemark.sources.runs import RunTable
from tidemark.streaming import mart as M


def batch_mart(house):
    """The mart built whole from the tables as they are."""
    return rows(G.gold_sales(*(house.silver_table(t) for t in J.GOLD_INPUTS)).select(*M.GOLD_SCHEMA.fieldNames()))


def changes(spark, orders=(), lines=()):
    return {"orders": _orders(spark, *orders), "orderdetails": _lines(spark, *lines)}


def order(number, day, customer, at="2024-01-01 05:00:00.000000", op="I"):
    return (op, at, number, f"2024-{day} 12:00:00", customer)


def test_old_images_go_out_and_new_ones_in(spark):
    house = house_of(spark, maintain=True)
    c = dimensions(spark, house)
    batches = M.MartBatches(house, "s")
    steps = [
        changes(spark, [order(1, "01-10", c), order(2, "03-10", c)], [_line(1, "2024-01-01 06:00:00.000000"), _line(3, "2024-01-01 06:00:00.000000")]),
        changes(spark, [order(3, "02-10", c)], [_line(2, "2024-01-02 06:00:00.000000", number=7)]),  # an order after its line, a line after its order
        changes(spark, [order(1, "05-10", c, "2024-01-03 05:00:00.000000", "U")]),  # moves; its group is left empty
        changes(spark, [order(1, "04-10", c, "2024-01-02 05:00:00.000000", "U")]),  # an older image that comes late
        changes(spark, lines=[_line(2, "2024-01-04 06:00:00.000000", number=7), _line(2, "2024-01-04 06:00:00.000000", product=5)]),
        changes(spark, [order(3, "02-10", 10**9, "2024-01-05 05:00:00.000000", "U")]),  # to a customer that is not there
        changes(spark),
    ]
    days = []
    for i, step in enumerate(steps):
        batches.apply(step, i)
        assert rows(M.streamed_mart(house)) == batch_mart(house), i
        days.append(sorted({r.calendar_sales_date.strftime("%m-%d") for r in M.streamed_mart(house).collect()}))
    assert days[0] == ["01-10"] and days[1] == ["01-10", "02-10", "03-10"] and days[2] == ["02-10", "03-10", "05-10"]
    assert days[3] == days[2] and days[5] == ["03-10", "05-10"]
    assert not touched_log(house).entries()
    batches.apply(steps[1], 1)  # an old number changes nothing
    assert rows(M.streamed_mart(house)) == batch_mart(house)


@pytest.mark.parametrize("lost_at", ["merge lines", "repair", "append", "after append"])
def test_batch_that_dies_is_made_up_for(spark, monkeypatch, lost_at):
    house = house_of(spark, maintain=True)
    c = dimensions(spark, house)
    batches = M.MartBatches(house, "s")
    batches.apply(changes(spark, [order(1, "01-10", c)], [_line(1, "2024-01-01 06:00:00.000000")]), 0)
    second = changes(spark, [order(1, "02-10", c, "2024-01-02 05:00:00.000000", "U"), order(2, "02-11", c)],
                     [_line(1, "2024-01-02 06:00:00.000000", product=2), _line(2, "2024-01-02 06:00:00.000000")])
    with monkeypatch.context() as m:
        if lost_at == "merge lines":
            merge = house.merge
            m.setattr(house, "merge", lambda t, b, **k: merge(t, b, **k) if t == "orders" else 1 / 0)
        elif lost_at == "repair":
            m.setattr(M, "repair_lines", lambda h: 1 / 0)
        elif lost_at == "append":
            m.setattr(RunTable, "append", lambda *a: 1 / 0)
        else:
            append = RunTable.append
            m.setattr(RunTable, "append", lambda *a: (append(*a), 1 / 0))
        with pytest.raises(ZeroDivisionError):
            batches.apply(second, 1)
    M.MartBatches(house, "s").apply(second, 1)
    assert rows(M.streamed_mart(house)) == batch_mart(house)
    assert len(batch_mart(house)) == 2


def test_mart_follows_dimensions_and_keeps_null_sums(spark):
    house = house_of(spark, maintain=True)
    c = dimensions(spark, house)
    lines = _lines(spark, _line(1, "2024-01-01 06:00:00.000000")).withColumn("priceeach", F.lit(None).cast("decimal(18,2)"))
    lines = lines.withColumn("quantityordered", F.lit(None).cast("long"))
    M.MartBatches(house, "s").apply({"orders": _orders(spark, order(1, "01-10", c)), "orderdetails": lines}, 0)
    (row,) = M.streamed_mart(house).collect()
    assert (row.interval_portsales, row.sales_quantityordered, row.sales_amount) == ("Big", None, None)
    assert rows(M.streamed_mart(house)) == batch_mart(house)
    later = feed(spark, SF_SMALL, "offices").withColumn("territory", F.lit("elsewhere")).withColumn("extract_at", F.lit("2031-01-01 00:00:00.000000"))
    house.merge("offices", house.batch("offices", later))
    assert M.streamed_mart(house).first().locality_territory == "elsewhere"


def test_needs_maintained_line_dates(spark):
    with pytest.raises(ValueError, match="maintains"):
        M.MartBatches(house_of(spark), "s")
