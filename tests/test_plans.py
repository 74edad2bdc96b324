"""Plan tests: the physical plans have the shape the design relies on."""

from __future__ import annotations

import re

from conftest import SF_SMALL

from tidemark.config import ORDERS
from tidemark.plans import catalog as C
from tidemark.plans import gold as G
from tidemark.plans.jobs import Lakehouse
from tidemark.plans.silver import silver
from tidemark.sources.feeds import feed
from tidemark.sources.storage import scratch_dir

# Catalogue queries whose construction has no side effect (no landing).
PURE = [n for n in C.QUERIES if not n.startswith(("bronze_", "pipeline_", "stream_"))]


def plan(df, mode="formatted") -> str:
    return df._jdf.queryExecution().executedPlan().toString() if mode == "raw" else _explain(df, mode)


def _explain(df, mode: str) -> str:
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def test_latest_per_key_limits_before_shuffle(spark):
    p = _explain(silver(ORDERS, feed(spark, SF_SMALL, "orders")), "simple")
    assert "WindowGroupLimit" in p
    assert ", Partial" in p and ", Final" in p
    assert p.count("Exchange hashpartitioning(ordernumber") == 1


def test_gold_exchanges_order_lines_once(spark):
    p = _explain(G.gold_sales(*C.gold_inputs(spark, SF_SMALL)), "simple")
    # Lines: one exchange for the dedupe window, one on ordernumber for the
    # per-order aggregate, which the join with orders reuses.
    assert not re.search(r"Exchange hashpartitioning\(ordernumber#\d+L, interval_portsales", p)
    assert "partial_sum" in p


def test_no_python_udf_in_any_plan(spark):
    for name in PURE:
        p = _explain(C.QUERIES[name](spark, SF_SMALL), "simple")
        for node in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "FlatMapGroupsInPandas"):
            assert node not in p, (name, node)


def test_incremental_scan_is_pruned_and_pushed(spark):
    house = Lakehouse(spark, scratch_dir(spark, "t-lh"), partition_grain="month")
    house.land(SF_SMALL, ["customers"])
    house.run_silver(["customers"])
    df = house.bronze("customers", house.stored("customers").high_watermark())
    p = _explain(df, "formatted")
    assert re.search(r"PushedFilters: \[.*GreaterThanOrEqual\(extract_at,", p)
    assert len(df.inputFiles()) < len(house.bronze("customers").inputFiles())


def test_gold_increment_cuts_lines_before_the_aggregate(spark):
    inputs = C.gold_inputs(spark, SF_SMALL)
    target = G.gold_sales(*inputs).limit(1)
    p = _explain(G.gold_batch(*inputs, target=target, high_watermark="1998-01-01 00:00:00.000000"), "simple")
    aggregate = p.index("partial_sum(CASE") if "partial_sum(CASE" in p else p.index("partial_count")
    assert "LeftSemi" in p[aggregate:]


def test_op_filter_pushed_to_landed_scan(spark):
    from tidemark.operators.cdc import cdc_filter
    from tidemark.sources import bronze as B

    root = scratch_dir(spark, "t-bronze")
    B.land_hourly(feed(spark, SF_SMALL, "customers"), root, "customers")
    p = _explain(cdc_filter(B.scan_bronze(spark, root, "customers"), ["I", "U"]), "formatted")
    assert re.search(r"PushedFilters: \[.*In\(op, \[I,U\]\)", p)
