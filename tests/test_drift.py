"""Landed files that differ from the declared schema are reported, others are not."""

from __future__ import annotations

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from tidemark.config import PARTITION_COLS
from tidemark.sources import bronze as B
from tidemark.sources import drift
from tidemark.sources.feeds import feed
from tidemark.sources.storage import scratch_dir

DAY = "2024-01-0{} 05:00:00.000000"


def land(root, df, day, layout="kv"):
    parts = ("2024", "01", f"0{day}", "02")
    hour = "/".join(f"{c}={v}" for c, v in zip(PARTITION_COLS, parts, strict=True)) if layout == "kv" else "/".join(parts)
    df.coalesce(1).write.mode("append").parquet(f"{B.table_root(root, 'orders')}/{hour}")


def orders(spark, day, n=3):
    return feed(spark, SF_SMALL, "orders").drop(*PARTITION_COLS).limit(n).withColumn("extract_at", F.lit(DAY.format(day)))


def report(spark, root, **more):
    return sorted((r.column, r.declared, r.found, r.fault, r.files, r.rows) for r in drift.schema_drift(spark, root, ["orders", "offices"], **more).collect())


@pytest.mark.parametrize("layout", ["kv", "slash"])
@pytest.mark.parametrize("direct", [True, False])
def test_differences_are_reported_once_per_column(spark, monkeypatch, layout, direct):
    if not direct:
        monkeypatch.setattr(drift, "DIRECT", ())
    root = scratch_dir(spark, "t drift%20a")  # names that a path escapes
    assert report(spark, root, layout=layout) == []  # nothing has landed
    land(root, orders(spark, 1), 1, layout)
    assert report(spark, root, layout=layout) == []
    for _ in range(2):
        land(root, orders(spark, 2).withColumnRenamed("requireddate", "requirededate"), 2, layout)
    land(root, orders(spark, 3).withColumn("customernumber", F.col("customernumber").cast("decimal(20,0)")).withColumn("extra", F.array(F.lit(1))), 3, layout)
    land(root, orders(spark, 3, 0).drop("op"), 3, layout)  # a file without rows
    late = [("customernumber", "bigint", "decimal(20,0)", "type", 1, 3), ("extra", None, "array<int>", "unknown", 1, 3), ("op", "string", None, "missing", 1, 0)]
    renamed = [("requirededate", None, "timestamp_ntz", "unknown", 2, 6), ("requireddate", "timestamp_ntz", None, "missing", 2, 6)]
    assert report(spark, root, layout=layout) == sorted(late + renamed)
    if layout == "kv":
        assert report(spark, root, since="2024-01-03 05:30:00.000000") == late


def test_first_file_is_named_and_damaged_files_fail(spark):
    root = scratch_dir(spark, "t-drift")
    land(root, orders(spark, 2).drop("shippeddate"), 2)
    (row,) = drift.schema_drift(spark, root, ["orders"]).collect()
    assert spark.read.parquet(row.first_file).count() == 3
    hour = f"{B.table_root(root, 'orders')}/year_stream=2024/month_stream=01/day_stream=02/hour_stream=02"
    spark.createDataFrame([("no parquet",)], "value string").coalesce(1).write.mode("append").text(f"{hour}/x.parquet")
    files = drift.Files(spark)
    (name,) = [n for n in files.names(f"{hour}/x.parquet") if n.endswith(".txt")]
    files.move(f"{hour}/x.parquet/{name}", f"{hour}/bad.parquet")
    files.delete(f"{hour}/x.parquet")
    with pytest.raises(Exception, match="(?i)parquet"):
        drift.schema_drift(spark, root, ["orders"]).collect()
