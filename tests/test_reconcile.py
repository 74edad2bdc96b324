"""Landed hours against the hours that the catalog has registered."""

from __future__ import annotations

import datetime as dt
import uuid

import pytest

from tidemark.sources import bronze as B
from tidemark.sources.schemas import bronze_schema
from tidemark.sources.storage import shared_root

PAYLOAD = bronze_schema("offices", with_partitions=False)


def test_unregistered_hours_are_found_and_registered(spark, tmp_path):
    shared_root(spark)
    db, root = f"raw_{uuid.uuid4().hex[:8]}", str(tmp_path / "bronze")
    assert B.hours_status(spark, root, "offices", db).count() == 0
    rows = [("I", f"2024-03-01 {3 + i % 3:02d}:30:00.000000", str(i), *["x"] * (len(PAYLOAD) - 3)) for i in range(9)]
    B.land_hourly(spark.createDataFrame(rows, PAYLOAD), root, "offices")

    def status():
        return {(r.hour_stream, r.row_count, r.status) for r in B.hours_status(spark, root, "offices", db).collect()}

    assert status() == {(f"0{h}", 3, "unregistered") for h in range(3)}
    for hour in (4, 9):  # one landed hour (UTC-3) and one at which nothing came
        B.activate_partition(spark, root, "offices", dt.datetime(2024, 3, 1, hour, 15), database=db)
    assert status() == {("00", 3, "unregistered"), ("01", 3, "registered"), ("02", 3, "unregistered"), ("06", 0, "empty")}
    assert spark.table(f"{db}.offices").count() == 3
    assert {r.hour_stream for r in B.register_missing(spark, root, "offices", db).collect()} == {"00", "02"}
    assert spark.table(f"{db}.offices").count() == 9
    assert B.register_missing(spark, root, "offices", db).count() == 0
    assert {s for _, _, s in status()} == {"registered", "empty"}
    with pytest.raises(ValueError):
        B.hours_status(spark, str(tmp_path / "elsewhere"), "offices", db)
    spark.sql(f"DROP DATABASE {db} CASCADE")
