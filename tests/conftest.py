from __future__ import annotations

import datetime as dt
import decimal
import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    builder = (
        SparkSession.builder.master("local[4]")
        .appName("tidemark-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
    )
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    # Shared scratch: the cluster's setting when present, a temp dir in tests.
    if not session.conf.get("spark.checkpoint.dir", None):
        session.conf.set("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoint")))
    yield session


def ts(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)


def money(x) -> decimal.Decimal | None:
    return None if x is None else decimal.Decimal(str(x)).quantize(decimal.Decimal("0.01"))


@pytest.fixture
def bronze(spark):
    """Build a bronze change-feed DataFrame from a few dicts (missing -> null)."""
    from tidemark.sources.bronze import with_partition_values
    from tidemark.sources.schemas import bronze_schema

    def make(table: str, records: list[dict]):
        schema = bronze_schema(table, with_partitions=False)
        rows = [tuple(r.get(f.name) for f in schema.fields) for r in records]
        return with_partition_values(spark.createDataFrame(rows, schema))

    return make
