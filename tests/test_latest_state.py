"""Newest row per key in the state store: changed keys only, each batch once, old runs stay."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.sources.runs import RunTable
from tidemark.sources.storage import scratch_dir
from tidemark.streaming.stream import latest_table, stream_latest_stateful

SCHEMA = "k long, ts timestamp_ntz, n long, v string"


class Feed:
    """A stream of files, one batch a file, and the table that it feeds."""

    def __init__(self, spark):
        self.spark, self.root = spark, scratch_dir(spark, "t-latest")
        self.schema = spark.createDataFrame([], SCHEMA).schema
        self.table = latest_table(spark, f"{self.root}/latest", self.schema, ["k"], ["ts", "n"])

    def put(self, *rows):
        at = [(k, None if t is None else dt.datetime(2024, 1, t), n, v) for k, t, n, v in rows]
        self.spark.createDataFrame(at, self.schema).coalesce(1).write.mode("append").parquet(f"{self.root}/in")

    def run(self):
        stream_latest_stateful(self.spark, f"{self.root}/in", self.schema, ["k"], ["ts", "n"], self.table,
                               f"{self.root}/checkpoint").awaitTermination()

    def latest(self):
        return {r.k: r.v for r in self.table.read().collect()}


def test_only_changed_keys_reach_the_sink_and_old_runs_stay(spark, monkeypatch):
    feed = Feed(spark)
    feed.put(*((k, 5, 0, f"a{k}") for k in range(40)), (None, 5, 0, "none"))
    feed.run()
    first = feed.table.runs()
    assert len(first) == 1
    sizes = []
    write = RunTable._write
    monkeypatch.setattr(RunTable, "_write", lambda self, rows: (sizes.append(out := write(self, rows)), out)[1])
    # One newer row; an older one, the same row again, a row without time: these change nothing.
    feed.put((1, 6, 0, "b1"), (2, 4, 0, "old"), (3, 5, 0, "a3"), (4, None, 0, "late"))
    feed.run()
    assert [n for _, n in sizes] == [1]
    assert feed.table.runs()[0] == first[0] and len(feed.table.runs()) == 2
    feed.put((1, 6, 1, "c1"), (99, None, 0, "new"), (None, 7, 0, "none2"))  # a tie in time, a new key, the null key
    feed.run()
    want = {k: f"a{k}" for k in range(40)} | {1: "c1", 99: "new", None: "none2"}
    assert feed.latest() == want
    assert feed.table.runs()[0] == first[0]


def test_batch_repeated_after_a_failure_counts_once(spark, monkeypatch):
    feed = Feed(spark)
    feed.put((1, 1, 0, "a"), (2, 1, 0, "a"))
    feed.run()
    append = RunTable.append

    def lost(self, rows, source, number):
        append(self, rows, source, number)
        raise RuntimeError("driver lost after the batch was written")

    monkeypatch.setattr(RunTable, "append", lost)
    feed.put((1, 2, 0, "b"), (3, 2, 0, "b"))
    with pytest.raises(Exception, match="driver lost"):
        feed.run()
    monkeypatch.setattr(RunTable, "append", append)
    held = feed.table.runs()
    feed.run()
    assert feed.table.runs() == held  # the batch is there already
    feed.put((1, 1, 5, "older"), (2, 3, 0, "c"))  # the state knows the repeated batch
    feed.run()
    assert feed.latest() == {1: "b", 2: "c", 3: "b"}


def test_runs_stay_few_and_sum_up(spark):
    table = RunTable(spark, f"{scratch_dir(spark, 't-runs')}/sums", spark.createDataFrame([], "k long, n long").schema,
                     lambda rows: rows.groupBy("k").agg(F.sum("n").alias("n")))
    assert table.read().collect() == []
    most = 0
    for i in range(20):
        assert table.append(spark.range(4).select((F.col("id") + 4 * i).alias("k"), F.lit(1).cast("long").alias("n")), "s", i)
        most = max(most, len(table.runs()))
    assert not table.append(spark.createDataFrame([(0, 100)], "k long, n long"), "s", 19)
    assert table.append(spark.createDataFrame([(0, 100)], "k long, n long"), "other", 0)
    assert table.append(spark.createDataFrame([], "k long, n long"), "s", 20)  # an empty batch leaves no run
    assert most <= 5
    got = {r.k: r.n for r in table.read().collect()}
    assert got == {k: 101 if k == 0 else 1 for k in range(80)}
    written = [n for n in table.files.names(table.path) if n.startswith("run-")]
    assert set(written) == set(table.runs())
