"""Streaming landing: hours as batch landing writes them, once over failures and restarts."""

from __future__ import annotations

import pytest
from pyspark.errors import StreamingQueryException

from tidemark.sources import bronze as B
from tidemark.sources.schemas import bronze_schema
from tidemark.streaming.landing import BatchLander, change_files, stream_land

PAYLOAD = bronze_schema("offices", with_partitions=False)


def changes(spark, n, hours, first=0):
    rows = [("U" if i % 3 else "I", f"2024-03-01 {3 + i % hours:02d}:00:00.{i:06d}", str(i), *["x"] * (len(PAYLOAD) - 3)) for i in range(first, first + n)]
    return spark.createDataFrame(rows + rows[:2], PAYLOAD)  # equal changes stay as often as they came


def test_stream_lands_each_batch_once(spark, tmp_path, monkeypatch):
    root, inbox, checkpoint = (f"{tmp_path}/{x}" for x in ("bronze", "inbox", "checkpoint"))
    changes(spark, 12, 4).coalesce(1).write.mode("append").parquet(inbox)
    changes(spark, 6, 3, 100).coalesce(1).write.mode("append").parquet(inbox)

    def run():
        q = stream_land(spark, change_files(spark, inbox, "offices", 1), root, "offices", checkpoint)
        q.awaitTermination()

    whole, calls = BatchLander.publish, []

    def dies(self, staged, final):
        calls.append(final)
        if len(calls) == 3:  # two files of the first batch are in place
            raise OSError("lost")
        whole(self, staged, final)

    monkeypatch.setattr(BatchLander, "publish", dies)
    with pytest.raises(StreamingQueryException):
        run()
    monkeypatch.setattr(BatchLander, "publish", whole)
    run()
    run()  # nothing new
    wanted = B.with_partition_values(spark.read.schema(PAYLOAD).parquet(inbox))
    got = B.scan_bronze(spark, root, "offices")
    assert sorted(got.collect()) == sorted(wanted.select(*got.columns).collect()) and got.count() == 22

    # A batch that is done and comes again, as after a lost commit, adds nothing.
    lander = BatchLander(spark, root, "offices", checkpoint)
    lander.land(changes(spark, 6, 3, 100), 1)
    assert B.scan_bronze(spark, root, "offices").count() == 22
    # Another stream into the same table does not meet the first one's files.
    BatchLander(spark, root, "offices", f"{tmp_path}/other").land(changes(spark, 3, 3, 200), 0)
    assert B.scan_bronze(spark, root, "offices").count() == 27
