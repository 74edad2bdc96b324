"""Structured Streaming: micro-batch silver loads with state kept in the table.

A file stream over the landed bronze hours feeds ``foreachBatch``; each batch
is deduped per key and merged into the silver table with the "only if newer"
guard over time, operation and payload, the order in which batch runs choose
too, so a batch replayed after a failure (the checkpoint commits after the sink)
cannot move a key back to an older image. These loads need no
streaming state store: the table itself is the state, and it grows
with the number of keys, not with the stream.

``stream_latest_stateful`` is the form for many keys that are spread over all partitions:
the newest row per key is kept in Spark's state store and only keys that have changed reach
the sink, so a batch costs what it changes, not what the table holds.

``trigger(availableNow=True)`` drains what has landed and stops, which is the
15-minute scheduled run; ``processingTime="15 minutes"`` keeps it running.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.cdc import latest_per_key
from tidemark.operators.merge import newer_source, upsert_partitions
from tidemark.plans.jobs import Lakehouse
from tidemark.sources import bronze as B
from tidemark.sources.feeds import read_table
from tidemark.sources.runs import RunTable
from tidemark.sources.schemas import bronze_schema
from tidemark.sources.storage import StoredTable, materialize, scratch_dir, tiny_files

KEY_BUCKETS = 16


def stream_silver(house: Lakehouse, table: str, checkpoint: str,
                  files_per_trigger: int | None = None, available_now: bool = True) -> StreamingQuery:
    """Stream landed changes of ``table`` into its silver table.

    A batch rewrites only the partitions it touches. Order lines take the order
    dates that the silver orders hold when the batch runs.
    """
    spark = house.spark
    reader = spark.readStream.schema(bronze_schema(table, with_partitions=False)).option("recursiveFileLookup", "true")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    source = B.hours_of_paths(reader.parquet(B.table_root(house.bronze_root, table)), house.layout)

    def merge_batch(changes: DataFrame, epoch_id: int) -> None:
        house.merge(table, house.batch(table, changes), newer_only=True)

    w = source.writeStream.foreachBatch(merge_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="15 minutes")
    return w.start()


def stream_latest(spark: SparkSession, path: str, schema: T.StructType, keys: list[str],
                  order: list[str], store: StoredTable, checkpoint: str,
                  files_per_trigger: int | None = None) -> StreamingQuery:
    """Latest row per key over an append-only file stream (newest by ``order``).
    The table is partitioned by a hash of the key, so a key never moves."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    source = reader.parquet(path)

    def merge_batch(batch: DataFrame, epoch_id: int) -> None:
        rows = latest_per_key(batch, keys, ts=order[0], tiebreak=order[1:], op_col=None)
        bucket = F.pmod(F.xxhash64(*keys), F.lit(KEY_BUCKETS)).cast("string")
        rows = materialize(rows.withColumn(store.partition_col, bucket), "stream-batch")
        target = store.read()
        if target is not None:
            rows = materialize(newer_source(target, rows, keys, order), "stream-newer")
        if rows.isEmpty():
            return
        merged, _ = upsert_partitions(target, rows, keys, store.partition_col, movable=False)
        store.replace_partitions(merged)

    return (source.writeStream.foreachBatch(merge_batch)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def latest_table(spark: SparkSession, path: str, schema: T.StructType, keys: list[str], order: list[str]) -> RunTable:
    """A table of changed keys per batch, read as the newest row per key."""
    return RunTable(spark, path, schema, lambda rows: latest_per_key(rows, keys, ts=order[0], tiebreak=order[1:], op_col=None))


def changed_latest(source: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Streaming: per batch, the new latest row of every key that has a newer one by then.

    The state is the newest row per key (``max_by``, combined before the shuffle) and the
    time of the batch that brought it. A key whose newest row is not of this batch has not
    changed: an older row, or the same row again, sends nothing on. ``order`` must tell any
    two different rows of a key apart; nulls are the oldest. Null keys are one key.
    """
    cols = source.columns
    seen = source.withColumn("_seen", F.current_timestamp())  # one value a batch, the same when it is repeated
    newest = F.struct(*order, -F.unix_micros("_seen"))  # of equal rows the one that came first
    best = seen.groupBy(*keys).agg(F.max_by(F.struct(*cols, "_seen"), newest).alias("_row"))
    return best.where(F.col("_row._seen") == F.current_timestamp()).select(*(F.col("_row")[c].alias(c) for c in cols))


def stream_latest_stateful(spark: SparkSession, path: str, schema: T.StructType, keys: list[str],
                           order: list[str], table: RunTable, checkpoint: str,
                           files_per_trigger: int | None = None) -> StreamingQuery:
    """Latest row per key over an append-only file stream, state in the state store.

    The state holds one row per key for good (a latest row does not expire), spread over the
    shuffle partitions that the session has when the stream starts first; a session
    without a choice of its own gets the store that keeps it on disk (RocksDB).
    """
    if spark.conf.get("spark.sql.streaming.stateStore.providerClass").endswith("HDFSBackedStateStoreProvider"):
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    changed = changed_latest(reader.parquet(path), keys, order)

    def sink(batch: DataFrame, epoch_id: int) -> None:
        if not table.append(batch, checkpoint, epoch_id):
            # Written by the attempt before; the state of this batch still has to be built.
            batch.write.format("noop").mode("overwrite").save()

    return (changed.writeStream.outputMode("update").foreachBatch(sink)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


# --- catalogue entries -----------------------------------------------------------

def _streamed(spark: SparkSession, d: str, tables: tuple[str, ...]) -> Lakehouse:
    # Month partitions: the driver's orders are a few per hour over seven years.
    house = Lakehouse(spark, scratch_dir(spark, "stream"), partition_grain="month")
    house.land(d, tables)
    with tiny_files(spark):
        for t in tables:
            # Thousands of tiny hour files: a batch takes a third of them.
            n = B.file_count(spark, house.bronze_root, t)
            stream_silver(house, t, f"{house.root}/_checkpoint/{t}", files_per_trigger=n // 3 + 1).awaitTermination()
    return house


def q_stream_silver_orders(spark: SparkSession, d: str) -> DataFrame:
    return _streamed(spark, d, ("orders",)).silver_table("orders")


def q_stream_silver_orderdetails(spark: SparkSession, d: str) -> DataFrame:
    return _streamed(spark, d, ("orders", "orderdetails")).silver_table("orderdetails")


def _landed_events(spark: SparkSession, d: str, root: str) -> tuple[str, T.StructType]:
    """The event table as a stream of files: hours of event time, rebalanced, so that a
    busy hour is several files."""
    events = read_table(spark, d, "events")
    landed = f"{root}/events"
    (events.withColumn("_hour", F.date_trunc("hour", "ts")).hint("rebalance", "_hour").drop("_hour")
     .write.option("maxRecordsPerFile", 200_000).parquet(landed))
    return landed, events.schema


def q_stream_latest_by_key(spark: SparkSession, d: str) -> DataFrame:
    root = scratch_dir(spark, "stream")
    landed, fields = _landed_events(spark, d, root)
    schema = T.StructType([*fields, T.StructField("bucket", T.StringType())])
    store = StoredTable(spark, f"{root}/state", schema, "bucket")
    q = stream_latest(spark, landed, fields, ["user_id"], ["ts", "event_id"], store,
                      f"{root}/_checkpoint/events", files_per_trigger=4)
    q.awaitTermination()
    return store.read().drop("bucket")


def q_stream_latest_stateful(spark: SparkSession, d: str) -> DataFrame:
    root = scratch_dir(spark, "stream")
    landed, fields = _landed_events(spark, d, root)
    table = latest_table(spark, f"{root}/latest", fields, ["user_id"], ["ts", "event_id"])
    stream_latest_stateful(spark, landed, fields, ["user_id"], ["ts", "event_id"], table,
                           f"{root}/_checkpoint/latest", files_per_trigger=4).awaitTermination()
    return table.read()


def _register() -> None:
    from tidemark.plans.catalog import QUERIES
    QUERIES["stream_silver_orders"] = q_stream_silver_orders
    QUERIES["stream_silver_orderdetails"] = q_stream_silver_orderdetails
    QUERIES["stream_latest_by_key"] = q_stream_latest_by_key
    QUERIES["stream_latest_stateful"] = q_stream_latest_stateful


_register()
