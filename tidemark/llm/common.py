"""Helpers shared by the operators: scratch tables in the shared folder, files
in any Hadoop-like store, the task's partition number, tiny column helpers."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


BATCH_ROWS = 1000


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Only a one-process ``local[...]`` session may run without that setting;
    it gets a temporary folder. On a cluster a missing setting is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="tidemark-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def bound_batches(spark: SparkSession) -> SparkSession:
    """Texts are long: let a Python worker get at most ``BATCH_ROWS`` of them at a time
    (a smaller setting of the session stays)."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key, "10000"))
    if now <= 0 or now > BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))
    return spark


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing has used yet."""
    return f"{shared_dir(spark)}/llm-{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: cuts lineage, and
    joins of written tables let AQE split hot keys on either side."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(as_nullable(df.schema)).parquet(path)


def as_nullable(schema: StructType) -> StructType:
    return StructType([type(f)(f.name, f.dataType, True) for f in schema.fields])


def text_or_empty(name: str = "text"):
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def partition_id() -> int:
    ctx = TaskContext.get()
    return ctx.partitionId() if ctx else 0


def write_atomically(uri: str, write) -> None:
    """Call ``write(stream)`` on a file of this attempt, then move it to ``uri``.

    A retried or speculative attempt writes the same bytes, so the last move wins.
    """
    store, path = fs.FileSystem.from_uri(uri)
    store.create_dir(path.rsplit("/", 1)[0], recursive=True)
    part = f"{path}.{uuid.uuid4().hex}.tmp"
    with store.open_output_stream(part) as out:
        write(out)
    store.move(part, path)


def open_uri(uri: str):
    """A random-access handle."""
    store, path = fs.FileSystem.from_uri(uri)
    return store.open_input_file(path)


def rows_of(batch: pa.RecordBatch, size: int = 256) -> Iterator[tuple]:
    """A batch's rows as tuples, of which only ``size`` are Python objects at a time."""
    for at in range(0, batch.num_rows, size):
        yield from zip(*(c.to_pylist() for c in batch.slice(at, size).columns), strict=True)


def batches(rows: Iterator[dict] | Iterator[tuple], schema: pa.Schema, size: int = 4096) -> Iterator[pa.RecordBatch]:
    """Row tuples to record batches of at most ``size`` rows."""
    buffer: list = []
    for row in rows:
        buffer.append(row)
        if len(buffer) == size:
            yield to_batch(buffer, schema)
            buffer = []
    if buffer:
        yield to_batch(buffer, schema)


def to_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
