"""Shared scratch space and stored tables.

Paths live under the cluster's shared ``spark.checkpoint.dir``, read from the
session; only a one-process local session may run without it. A stored table is
a partitioned Parquet directory written with Spark's dynamic partition overwrite,
plus one small progress file.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources.files import Files

NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def shared_root(spark: SparkSession) -> str:
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="tidemark-")
        spark.conf.set("spark.checkpoint.dir", root)
    spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_dir(spark: SparkSession, label: str = "run") -> str:
    """A fresh, unique directory path under the shared root (not created)."""
    return f"{shared_root(spark)}/tidemark/{label}-{uuid.uuid4().hex[:12]}"


def spread_partitions(df: DataFrame, partition_by: tuple[str, ...], files_per_partition: int,
                      num_tasks: int | None = None) -> DataFrame:
    """Ranges of output partitions, a range a task, each partition spread over about
    ``files_per_partition`` tasks.

    Neighbouring partitions come from one task: it makes their common folders once, and
    its commit moves whole folders of them. The task count is explicit (default: the
    cluster's parallelism) because AQE would otherwise coalesce a small shuffle into one
    task that writes every partition directory alone.
    """
    n = num_tasks or df.sparkSession.sparkContext.defaultParallelism
    salt = [F.pmod(F.xxhash64(*df.columns), F.lit(files_per_partition))] if files_per_partition > 1 else []
    return df.repartitionByRange(n, *[F.col(c) for c in partition_by], *salt)


@contextmanager
def tiny_files(spark: SparkSession) -> Iterator[None]:
    """For the session settings of listings and scans of very many tiny files: a listing in
    some tasks a core, from few folders on, not one a path; a read task takes more of them."""
    wanted = {
        "spark.sql.sources.parallelPartitionDiscovery.threshold": "4",
        "spark.sql.sources.parallelPartitionDiscovery.parallelism": str(4 * spark.sparkContext.defaultParallelism),
        "spark.sql.files.openCostInBytes": "262144",
    }
    before = {k: spark.conf.get(k) for k in wanted}
    try:
        for k, v in wanted.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def materialize(df: DataFrame, label: str = "table") -> DataFrame:
    """Write ``df`` as Parquet under the shared root and read it back.

    Cuts the lineage (a lost executor recomputes from the written files, not
    from the sources) and lets a table that several plans read, such as the
    target of an incremental run, be computed once.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def materialize_with(df: DataFrame, label: str, *measures: Column) -> tuple[DataFrame, dict]:
    """``materialize``, and aggregates of the rows that the same pass has observed."""
    seen = Observation()
    written = materialize(df.observe(seen, *measures), label)
    return written, seen.get


class StoredTable:
    """A Parquet table partitioned by one column, rewritten partition by partition.

    ``replace_partitions`` writes the partitions that its rows hold with dynamic
    partition overwrite (Spark stages them and swaps them in when the job
    commits, so the rows may come from the table itself), removes the partitions
    that a merge has emptied, and only then records the progress: the high
    watermark of the change times that the table holds. A run that dies in between
    leaves the old watermark, so the next run reads the same changes again and
    its merge, which replaces by key, ends in the same table.

    The progress is one small file, replaced by a rename. A missing file means
    that no run has finished; a file that cannot be read or parsed is an error.
    Tables without a natural partition use one constant partition. ``constants`` are
    columns with one value in the whole table: they are added after the shuffle.
    """

    MARK = "high_watermark="

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, partition_col: str,
                 constants: dict[str, Column] | None = None):
        self.spark = spark
        self.constants = constants or {}
        self.path = path.rstrip("/")
        self.schema = schema
        self.partition_col = partition_col
        self.files = Files(spark)

    def _progress(self) -> str:
        head, _, name = self.path.rpartition("/")
        return f"{head}/_progress/{name}"

    def high_watermark(self) -> str | None:
        """Newest change time of the table as text, without a scan."""
        text = self.files.read_text(self._progress())
        if text is None:
            return None
        if not text.startswith(self.MARK):
            raise ValueError(f"damaged progress file {self._progress()}")
        return text[len(self.MARK):].strip() or None

    def read(self) -> DataFrame | None:
        """The table, or None before its first rows."""
        if not any(n.startswith(f"{self.partition_col}=") for n in self.files.names(self.path)):
            return None
        return self.spark.read.schema(self.schema).parquet(self.path)

    def partitions(self) -> list[str | None]:
        mark = f"{self.partition_col}="
        found = [n[len(mark):] for n in self.files.names(self.path) if n.startswith(mark)]
        return [None if v == NULL_PARTITION else v for v in found]

    def replace_partitions(self, rows: DataFrame, emptied: Sequence[str | None] = (),
                           high_watermark: str | None = None, covered: Iterable[str | None] = ()) -> None:
        """Replace the partitions of ``rows``, remove ``emptied`` and those of ``covered``
        that have no rows (``rows`` is all that they hold now), record progress.

        ``rebalance`` clusters the rows by partition before they are written, so
        a partition gets about one file per advisory size, however many tasks
        held its rows, and a partition with a third of all rows is split. The partitions that have rows
        are observed after it, where a task holds few of them.
        """
        p, seen = F.col(self.partition_col), Observation()
        names = self.schema.fieldNames()
        rows = rows.select(*(c for c in names if c not in self.constants)).hint("rebalance", self.partition_col)
        if covered:
            rows = rows.observe(seen, F.collect_set(p).alias("present"), F.count_if(p.isNull()).alias("nulls"))
        (
            rows.select(*(self.constants[c].alias(c) if c in self.constants else F.col(c) for c in names))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .option("compression", "zstd")
            .partitionBy(self.partition_col)
            .parquet(self.path)
        )
        if covered:
            there = set(seen.get["present"]) | ({None} if seen.get["nulls"] else set())
            emptied = [*emptied, *(set(covered) - there)]
        for value in emptied:
            self.remove(value)
        known = [w for w in (self.high_watermark(), high_watermark) if w is not None]
        self.files.write_text(self._progress(), self.MARK + max(known, default=""))

    def remove(self, value: str | None) -> None:
        """Remove one partition."""
        self.files.delete(f"{self.path}/{self.partition_col}={NULL_PARTITION if value is None else value}")

    def forget(self) -> None:
        """Drop the progress, so that the next run loads everything."""
        self.files.delete(self._progress())
