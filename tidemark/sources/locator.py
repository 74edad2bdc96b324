"""Where the keys of a partitioned table are: a hash-bucketed side table.

A merge needs the partitions that hold its batch's keys. ``KeyLocator`` keeps one narrow
row per key and partition, in directories by a hash of the key, so a batch reads the
buckets of its own keys instead of the key columns of the whole table.

The side table only says where a key *may* be. A merge adds its keys' new partitions
before it changes the table, so a run that dies leaves too many places, never too few;
a place that a key has left costs the merge one more partition to look at. Rows are
appended as generations; after ``GENERATIONS`` of them all are written anew as one. A
locator that does not exist yet is built from the table once.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources.files import Files

GENERATIONS = 16
BUCKETS = 64
PLACE, BUCKET, GENERATION = "_place", "_bucket", "_generation"


class KeyLocator:
    def __init__(self, spark: SparkSession, path: str, table: T.StructType, keys: Sequence[str], partition_col: str,
                 buckets: int = BUCKETS, repeated: bool = False):
        """``repeated``: rows given may repeat a key and place. ``buckets``: choose so that a bucket of keys is some files' worth; it must not
        change while the locator exists."""
        self.spark, self.path, self.keys, self.buckets = spark, path.rstrip("/"), list(keys), buckets
        self.partition_col, self.repeated = partition_col, repeated
        self.files = Files(spark)
        self.schema = T.StructType([T.StructField(k, table[k].dataType) for k in keys] + [
            T.StructField(PLACE, T.StringType()), T.StructField(GENERATION, T.StringType()), T.StructField(BUCKET, T.IntegerType())])

    def _generations(self) -> list[str]:
        """Generations that are written whole."""
        return [n for n in self.files.names(self.path) if self.files.exists(f"{self.path}/{n}/_SUCCESS")]

    def exists(self) -> bool:
        return bool(self._generations())

    def forget(self) -> None:
        self.files.delete(self.path)

    def _read(self) -> DataFrame | None:
        found = self._generations()
        if not found:
            return None
        return self.spark.read.schema(self.schema).option("basePath", self.path).parquet(*(f"{self.path}/{n}" for n in found))

    def _keyed(self, rows: DataFrame) -> DataFrame:
        bucket = F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")
        return rows.select(*self.keys, F.col(self.partition_col).cast("string").alias(PLACE), bucket.alias(BUCKET))

    def near(self, rows: DataFrame) -> DataFrame | None:
        """The entries of the buckets that the keys of ``rows`` fall into."""
        held = self._read()
        if held is None:
            return None
        wanted = [r[0] for r in self._keyed(rows).select(BUCKET).distinct().collect()]  # at most ``buckets``
        return held.where(F.col(BUCKET).isin(wanted))

    def places(self, rows: DataFrame) -> set[str | None]:
        """Partitions that may hold keys of ``rows``; never more than the table has."""
        held = self.near(rows)
        if held is None:
            return set()
        found = held.join(rows.select(*self.keys), self.keys, "left_semi").select(PLACE).distinct()
        return {r[0] for r in found.collect()}

    def add(self, rows: DataFrame) -> None:
        """Record the partitions of ``rows`` beside those known. Call it before the rows
        are written to the table."""
        new, held = self._keyed(rows), self.near(rows)
        if self.repeated:
            new = new.distinct()
        if held is not None:
            same = [F.col(f"n.{k}") == F.col(f"h.{k}") for k in self.keys] + [F.col(f"n.{PLACE}").eqNullSafe(F.col(f"h.{PLACE}"))]
            new = new.alias("n").join(held.drop(BUCKET, GENERATION).alias("h"), same, "left_anti")
        name = self._write(new)
        if held is not None and not any(n.startswith(f"{BUCKET}=") for n in self.files.names(f"{self.path}/{name}")):
            self.files.delete(f"{self.path}/{name}")
            return
        if len(self._generations()) >= GENERATIONS:
            self.compact()

    def _write(self, rows: DataFrame) -> str:
        name = f"{GENERATION}={uuid.uuid4().hex}"
        rows.hint("rebalance", BUCKET).write.option("compression", "zstd").partitionBy(BUCKET).parquet(f"{self.path}/{name}")
        return name

    def compact(self) -> None:
        """All generations as one; the old ones go once it is written."""
        old = self._generations()
        self._write(self._read().drop(GENERATION).distinct())
        for n in old:
            self.files.delete(f"{self.path}/{n}")
