"""Tables that grow by numbered batches and are combined when they are read.

A streaming sink that merges each batch into a partitioned table rewrites every partition
that holds one of the batch's keys: with hashed keys, all of them. A ``RunTable`` writes the
batch alone, as a *run*, and ``combine`` (the newest row per key, or sums per key) joins the
runs when they are read. Whenever the newest runs together reach half of the run before
them, they are combined with it into one, so there are only about log2(rows / batch) runs
and a row is rewritten about as often; big old runs stay as they are.

The list of the runs and the number of the newest batch of each source are one small file,
replaced by a rename after a batch is written. A batch whose number is there already is
left out, so a stream that repeats a batch after a failure counts it once. Runs that have
been combined go one batch later, so that a reader of the list before still finds them; what
a lost writer left goes then too. A table has one writer at a time.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark.sources.files import Files

Combine = Callable[[DataFrame], DataFrame]


class RunTable:
    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, combine: Combine):
        """``combine``: rows of several runs to rows of one; it must give the same in
        whatever order and grouping runs are combined."""
        self.spark, self.path, self.schema, self.combine = spark, path.rstrip("/"), schema, combine
        self.files = Files(spark)

    def _list(self) -> dict:
        text = self.files.read_text(f"{self.path}/_runs.json")
        return {"runs": [], "last": {}} if text is None else json.loads(text)

    def _open(self, names: list[str]) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(*(f"{self.path}/{n}" for n in names))

    def _write(self, rows: DataFrame) -> tuple[str, int]:
        name = f"run-{uuid.uuid4().hex}"
        rows.select(*self.schema.fieldNames()).write.parquet(f"{self.path}/{name}")
        return name, self._open([name]).count()

    def runs(self) -> list[str]:
        """Names of the current runs, oldest first."""
        return [name for name, _ in self._list()["runs"]]

    def holds(self, source: str, number: int) -> bool:
        return self._list()["last"].get(source, -1) >= number

    def read(self) -> DataFrame:
        names = self.runs()
        if not names:
            return self.spark.createDataFrame([], self.schema)
        rows = self._open(names)
        return rows if len(names) == 1 else self.combine(rows)

    def append(self, rows: DataFrame, source: str, number: int) -> bool:
        """Add batch ``number`` of ``source``, whose rows are combined among themselves.
        False if it is there already. Numbers of a source rise."""
        held = self._list()
        if held["last"].get(source, -1) >= number:
            return False
        runs = held["runs"]
        known = {name for name, _ in runs}
        name, size = self._write(rows)
        new = [*runs, [name, size]] if size else runs
        start, total = len(new) - 1, size
        while start > 0 and new[start - 1][1] <= 2 * total:
            start -= 1
            total += new[start][1]
        if 0 <= start < len(new) - 1:
            new = [*new[:start], list(self._write(self.combine(self._open([n for n, _ in new[start:]]))))]
        self.files.write_text(f"{self.path}/_runs.json", json.dumps({"runs": new, "last": held["last"] | {source: number}}))
        for n in self.files.names(self.path):
            if n.startswith("run-") and n not in known and n not in {r for r, _ in new}:
                self.files.delete(f"{self.path}/{n}")
        return True
