"""Report of landed files whose columns differ from the declared schema.

Scans read by the declared schema, so a column that a source renames, drops or adds ends as
nulls or unseen, without an error. ``schema_drift`` reads the footers of the landed files,
on the executors and no rows, and gives a row per table and differing column:

    missing   a declared column that files lack (it reads as nulls)
    unknown   a column that files hold and the schema does not (it is not read)
    type      a column of another type than declared

with the declared and the found type, how many files and rows it concerns, and the first
file's path. No differences: no rows. Names are compared as they are written; a file without
rows counts as a file. A file that is no Parquet fails the report, as it fails the scans.

Footers are read with pyarrow's file systems where these know the path's scheme; elsewhere
Spark hands over the files' bytes.
"""

from __future__ import annotations

import functools
import io
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.bronze import hours_glob, table_root
from tidemark.sources.files import Files
from tidemark.sources.schemas import bronze_schema

DIRECT = ("file", "hdfs", "s3", "s3a", "gs")
FOUND = "table string, column string, declared string, found string, fault string, path string, n long"
REPORT = ("table", "column", "declared", "found", "fault", "files", "rows", "first_file")


def _source(path: str, content: bytes | None):
    """What pyarrow reads a footer from."""
    from pyarrow import fs

    if content is not None:
        return io.BytesIO(content)
    if path.startswith("file:"):
        return fs.LocalFileSystem().open_input_file("/" + path[len("file:"):].lstrip("/"))
    where, inner = fs.FileSystem.from_uri(path.replace("s3a:", "s3:", 1))
    return where.open_input_file(inner)


def differences(files: Iterator[pd.DataFrame], table: str, declared: dict[str, str]) -> Iterator[pd.DataFrame]:
    """Per file, its columns that differ from ``declared`` (name to type)."""
    import pyarrow.parquet as pq
    from pyspark.sql.pandas.types import from_arrow_type

    columns = [f.split()[0] for f in FOUND.split(", ")]
    for batch in files:
        out = []
        contents = batch["content"] if "content" in batch else [None] * len(batch)
        for path, content in zip(batch["path"], contents, strict=True):
            with _source(path, content) as f:
                footer = pq.ParquetFile(f)
                n, schema = footer.metadata.num_rows, footer.schema_arrow
            found = {c.name: from_arrow_type(c.type, prefer_timestamp_ntz=True).simpleString() for c in schema}
            for name in declared.keys() | found.keys():
                want, has = declared.get(name), found.get(name)
                if want != has:
                    fault = "missing" if has is None else "unknown" if want is None else "type"
                    out.append((table, name, want, has, fault, path, n))
        yield pd.DataFrame(out, columns=columns)


def schema_drift(spark: SparkSession, root: str, tables: Sequence[str], since: str | None = None, layout: str = "kv") -> DataFrame:
    """The report over landed ``tables``; with ``since`` (change time as text) over the hours
    from there on and the full-load partition. Tables that have not landed are left out."""
    reports = [spark.createDataFrame([], FOUND)]
    files = Files(spark)
    tasks = 4 * spark.sparkContext.defaultParallelism
    for table in tables:
        base = table_root(root, table)
        if not files.exists(base):
            continue
        direct = files.qualified(base).partition(":")[0] in DIRECT
        reader = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
        reader = reader.option("basePath", base) if layout == "kv" else reader.option("recursiveFileLookup", "true")
        try:
            landed = reader.load(hours_glob(spark, base, since, layout))
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            continue
        # Paths alone (no bytes are read for them), spread evenly however large their files are.
        landed = landed.select("path").repartition(tasks) if direct else landed.select("path", "content")
        declared = {f.name: f.dataType.simpleString() for f in bronze_schema(table, with_partitions=False)}
        reports.append(landed.mapInPandas(functools.partial(differences, table=table, declared=declared), FOUND))
    return functools.reduce(DataFrame.unionByName, reports).groupBy("table", "column", "declared", "found", "fault").agg(
        F.count(F.lit(1)).alias("files"), F.sum("n").alias("rows"), F.min("path").alias("first_file")).select(*REPORT)
