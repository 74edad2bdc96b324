"""Bronze zone: hourly landing, declared-schema scans, inventory, backfill.

Layout of a landed table (written by ``land_hourly``)::

    <root>/<table>/year_stream=YYYY/month_stream=MM/day_stream=DD/hour_stream=HH/*.parquet

Hour directories use the UTC-3 wall clock of the change. Full-load files may
also be dropped directly under ``<root>/<table>/``; ``backfill`` files them
into the fixed partition once. A reader that only knows the plain
``YYYY/MM/DD/HH`` directory layout can use ``scan_bronze(..., layout="slash")``,
which takes the partition values from the file path.
"""

from __future__ import annotations

import datetime as dt
import re

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.config import BACKFILL_PARTITION, LOCAL_OFFSET_HOURS, PARTITION_COLS
from tidemark.functions.time import parse_extract_at, partition_values, shift_local
from tidemark.sources.files import Files
from tidemark.sources.schemas import bronze_schema, create_table_ddl
from tidemark.sources.storage import NULL_PARTITION, spread_partitions

LAYOUTS = {"kv": tuple(f"{c}=" for c in PARTITION_COLS), "slash": ("", "", "", "")}
SLASH_RE = r"/(\d{4})/(\d{2})/(\d{2})/(\d{2})/[^/]*$"
PATH_RE = {"kv": "".join(f"/{c}=([^/]*)" for c in PARTITION_COLS) + "/[^/]*$", "slash": SLASH_RE}
#: Shuffle partitions of a landing before AQE packs them: so many that they need splitting only
#: from some 10 GB on (a split writes each of its hours again), few enough for writers that sort nothing.
WRITE_PARTITIONS = 200
MANIFEST_SCHEMA = T.StructType([T.StructField("file_name", T.StringType(), False)])


def table_root(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/{table}"


def with_partition_values(df: DataFrame, ts: Column | None = None) -> DataFrame:
    """Add the four landing partition columns from the change time."""
    ts = parse_extract_at("extract_at") if ts is None else ts
    return df.drop(*PARTITION_COLS).select("*", *partition_values(ts))


def land_hourly(df: DataFrame, root: str, table: str, num_tasks: int | None = None,
                files_per_hour: int = 2, replace: bool = False) -> None:
    """Write change rows into hour partitions (Parquet, gzip like the landing job).

    ``replace=False`` appends. ``replace=True`` takes ``df`` as the complete content
    of the hours it holds and replaces them, so landing the same hours again
    changes nothing; the fixed full-load partition, which full loads share, only
    gains the rows that it does not hold yet.

    Default: ``REBALANCE`` on the day of the change. AQE then sizes writer tasks
    from the real shuffle statistics: a day too large for one task is split over as
    many as its size needs, small days are packed together. A day's hours mostly
    come from one task, whose commit then moves the day at once, and an hour is one
    file as long as its day fits a task. ``num_tasks`` instead forces that many
    writers of a range of hours each, with an hour salted over about ``files_per_hour`` of them.
    ``maxRecordsPerFile`` caps file size.
    """
    schema = bronze_schema(table)
    rows = with_partition_values(df).select(*[f.name for f in schema.fields])
    if replace:
        fixed = in_partition(BACKFILL_PARTITION)
        if Files(df.sparkSession).exists(table_root(root, table)):
            append_missing(rows.where(fixed), root, table)
            rows = rows.where(~fixed)
        else:  # nothing to replace: no staging, no swap of every hour (rows without a time have no hour)
            replace, rows = False, rows.where(fixed.isNotNull())
    if num_tasks:
        rows = spread_partitions(rows, PARTITION_COLS, files_per_hour, num_tasks)
    else:
        # The hours are worked out behind the shuffle, which carries the payload alone.
        day = shift_local(parse_extract_at("extract_at")).cast("date").alias("_day")
        payload = bronze_schema(table, with_partitions=False).fieldNames()
        rows = with_partition_values(rows.select(*payload, day).hint("rebalance", WRITE_PARTITIONS, "_day").drop("_day"))
    (
        rows.write.mode("overwrite" if replace else "append")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", 5_000_000)
        .option("compression", "gzip")
        .partitionBy(*PARTITION_COLS)
        .parquet(table_root(root, table))
    )


def in_partition(partition: tuple[str, str, str, str]) -> Column:
    cond = F.lit(True)
    for c, v in zip(PARTITION_COLS, partition):
        cond = cond & (F.col(c) == v)
    return cond


def append_missing(rows: DataFrame, root: str, table: str,
                   partition: tuple[str, str, str, str] = BACKFILL_PARTITION) -> None:
    """Append the rows that their partition does not hold yet (a rerun adds none).
    Only that partition's own directory is listed and read."""
    spark = rows.sparkSession
    base = table_root(root, table)
    path = f"{base}/" + "/".join(f"{c}={v}" for c, v in zip(PARTITION_COLS, partition))
    fresh = rows
    if Files(spark).exists(path):
        held = spark.read.schema(bronze_schema(table)).option("basePath", base).parquet(path)
        fresh = rows.exceptAll(held.select(*rows.columns))
    # Reliable checkpoint (shared folder): what is missing is fixed before the append. All
    # rows are of one partition, so they go straight into its directory: a write that finds
    # the partitions itself would sort every task's rows by them first.
    fresh = fresh.checkpoint(eager=True)
    if not fresh.isEmpty():
        fresh.drop(*PARTITION_COLS).write.mode("append").option("compression", "gzip").parquet(path)


def first_hour(since: str) -> tuple[str, str, str, str]:
    """Landing partition of the first hour that can hold a change at or after the
    change-time text ``since``: landing hours are UTC-3 and derived from the change
    time; one hour more allows for clock skew of the landing job."""
    at = dt.datetime.fromisoformat(since) - dt.timedelta(hours=LOCAL_OFFSET_HOURS + 1)
    return at.strftime("%Y"), at.strftime("%m"), at.strftime("%d"), at.strftime("%H")


def hours_glob(spark: SparkSession, base: str, since: str | None, layout: str) -> str:
    """One glob over the hours at or after ``since`` and the full-load partition,
    whose rows may be of any time. Older hours are not listed at all. Whole days are
    named by their directory: the listing, a job over the paths of the glob, has a path
    a day then, not one an hour."""
    py, pm, pd, ph = LAYOUTS[layout]
    hour = lambda y="*", m="*", d="*", h=None: f"{py}{y}/{pm}{m}/{pd}{d}" + ("" if h is None else f"/{ph}{h}")
    if since is None:
        return f"{base}/{hour()}"
    y, m, d, h = first_hour(since)
    years = [n[len(py):] for n in Files(spark).names(base) if re.fullmatch(re.escape(py) + r"\d{4}", n)]
    wanted = [hour(*BACKFILL_PARTITION)] + [hour(x) for x in years if x > y]
    if y in years:
        wanted += [hour(y, f"{x:02d}") for x in range(int(m) + 1, 13)]
        wanted += [hour(y, m, f"{x:02d}") for x in range(int(d) + 1, 32)]
        wanted += [hour(y, m, d, f"{x:02d}") for x in range(int(h), 24)]
    return f"{base}/{{{','.join(wanted)}}}"


def scan_bronze(spark: SparkSession, root: str, table: str, since: str | None = None,
                layout: str = "kv") -> DataFrame:
    """Declared-schema scan of a landed table; empty if nothing matches.

    since   optional lower bound on the change time (text); only the hours from
            there on and the full-load partition are listed, and a text filter on
            ``extract_at`` is pushed into the Parquet reader.
    layout  ``kv`` (``year_stream=YYYY/...``) or ``slash`` (``YYYY/MM/DD/HH``).
    """
    if layout not in LAYOUTS:
        raise ValueError(f"unknown layout {layout!r}")
    base = table_root(root, table)
    schema = bronze_schema(table)
    payload = bronze_schema(table, with_partitions=False)
    glob = hours_glob(spark, base, since, layout)
    if layout == "kv":
        reader = spark.read.schema(schema).option("basePath", base)
    else:
        reader = spark.read.schema(payload).option("recursiveFileLookup", "true")
    try:
        df = reader.parquet(glob)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
    if layout == "slash":
        path = F.col("_metadata.file_path")
        df = df.select(*payload.fieldNames(), path.alias("_path")).select(
            *payload.fieldNames(),
            *[F.regexp_extract("_path", SLASH_RE, i + 1).alias(c) for i, c in enumerate(PARTITION_COLS)])
    return df if since is None else df.where(F.col("extract_at") >= since)


def hours_of_paths(rows: DataFrame, layout: str = "kv") -> DataFrame:
    """Payload rows with the landing hour that their file's path names. As where partitions
    are found by folder names, full-load files beside the hours are left out.

    For readers with ``recursiveFileLookup``: a reader that finds partitions itself spends
    most of a listing on the driver, parsing every folder, again for every micro-batch."""
    at = F.col("_metadata.file_path")
    hour = [F.regexp_extract(at, PATH_RE[layout], i + 1) for i in range(len(PARTITION_COLS))]
    if layout == "kv":
        rows = rows.where(at.contains(f"/{PARTITION_COLS[-1]}="))
    return rows.select("*", *[F.when(~h.isin("", NULL_PARTITION), h).alias(c) for c, h in zip(PARTITION_COLS, hour)])


def file_count(spark: SparkSession, root: str, table: str) -> int:
    """How many files of a table have landed, full loads beside the hours included."""
    reader = spark.read.schema(bronze_schema(table, with_partitions=False)).option("recursiveFileLookup", "true")
    return len(reader.parquet(table_root(root, table))._jdf.inputFiles())


def partition_inventory(df: DataFrame, table: str) -> DataFrame:
    """One row per landed (table, hour) with its row count and an active marker."""
    return df.groupBy(*PARTITION_COLS).agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(table).alias("table_name"), *PARTITION_COLS, "row_count",
        F.lit(1).alias("partition_activated"),
    )


def register_partitions_sql(table: str, root: str, hours: list[tuple[str, str, str, str]],
                            database: str = "raw", layout: str = "kv") -> list[str]:
    """``ALTER TABLE ... ADD IF NOT EXISTS PARTITION`` statements for given hours."""
    base = table_root(root, table)
    out = []
    for y, m, d, h in hours:
        spec = ", ".join(f"{c}='{v}'" for c, v in zip(PARTITION_COLS, (y, m, d, h)))
        loc = f"{base}/" + "/".join(f"{c}{v}" for c, v in zip(LAYOUTS[layout], (y, m, d, h)))
        out.append(f"ALTER TABLE {database}.{table} ADD IF NOT EXISTS PARTITION ({spec}) LOCATION '{loc}'")
    return out


def partition_for_run(run_ts: dt.datetime, overrides: dict | None = None,
                      offset_hours: int = LOCAL_OFFSET_HOURS) -> tuple[str, str, str, str]:
    """Landing hour that a scheduled run registers: its time (UTC) in local time,
    with parts replaced by ``overrides``: ``partition_date`` (ISO date), or any of
    ``partition_year``, ``partition_month``, ``partition_day``; ``partition_hour``.
    Anything that is no date or hour is an error."""
    moment = run_ts - dt.timedelta(hours=offset_hours)
    given = {k: str(v).strip() for k, v in (overrides or {}).items() if v not in (None, "")}
    if "partition_date" in given:
        moment = dt.datetime.combine(dt.date.fromisoformat(given.pop("partition_date")), moment.time())
    parts = {k.removeprefix("partition_"): int(v) for k, v in given.items()}
    moment = moment.replace(**parts, minute=0, second=0, microsecond=0)
    return tuple(moment.strftime("%Y %m %d %H").split())


def refuse_foreign_table(spark: SparkSession, database: str, table: str, path: str) -> None:
    """Fail if the catalog has a table of that name at another place."""
    if not spark.catalog.tableExists(f"{database}.{table}"):
        return
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {database}.{table}").where("col_name = 'Location'").collect()
    files = Files(spark)
    if not rows or files.qualified(rows[0]["data_type"]) != files.qualified(path):
        raise ValueError(f"{database}.{table} exists and is not the table at {path}")


def register_table(spark: SparkSession, root: str, table: str, database: str = "raw") -> None:
    """Declare the landed table in the session catalog (schema fixed, nothing inferred)."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    refuse_foreign_table(spark, database, table, table_root(root, table))
    spark.sql(create_table_ddl(database, table, bronze_schema(table), table_root(root, table),
                               partitioned_by=PARTITION_COLS))


def activate_partition(spark: SparkSession, root: str, table: str, run_ts: dt.datetime,
                       overrides: dict | None = None, database: str = "raw",
                       layout: str = "kv") -> DataFrame:
    """Register the run's landing hour (idempotent) and return the marker row."""
    register_table(spark, root, table, database)
    for stmt in register_partitions_sql(table, root, [partition_for_run(run_ts, overrides)], database, layout):
        spark.sql(stmt)
    return spark.sql("SELECT 1 AS partition_activated")


def recover_partitions(spark: SparkSession, root: str, table: str, database: str = "raw") -> None:
    """Register every landed hour at once (no hour is left unreadable)."""
    register_table(spark, root, table, database)
    spark.sql(f"ALTER TABLE {database}.{table} RECOVER PARTITIONS")


def hours_status(spark: SparkSession, root: str, table: str, database: str = "raw",
                 layout: str = "kv") -> DataFrame:
    """One row per hour that has landed or that the catalog has registered: its row count
    and ``registered``, ``unregistered`` (landed, but no query of the catalog's table sees
    it) or ``empty`` (registered, but nothing has landed). Reads row counts only, no
    columns. A table that the catalog does not have has no registered hours."""
    landed = partition_inventory(scan_bronze(spark, root, table, layout=layout), table)
    name = f"{database}.{table}"
    if spark.catalog.tableExists(name):
        refuse_foreign_table(spark, database, table, table_root(root, table))
        known = spark.sql(f"SHOW PARTITIONS {name}").select(
            *[F.regexp_extract("partition", f"{c}=([^/]*)", 1).alias(c) for c in PARTITION_COLS])
    else:
        known = spark.createDataFrame([], ", ".join(f"{c} string" for c in PARTITION_COLS))
    both = landed.select(*PARTITION_COLS, "row_count").join(
        known.withColumn("_known", F.lit(True)), list(PARTITION_COLS), "full_outer")
    status = (F.when(F.col("row_count").isNull(), "empty")
              .when(F.col("_known").isNull(), "unregistered").otherwise("registered"))
    return both.select(F.lit(table).alias("table_name"), *PARTITION_COLS,
                       F.coalesce("row_count", F.lit(0)).cast("long").alias("row_count"), status.alias("status"))


def register_missing(spark: SparkSession, root: str, table: str, database: str = "raw",
                     layout: str = "kv") -> DataFrame:
    """Register the hours that landed without it; returns them as reported before. Only
    hour names reach the driver, as they do for every registration. Repeatable."""
    gap = hours_status(spark, root, table, database, layout).where("status = 'unregistered'")
    gap = gap.checkpoint(eager=True)
    register_table(spark, root, table, database)
    hours = [tuple(r) for r in gap.select(*PARTITION_COLS).orderBy(*PARTITION_COLS).collect()]
    for stmt in register_partitions_sql(table, root, hours, database, layout):
        spark.sql(stmt)
    return gap


def drop_full_load(df: DataFrame, root: str, table: str) -> None:
    """Write full-load files directly under the table root (as a dump would)."""
    payload = bronze_schema(table, with_partitions=False)
    df.select(*payload.fieldNames()).write.mode("append").parquet(table_root(root, table))


def backfill(spark: SparkSession, root: str, table: str, manifest_root: str,
             partition: tuple[str, str, str, str] = BACKFILL_PARTITION) -> DataFrame:
    """File root-level full-load files into the fixed partition, once per file name.

    Files already listed in the manifest are skipped. Only rows that the partition
    does not hold are appended, so a run that died between rows and manifest adds
    nothing when it is repeated. Returns the names landed by this run.
    """
    base = table_root(root, table)
    payload = bronze_schema(table, with_partitions=False)
    files = Files(spark)
    if not any(n.endswith(".parquet") for n in files.names(base)):
        return spark.createDataFrame([], MANIFEST_SCHEMA)
    dropped = (
        spark.read.schema(payload).parquet(f"{base}/*.parquet")
        .withColumn("file_name", F.col("_metadata.file_name"))
    )
    manifest_path = f"{manifest_root.rstrip('/')}/{table}"
    seen = (spark.read.schema(MANIFEST_SCHEMA).parquet(manifest_path) if files.exists(manifest_path)
            else spark.createDataFrame([], MANIFEST_SCHEMA))
    # Only names meet the manifest: joined on the file name, all rows of a file would be
    # one task's. The names fix the rows to land before anything is written.
    fresh = [r[0] for r in dropped.select("file_name").distinct().join(seen, "file_name", "left_anti").collect()]
    names = spark.createDataFrame([(n,) for n in fresh], MANIFEST_SCHEMA)
    if not fresh:
        return names
    rows = dropped.where(F.col("file_name").isin(fresh)).select(
        *payload.fieldNames(), *[F.lit(v).alias(c) for c, v in zip(PARTITION_COLS, partition)])
    append_missing(rows, root, table, partition)
    names.coalesce(1).write.mode("append").parquet(manifest_path)
    return names
