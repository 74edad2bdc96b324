"""Change feeds derived from the driver's TPC-H-like tables.

Each base row becomes 1-3 change images (``n = 0 .. key % 3``): an insert
image, then updates, with a delete wherever ``(key + n) % 11 == 0``. Images are
generated with ``explode(sequence(...))`` inside the scan's stage, so the feed
is a narrow transformation of the base table: no join, no shuffle, and its
size grows linearly with the input. Order lines come from ``lineitem`` one
image per row, the operation taken from the return flag.

All functions return DataFrames in the bronze schema (``sources.schemas``),
including the four landing partition columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.config import PARTITION_COLS
from tidemark.functions.time import format_extract_at, parse_extract_at, partition_values
from tidemark.sources.schemas import BASE_TABLES, bronze_schema

# Fixed values of the feed mapping: change times start here, versions are
# VERSION_STEP seconds apart and keys are spread over KEY_SPREAD seconds.
FEED_EPOCH = "2024-01-01 00:00:00"
VERSION_STEP = 500000
KEY_SPREAD = 400000
DAY_SECONDS = 86400


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(BASE_TABLES[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _versions(df: DataFrame, key: str) -> DataFrame:
    """One row per change image: n = 0 .. key % 3 (column ``_n``)."""
    return df.select("*", F.explode(F.sequence(F.lit(0), (F.col(key) % 3).cast("int"))).alias("_n"))


def _version_op(key: str) -> Column:
    k, n = F.col(key), F.col("_n")
    return F.when(n == 0, "I").when((k + n) % 11 == 0, "D").otherwise("U")


def _version_time(key: str) -> Column:
    secs = F.col("_n") * VERSION_STEP + F.col(key) % KEY_SPREAD
    return format_extract_at(F.timestamp_add("SECOND", secs, F.lit(FEED_EPOCH).cast("timestamp_ntz")))


def _finish(df: DataFrame, table: str, op: Column, extract_at: Column, **cols: Column) -> DataFrame:
    """One projection: change columns, payload cast to the bronze schema, and
    the landing partitions (UTC-3 wall clock of the change)."""
    schema = bronze_schema(table)
    given = {"op": op, "extract_at": extract_at, **cols}
    parts = dict(zip(PARTITION_COLS, partition_values(parse_extract_at(extract_at))))
    out = []
    for f in schema.fields:
        c = given.get(f.name, parts.get(f.name))
        out.append(c.cast(f.dataType).alias(f.name))
    return df.select(*out)


def _nstr(c: str) -> Column:
    return F.col(c).cast("string")


def offices_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = read_table(spark, sf_dir, "nation")
    region = read_table(spark, sf_dir, "region")
    base = nation.join(region, nation.n_regionkey == region.r_regionkey)
    k = F.col("n_nationkey")
    return _finish(
        _versions(base, "n_nationkey"), "offices",
        _version_op("n_nationkey"), _version_time("n_nationkey"),
        officecode=_nstr("n_nationkey"),
        city=F.concat(F.col("n_name"), F.lit("_v"), _nstr("_n")),
        phone=F.concat(F.lit("+1 555 "), _nstr("n_nationkey")),
        addressline1=F.concat(_nstr("n_nationkey"), F.lit(" Main Street")),
        addressline2=F.lit(None),
        state=F.when(k % 5 == 0, F.lit("")).otherwise(F.concat(F.lit("ST"), _nstr("n_nationkey"))),
        country=F.col("r_name"),
        postalcode=F.concat(F.lit("PC"), _nstr("n_nationkey")),
        territory=F.col("r_name"),
    )


def employees_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = read_table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    return _finish(
        _versions(supplier, "s_suppkey"), "employees",
        _version_op("s_suppkey"), _version_time("s_suppkey"),
        employeenumber=k,
        lastname=F.col("s_name"),
        firstname=F.concat(F.lit("Rep"), _nstr("s_suppkey")),
        extension=F.concat(F.lit("x"), _nstr("_n")),
        email=F.concat(F.lit("rep"), _nstr("s_suppkey"), F.lit("@example.com")),
        officecode=_nstr("s_nationkey"),
        reportsto=F.when(k % 10 == 0, F.lit(None)).otherwise(F.expr("s_suppkey div 10")),
        jobtitle=F.lit("Sales Rep"),
    )


def customers_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = read_table(spark, sf_dir, "customer")
    # Number of sales reps: a scalar subquery, evaluated once, no join.
    n_reps = read_table(spark, sf_dir, "supplier").select(F.count(F.lit(1))).scalar()
    k = F.col("c_custkey")
    return _finish(
        _versions(customer, "c_custkey"), "customers",
        _version_op("c_custkey"), _version_time("c_custkey"),
        customernumber=k,
        customername=F.col("c_name"),
        contactlastname=F.concat(F.lit("Last"), _nstr("c_custkey")),
        contactfirstname=F.concat(F.lit("First"), _nstr("c_custkey")),
        phone=F.concat(F.lit("+1 555 01"), _nstr("_n")),
        addressline1=F.concat(_nstr("c_custkey"), F.lit(" Market Road")),
        addressline2=F.lit(None),
        city=F.concat(F.lit("City"), _nstr("c_nationkey")),
        state=F.lit(None),
        postalcode=F.concat(F.lit("PC"), _nstr("c_custkey")),
        country=F.col("c_mktsegment"),
        salesrepemployeenumber=F.when(k % 17 == 0, F.lit(None)).otherwise(k % n_reps),
        creditlimit=F.col("c_acctbal").cast("decimal(18,2)"),
    )


def orders_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read_table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    orderdate = F.timestamp_add("SECOND", k % DAY_SECONDS, F.col("o_orderdate"))
    return _finish(
        _versions(orders, "o_orderkey"), "orders",
        _version_op("o_orderkey"), _version_time("o_orderkey"),
        ordernumber=k,
        orderdate=orderdate,
        requireddate=F.timestamp_add("DAY", F.lit(7), orderdate),
        shippeddate=F.when(F.col("_n") > 0, F.timestamp_add("DAY", F.lit(3), orderdate)),
        customernumber=F.col("o_custkey"),
    )


def products_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = read_table(spark, sf_dir, "part")
    price = F.col("p_retailprice").cast("decimal(18,2)")
    return _finish(
        _versions(part, "p_partkey"), "products",
        _version_op("p_partkey"), _version_time("p_partkey"),
        productcode=F.col("p_partkey"),
        productname=F.col("p_name"),
        productline=F.col("p_type"),
        productfamily=F.col("p_type"),
        productscale=F.concat(F.lit("1:"), _nstr("p_size")),
        productvendor=F.col("p_brand"),
        productdescription=F.concat(F.col("p_name"), F.lit(" model")),
        quantityinstock=F.col("p_size") * 10 + F.col("_n"),
        buyprice=price,
        msrp=price,
    )


def orderdetails_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    ts = F.timestamp_add("SECOND", F.col("l_partkey") % DAY_SECONDS, F.col("l_shipdate"))
    flag = F.col("l_returnflag")
    return _finish(
        li, "orderdetails",
        F.when(flag == "N", "I").when(flag == "A", "U").when(flag == "R", "D"),
        format_extract_at(ts),
        ordernumber=F.col("l_orderkey"),
        productcode=F.col("l_partkey"),
        quantityordered=F.col("l_quantity").cast("bigint") % 3 + 1,
        priceeach=F.col("l_extendedprice").cast("decimal(18,2)"),
        orderlinenumber=F.col("l_linenumber"),
    )


FEEDS = {
    "customers": customers_feed,
    "employees": employees_feed,
    "offices": offices_feed,
    "orders": orders_feed,
    "products": products_feed,
    "orderdetails": orderdetails_feed,
}


def feed(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """The change feed of ``table``."""
    return FEEDS[table](spark, sf_dir)
