"""Declared table schemas: six bronze change feeds, six silver tables, one mart.

Bronze scans always use these schemas (nothing is inferred), so a renamed or
extra source column cannot change what the jobs read.
"""

from __future__ import annotations

from pyspark.sql import types as T

from tidemark.config import LINEAGE_COLS, PARTITION_COLS

S, L, D, TS = T.StringType(), T.LongType(), T.DoubleType(), T.TimestampNTZType()
MONEY = T.DecimalType(18, 2)


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


_CHANGE = (("op", S), ("extract_at", S))
_PARTS = tuple((c, S) for c in PARTITION_COLS)

BRONZE_PAYLOAD = {
    "customers": (
        ("customernumber", L), ("customername", S), ("contactlastname", S),
        ("contactfirstname", S), ("phone", S), ("addressline1", S), ("addressline2", S),
        ("city", S), ("state", S), ("postalcode", S), ("country", S),
        ("salesrepemployeenumber", L), ("creditlimit", MONEY),
    ),
    "employees": (
        ("employeenumber", L), ("lastname", S), ("firstname", S), ("extension", S),
        ("email", S), ("officecode", S), ("reportsto", L), ("jobtitle", S),
    ),
    "offices": (
        ("officecode", S), ("city", S), ("phone", S), ("addressline1", S),
        ("addressline2", S), ("state", S), ("country", S), ("postalcode", S),
        ("territory", S),
    ),
    "orderdetails": (
        ("ordernumber", L), ("productcode", L), ("quantityordered", L),
        ("priceeach", MONEY), ("orderlinenumber", L),
    ),
    "orders": (
        ("ordernumber", L), ("orderdate", TS), ("requireddate", TS),
        ("shippeddate", TS), ("customernumber", L),
    ),
    "products": (
        ("productcode", L), ("productname", S), ("productline", S), ("productfamily", S),
        ("productscale", S), ("productvendor", S), ("productdescription", S),
        ("quantityinstock", L), ("buyprice", MONEY), ("msrp", MONEY),
    ),
}


def bronze_schema(table: str, with_partitions: bool = True) -> T.StructType:
    """op, extract_at, payload, then the four landing partition columns."""
    fields = _CHANGE + BRONZE_PAYLOAD[table] + (_PARTS if with_partitions else ())
    return _struct(*fields)


_LINEAGE = tuple((c, S) for c in LINEAGE_COLS) + (("extract_at", TS),)

SILVER_PAYLOAD = {
    "customers": BRONZE_PAYLOAD["customers"][:-1] + (("creditlimit", D),),
    "employees": (
        ("employeenumber", L), ("lastname", S), ("firstname", S), ("extension", S),
        ("email", S), ("officecode", L), ("reportsto", L), ("jobtitle", S),
    ),
    "offices": (("officecode", L),) + BRONZE_PAYLOAD["offices"][1:],
    "orderdetails": (
        ("ordernumber", L), ("orderdate", TS), ("productcode", L),
        ("quantityordered", L), ("priceeach", D), ("orderlinenumber", L), ("amount", D),
    ),
    "orders": (
        ("ordernumber", L), ("orderdate", TS), ("orderyearmonth", L),
        ("customernumber", L),
    ),
    "products": BRONZE_PAYLOAD["products"][:-2] + (("buyprice", D), ("msrp", D)),
}


def silver_schema(table: str) -> T.StructType:
    return _struct(*(SILVER_PAYLOAD[table] + _LINEAGE))


#: The tables that the feeds stand on. Declared, so that planning a query starts no job.
BASE_TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
}

GOLD_SCHEMA = _struct(
    ("locality_officecode", L), ("locality_city", S), ("locality_state", S),
    ("locality_country", S), ("locality_territory", S), ("interval_portsales", S),
    ("calendar_sales_date", TS), ("calendar_month_number", L),
    ("calendar_monthname_full", S), ("calendar_monthname_short", S),
    ("calendar_quarter", L), ("calendar_year", L),
    ("sales_quantityordered", L), ("sales_amount", D),
)


def create_table_ddl(zone: str, table: str, schema: T.StructType, location: str,
                     partitioned_by: tuple[str, ...] = ()) -> str:
    """``CREATE TABLE IF NOT EXISTS ... USING parquet`` for a declared schema."""
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    part = f" PARTITIONED BY ({', '.join(partitioned_by)})" if partitioned_by else ""
    return (f"CREATE TABLE IF NOT EXISTS {zone}.{table} ({cols}) USING parquet"
            f"{part} LOCATION '{location}'")
