"""DuckDB oracle SQL for every catalogue query.

Written from the model's semantics, with keys, operations and tie orders of its
own, not from the Spark plans or specs, so the two check each other. The driver's tables are views named
after the files (``orders``, ``lineitem``, ...).
"""

from __future__ import annotations

from tidemark.plans.catalog import DETAILS_CUTOFF, FEED_CUTOFF, GOLD_CUTOFF, REGISTERED_HOUR

FMT = "%Y-%m-%d %H:%M:%S.%f"
TS = f"strptime(extract_at, '{FMT}')"
OPRANK = "CASE op WHEN 'I' THEN 0 WHEN 'U' THEN 1 WHEN 'D' THEN 2 ELSE -1 END"
PARTS = ("year_stream", "month_stream", "day_stream", "hour_stream")


def _op(k: str) -> str:
    return f"CASE WHEN _n = 0 THEN 'I' WHEN ({k} + _n) % 11 = 0 THEN 'D' ELSE 'U' END"


def _ext(k: str) -> str:
    return (f"strftime(TIMESTAMP '2024-01-01 00:00:00' + to_seconds(_n * 500000 + {k} % 400000), "
            f"'{FMT}')")


def _parts(inner: str) -> str:
    local = f"strptime(extract_at, '{FMT}') - INTERVAL 3 HOUR"
    return (f"SELECT *, strftime({local}, '%Y') AS year_stream, strftime({local}, '%m') AS month_stream, "
            f"strftime({local}, '%d') AS day_stream, strftime({local}, '%H') AS hour_stream FROM ({inner})")


FEEDS = {
    "offices": _parts(f"""
SELECT {_op('n_nationkey')} AS op, {_ext('n_nationkey')} AS extract_at,
  CAST(n_nationkey AS VARCHAR) AS officecode, n_name || '_v' || CAST(_n AS VARCHAR) AS city,
  '+1 555 ' || CAST(n_nationkey AS VARCHAR) AS phone,
  CAST(n_nationkey AS VARCHAR) || ' Main Street' AS addressline1, CAST(NULL AS VARCHAR) AS addressline2,
  CASE WHEN n_nationkey % 5 = 0 THEN '' ELSE 'ST' || CAST(n_nationkey AS VARCHAR) END AS state,
  r_name AS country, 'PC' || CAST(n_nationkey AS VARCHAR) AS postalcode, r_name AS territory
FROM (SELECT n.*, r.r_name, unnest(generate_series(0, n.n_nationkey % 3)) AS _n
      FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey)"""),
    "employees": _parts(f"""
SELECT {_op('s_suppkey')} AS op, {_ext('s_suppkey')} AS extract_at,
  s_suppkey AS employeenumber, s_name AS lastname, 'Rep' || CAST(s_suppkey AS VARCHAR) AS firstname,
  'x' || CAST(_n AS VARCHAR) AS extension, 'rep' || CAST(s_suppkey AS VARCHAR) || '@example.com' AS email,
  CAST(s_nationkey AS VARCHAR) AS officecode,
  CASE WHEN s_suppkey % 10 = 0 THEN NULL ELSE s_suppkey // 10 END AS reportsto,
  'Sales Rep' AS jobtitle
FROM (SELECT *, unnest(generate_series(0, s_suppkey % 3)) AS _n FROM supplier)"""),
    "customers": _parts(f"""
SELECT {_op('c_custkey')} AS op, {_ext('c_custkey')} AS extract_at,
  c_custkey AS customernumber, c_name AS customername,
  'Last' || CAST(c_custkey AS VARCHAR) AS contactlastname, 'First' || CAST(c_custkey AS VARCHAR) AS contactfirstname,
  '+1 555 01' || CAST(_n AS VARCHAR) AS phone, CAST(c_custkey AS VARCHAR) || ' Market Road' AS addressline1,
  CAST(NULL AS VARCHAR) AS addressline2, 'City' || CAST(c_nationkey AS VARCHAR) AS city,
  CAST(NULL AS VARCHAR) AS state, 'PC' || CAST(c_custkey AS VARCHAR) AS postalcode, c_mktsegment AS country,
  CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE c_custkey % (SELECT count(*) FROM supplier) END AS salesrepemployeenumber,
  CAST(c_acctbal AS DECIMAL(18,2)) AS creditlimit
FROM (SELECT *, unnest(generate_series(0, c_custkey % 3)) AS _n FROM customer)"""),
    "orders": _parts(f"""
SELECT {_op('o_orderkey')} AS op, {_ext('o_orderkey')} AS extract_at,
  o_orderkey AS ordernumber, od AS orderdate, od + INTERVAL 7 DAY AS requireddate,
  CASE WHEN _n > 0 THEN od + INTERVAL 3 DAY END AS shippeddate, o_custkey AS customernumber
FROM (SELECT *, o_orderdate + to_seconds(o_orderkey % 86400) AS od,
             unnest(generate_series(0, o_orderkey % 3)) AS _n FROM orders)"""),
    "products": _parts(f"""
SELECT {_op('p_partkey')} AS op, {_ext('p_partkey')} AS extract_at,
  p_partkey AS productcode, p_name AS productname, p_type AS productline, p_type AS productfamily,
  '1:' || CAST(p_size AS VARCHAR) AS productscale, p_brand AS productvendor,
  p_name || ' model' AS productdescription, CAST(p_size * 10 + _n AS BIGINT) AS quantityinstock,
  CAST(p_retailprice AS DECIMAL(18,2)) AS buyprice, CAST(p_retailprice AS DECIMAL(18,2)) AS msrp
FROM (SELECT *, unnest(generate_series(0, p_partkey % 3)) AS _n FROM part)"""),
    "orderdetails": _parts(f"""
SELECT CASE l_returnflag WHEN 'N' THEN 'I' WHEN 'A' THEN 'U' WHEN 'R' THEN 'D' END AS op,
  strftime(l_shipdate + to_seconds(l_partkey % 86400), '{FMT}') AS extract_at,
  l_orderkey AS ordernumber, l_partkey AS productcode,
  CAST(l_quantity AS BIGINT) % 3 + 1 AS quantityordered,
  CAST(l_extendedprice AS DECIMAL(18,2)) AS priceeach, CAST(l_linenumber AS BIGINT) AS orderlinenumber
FROM lineitem"""),
}

# Silver payload expressions over a bronze row, per table.
SILVER_COLS = {
    "customers": [(c, c) for c in ("customernumber", "customername", "contactlastname",
                                   "contactfirstname", "phone", "addressline1", "addressline2",
                                   "city", "state", "postalcode", "country")]
    + [("salesrepemployeenumber", "coalesce(salesrepemployeenumber, 0)"),
       ("creditlimit", "CAST(creditlimit AS DOUBLE)")],
    "employees": [(c, c) for c in ("employeenumber", "lastname", "firstname", "extension", "email")]
    + [("officecode", "CAST(officecode AS BIGINT)"), ("reportsto", "coalesce(reportsto, 0)"),
       ("jobtitle", "jobtitle")],
    "offices": [("officecode", "CAST(officecode AS BIGINT)")]
    + [(c, c) for c in ("city", "phone", "addressline1", "addressline2", "state", "country",
                        "postalcode", "territory")],
    "orders": [("ordernumber", "CAST(ordernumber AS BIGINT)"),
               ("orderdate", "orderdate - INTERVAL 3 HOUR"),
               ("orderyearmonth",
                "CAST(CAST(strftime(orderdate - INTERVAL 3 HOUR, '%Y%m') AS INTEGER) AS BIGINT)"),
               ("customernumber", "customernumber")],
    "products": [(c, c) for c in ("productcode", "productname", "productline", "productfamily",
                                  "productscale", "productvendor", "productdescription",
                                  "quantityinstock")]
    + [("buyprice", "CAST(buyprice AS DOUBLE)"), ("msrp", "CAST(msrp AS DOUBLE)")],
}
# Keys and admitted operations of each table, and the landed payload columns in the
# order that breaks ties: stated here, not taken from the code under test.
KEYS = {"customers": ("customernumber",), "employees": ("employeenumber",), "offices": ("officecode",),
        "orders": ("ordernumber",), "products": ("productcode",),
        "orderdetails": ("ordernumber", "productcode", "orderlinenumber")}
OPS = {"customers": "IU", "employees": "IU", "offices": "IU", "orders": "IUD", "products": "IU", "orderdetails": "IU"}
PAYLOAD = {
    "customers": [n for n, _ in SILVER_COLS["customers"]],
    "employees": [n for n, _ in SILVER_COLS["employees"]],
    "offices": [n for n, _ in SILVER_COLS["offices"]],
    "orders": ["ordernumber", "orderdate", "requireddate", "shippeddate", "customernumber"],
    "products": [n for n, _ in SILVER_COLS["products"]],
    "orderdetails": ["ordernumber", "productcode", "quantityordered", "priceeach", "orderlinenumber"],
}
LINEAGE = ("'silver' AS zone_area, 'commercial' AS business_area, 'erp' AS source_system, "
           "'{ds}' AS dataset")


def _with(*ctes: tuple[str, str]) -> str:
    return "WITH " + ",\n".join(f"{n} AS ({body})" for n, body in ctes)


def _order(cols: list[str]) -> str:
    return ", ".join(f"{c} DESC NULLS LAST" for c in cols)


def _ops(ops) -> str:
    return ", ".join(f"'{o}'" for o in ops)


def silver_sql(table: str, src: str, where: str = "", dedupe: bool = True, live: bool = False) -> str:
    """Silver rows of ``table`` from the bronze relation ``src`` (not details); ``live``:
    without the keys whose newest image of any operation is a delete."""
    cols = ", ".join(f"{e} AS {n}" for n, e in SILVER_COLS[table])
    inner = (f"SELECT {cols}, {LINEAGE.format(ds=table)}, {TS} - INTERVAL 3 HOUR AS extract_at, "
             f"{TS} AS _ts, {OPRANK} AS _op FROM {src} WHERE op IN ({_ops('IUD' if live else OPS[table])}) {where}")
    if live:
        order = _order(["_ts", "_op"] + [n for n, _ in SILVER_COLS[table] if n not in KEYS[table]])
        return (f"SELECT * EXCLUDE (_ts, _op, _nth) FROM (SELECT *, row_number() OVER (PARTITION BY "
                f"{', '.join(KEYS[table])} ORDER BY {order}) AS _nth FROM ({inner})) WHERE _nth = 1 AND _op <> 2")
    if not dedupe:
        return f"SELECT * EXCLUDE (_ts, _op) FROM ({inner})"
    order = _order(["_ts", "_op"] + [n for n, _ in SILVER_COLS[table] if n not in KEYS[table]])
    return (f"SELECT * EXCLUDE (_ts, _op) FROM ({inner}) "
            f"QUALIFY row_number() OVER (PARTITION BY {', '.join(KEYS[table])} ORDER BY {order}) = 1")


def details_sql(src: str, orders_src: str, where: str = "") -> str:
    """Silver order lines: the newest image of each line with the date of the newest
    image of its order."""
    newest_order = (f"SELECT ordernumber, orderdate - INTERVAL 3 HOUR AS orderdate FROM {orders_src} "
                    f"WHERE op IN ({_ops(OPS['orders'])}) QUALIFY row_number() OVER (PARTITION BY ordernumber "
                    f"ORDER BY {_order([TS, OPRANK, 'orderdate', 'customernumber'])}) = 1")
    newest_line = (f"SELECT * FROM {src} WHERE op IN ({_ops(OPS['orderdetails'])}) {where} "
                   f"QUALIFY row_number() OVER (PARTITION BY {', '.join(KEYS['orderdetails'])} "
                   f"ORDER BY {_order([TS, OPRANK, 'quantityordered', 'priceeach'])}) = 1")
    return (f"SELECT ordernumber, dated.orderdate, productcode, quantityordered, "
            f"CAST(priceeach AS DOUBLE) AS priceeach, orderlinenumber, "
            f"CAST(quantityordered * priceeach AS DOUBLE) AS amount, {LINEAGE.format(ds='orderdetails')}, "
            f"{TS} AS extract_at FROM ({newest_line}) line LEFT JOIN ({newest_order}) dated USING (ordernumber)")


def feeds_cte(*names: str) -> list[tuple[str, str]]:
    return [(f"f_{n}", FEEDS[n]) for n in names]


ALL_FEEDS = ("offices", "employees", "customers", "orders", "products", "orderdetails")


def silver_ctes() -> list[tuple[str, str]]:
    ctes = feeds_cte(*ALL_FEEDS)
    for t in ("offices", "employees", "customers", "orders", "products"):
        ctes.append((f"s_{t}", silver_sql(t, f"f_{t}")))
    ctes.append(("s_orderdetails", details_sql("f_orderdetails", "f_orders")))
    return ctes


BUCKET = ("CASE WHEN {a} <= 50000 THEN 'Small' WHEN {a} BETWEEN 50000 AND 75000 THEN 'Medium' "
          "ELSE 'Big' END")


def gold_select(lines: str, orders: str, customers: str, employees: str, offices: str, where: str = "") -> str:
    """The mart in one grouped join; ``where`` is over ``sale`` (the orders)."""
    bucket = BUCKET.format(a="line.amount")
    return (f"SELECT office.officecode AS locality_officecode, office.city AS locality_city, "
            f"nullif(office.state, '') AS locality_state, office.country AS locality_country, "
            f"office.territory AS locality_territory, {bucket} AS interval_portsales, "
            f"sale.orderdate AS calendar_sales_date, "
            f"CAST(month(sale.orderdate) AS BIGINT) AS calendar_month_number, "
            f"strftime(sale.orderdate, '%B') AS calendar_monthname_full, "
            f"strftime(sale.orderdate, '%m') AS calendar_monthname_short, "
            f"CAST(quarter(sale.orderdate) AS BIGINT) AS calendar_quarter, "
            f"CAST(year(sale.orderdate) AS BIGINT) AS calendar_year, "
            f"CAST(sum(line.quantityordered) AS BIGINT) AS sales_quantityordered, "
            f"CAST(sum(CAST(line.amount AS DECIMAL(38,2))) AS DOUBLE) AS sales_amount "
            f"FROM {orders} sale JOIN {lines} line ON line.ordernumber = sale.ordernumber "
            f"JOIN {customers} buyer ON buyer.customernumber = sale.customernumber "
            f"JOIN {employees} rep ON rep.employeenumber = buyer.salesrepemployeenumber "
            f"JOIN {offices} office ON office.officecode = rep.officecode "
            f"{where and 'WHERE ' + where} GROUP BY ALL")


GOLD_FULL = gold_select("s_orderdetails", "s_orders", "s_customers", "s_employees", "s_offices")


def _q(ctes: list[tuple[str, str]], final: str) -> str:
    return f"{_with(*ctes)}\n{final}"


def _gold_q(final: str) -> str:
    return _q(silver_ctes() + [("gold", GOLD_FULL)], final)


def raw_latest_sql(table: str) -> str:
    tb = [n for n in PAYLOAD[table] if n not in KEYS[table]]
    order = _order([TS, OPRANK] + tb)
    return _q(feeds_cte(table),
              f"SELECT * EXCLUDE (_rn) FROM (SELECT *, row_number() OVER (PARTITION BY "
              f"{', '.join(KEYS[table])} ORDER BY {order}) AS _rn FROM f_{table} "
              f"WHERE op IN ({_ops(OPS[table])})) WHERE _rn = 1")


def upsert_sql(target: str, source: str, keys: tuple[str, ...]) -> str:
    cond = " AND ".join(f"s.{k} = t.{k}" for k in keys)
    return (f"SELECT * FROM {target} t WHERE NOT EXISTS (SELECT 1 FROM {source} s WHERE {cond}) "
            f"UNION ALL SELECT * FROM {source}")


def _oracle() -> dict[str, str]:
    q: dict[str, str] = {}
    lt = f"{TS} - INTERVAL 3 HOUR"
    # bronze
    q["bronze_partition_values"] = _q(feeds_cte("orders"),
        "SELECT ordernumber, op, extract_at, year_stream, month_stream, day_stream, hour_stream FROM f_orders")
    q["bronze_land_hourly"] = _q(feeds_cte("orders"), "SELECT * FROM f_orders")
    q["bronze_scan"] = _q(feeds_cte("orderdetails"), "SELECT * FROM f_orderdetails")
    q["bronze_partition_inventory"] = _q(feeds_cte(*ALL_FEEDS),
        " UNION ALL ".join(
            f"SELECT '{t}' AS table_name, year_stream, month_stream, day_stream, hour_stream, "
            f"count(*) AS row_count, 1 AS partition_activated FROM f_{t} GROUP BY ALL" for t in ALL_FEEDS))
    q["bronze_unregistered_hours"] = _q(feeds_cte(*ALL_FEEDS),
        " UNION ALL ".join(
            f"SELECT '{t}' AS table_name, year_stream, month_stream, day_stream, hour_stream, count(*) AS row_count, "
            f"CASE WHEN hour_stream = '{REGISTERED_HOUR}' THEN 'registered' ELSE 'unregistered' END AS status "
            f"FROM f_{t} GROUP BY ALL" for t in ALL_FEEDS))
    drift = (("requireddate", "timestamp_ntz", None, "missing", "U"), ("requirededate", None, "timestamp_ntz", "unknown", "U"),
             ("customernumber", "bigint", "string", "type", "D"), ("channel", None, "int", "unknown", "D"))
    text = lambda v: "CAST(NULL AS VARCHAR)" if v is None else f"'{v}'"
    q["bronze_schema_drift"] = _q(feeds_cte("orders"), " UNION ALL ".join(
        f"SELECT 'orders' AS dataset, '{c}' AS column_name, {text(want)} AS declared, {text(found)} AS found, "
        f"'{fault}' AS fault, count(*) AS n_rows FROM f_orders WHERE op = '{op}'" for c, want, found, fault, op in drift))
    cols = ", ".join(PAYLOAD["products"])
    q["bronze_backfill_fixed_partition"] = _q(feeds_cte("products"),
        f"SELECT op, extract_at, {cols}, '2026' AS year_stream, '01' AS month_stream, "
        f"'01' AS day_stream, '00' AS hour_stream FROM f_products")
    moved = "(SELECT * REPLACE (replace(extract_at, '2024-', '2026-') AS extract_at) FROM f_products)"
    q["bronze_backfill_to_silver"] = _q(feeds_cte("products"), silver_sql("products", moved))
    q["partition_transform_hour"] = _q(silver_ctes(),
        "SELECT ordernumber, orderdate, date_trunc('hour', orderdate) AS orderdate_hour FROM s_orders")
    q["partition_transform_month"] = _gold_q(
        "SELECT locality_officecode, interval_portsales, calendar_sales_date, "
        "CAST(date_trunc('month', calendar_sales_date) AS TIMESTAMP) AS sales_month FROM gold")
    # scalar
    keys = {"offices": "officecode", "employees": "employeenumber", "customers": "customernumber", "orders": "ordernumber",
            "products": "productcode", "orderdetails": "concat_ws('/', ordernumber, productcode, orderlinenumber)"}
    q["lineage_constants"] = _q(feeds_cte(*ALL_FEEDS), " UNION ALL ".join(
        f"SELECT CAST({keys[t]} AS VARCHAR) AS key, extract_at, {LINEAGE.format(ds=t)} FROM f_{t}" for t in ALL_FEEDS))
    q["null_default_salesrep"] = _q(feeds_cte("customers"),
        "SELECT customernumber, extract_at, coalesce(salesrepemployeenumber, 0) AS salesrepemployeenumber "
        "FROM f_customers")
    q["null_default_reportsto"] = _q(feeds_cte("employees"),
        "SELECT employeenumber, extract_at, coalesce(reportsto, 0) AS reportsto FROM f_employees")
    q["blank_to_null_state"] = _q(feeds_cte("offices"),
        "SELECT officecode, extract_at, state, CASE WHEN state = '' THEN NULL ELSE state END AS locality_state "
        "FROM f_offices")
    amt = "CAST(quantityordered * priceeach AS DOUBLE)"
    q["bucket_portsales"] = _q(feeds_cte("orderdetails"),
        f"SELECT ordernumber, productcode, orderlinenumber, extract_at, {amt} AS amount, "
        f"{BUCKET.format(a=amt)} AS interval_portsales FROM f_orderdetails")
    q["cast_officecode"] = _q(feeds_cte("offices", "employees"),
        "SELECT 'offices' AS dataset, extract_at, officecode AS officecode_text, "
        "CAST(officecode AS BIGINT) AS officecode FROM f_offices UNION ALL "
        "SELECT 'employees', extract_at, officecode, CAST(officecode AS BIGINT) FROM f_employees")
    q["cast_prices"] = _q(feeds_cte("products"),
        "SELECT productcode, extract_at, CAST(buyprice AS DOUBLE) AS buyprice, CAST(msrp AS DOUBLE) AS msrp "
        "FROM f_products")
    q["line_amount"] = _q(feeds_cte("orderdetails"),
        f"SELECT ordernumber, productcode, orderlinenumber, extract_at, quantityordered, "
        f"CAST(priceeach AS DOUBLE) AS priceeach, {amt} AS amount FROM f_orderdetails")
    q["parse_extract_at"] = _q(feeds_cte("orders"),
        f"SELECT ordernumber, extract_at, {TS} AS extract_ts FROM f_orders")
    q["shift_utc_minus_3"] = _q(feeds_cte("orders"),
        f"SELECT ordernumber, extract_at, {lt} AS extract_local, "
        f"orderdate - INTERVAL 3 HOUR AS orderdate_local FROM f_orders")
    q["order_year_month"] = _q(feeds_cte("orders"),
        "SELECT ordernumber, extract_at, orderdate - INTERVAL 3 HOUR AS orderdate, "
        "CAST(CAST(strftime(orderdate - INTERVAL 3 HOUR, '%Y%m') AS INTEGER) AS BIGINT) AS orderyearmonth "
        "FROM f_orders")
    q["calendar_attributes"] = _q(silver_ctes(),
        "SELECT ordernumber, orderdate, CAST(month(orderdate) AS BIGINT) AS calendar_month_number, "
        "strftime(orderdate, '%B') AS calendar_monthname_full, strftime(orderdate, '%m') AS calendar_monthname_short, "
        "CAST(quarter(orderdate) AS BIGINT) AS calendar_quarter, CAST(year(orderdate) AS BIGINT) AS calendar_year "
        "FROM s_orders")
    # filters
    q["cdc_filter_iu"] = _q(feeds_cte("customers"), "SELECT * FROM f_customers WHERE op IN ('I','U')")
    q["cdc_filter_iud"] = _q(feeds_cte("orders"), "SELECT * FROM f_orders WHERE op IN ('I','U','D')")
    q["table_high_watermark"] = _q(silver_ctes(), " UNION ALL ".join(
        f"SELECT '{t}' AS dataset, max(extract_at) AS high_watermark FROM s_{t}"
        for t in ("customers", "employees", "offices", "orders", "products", "orderdetails")))
    q["watermark_filter_shifted"] = _q(
        feeds_cte("orders") + [("tgt", silver_sql("orders", f"(SELECT * FROM f_orders WHERE extract_at <= '{FEED_CUTOFF}')"))],
        f"SELECT * FROM f_orders WHERE op IN ('I','U','D') AND {TS} > (SELECT max(extract_at) FROM tgt)")
    q["watermark_filter_exact"] = _q(
        feeds_cte("orders", "orderdetails")
        + [("tgt", details_sql(f"(SELECT * FROM f_orderdetails WHERE extract_at <= '{DETAILS_CUTOFF}')", "f_orders"))],
        f"SELECT * FROM f_orderdetails WHERE op IN ('I','U') AND {TS} > (SELECT max(extract_at) FROM tgt)")
    # windows
    for t in ("customers", "offices", "orders", "products", "orderdetails"):
        q[f"latest_{t}"] = raw_latest_sql(t)
    # joins
    lo = (f"SELECT ordernumber, orderdate FROM (SELECT ordernumber, orderdate - INTERVAL 3 HOUR AS orderdate, "
          f"row_number() OVER (PARTITION BY ordernumber ORDER BY {TS} DESC NULLS LAST, {OPRANK} DESC NULLS LAST, "
          f"orderdate DESC NULLS LAST, customernumber DESC NULLS LAST) AS rn FROM f_orders) WHERE rn = 1")
    q["join_details_orders_left"] = _q(feeds_cte("orders", "orderdetails"),
        f"SELECT b.ordernumber, b.productcode, b.orderlinenumber, b.op, b.extract_at, b.quantityordered, "
        f"o.orderdate FROM f_orderdetails b LEFT JOIN ({lo}) o ON b.ordernumber = o.ordernumber "
        f"WHERE b.op IN ('I','U')")
    q["join_details_orders_inner"] = _q(silver_ctes(),
        "SELECT od.ordernumber, od.productcode, od.orderlinenumber, od.quantityordered, od.amount, "
        "o.orderdate, o.customernumber FROM s_orderdetails od JOIN s_orders o ON od.ordernumber = o.ordernumber")
    q["join_orders_customers"] = _q(silver_ctes(),
        "SELECT o.ordernumber, o.orderdate, o.customernumber, c.salesrepemployeenumber "
        "FROM s_orders o JOIN s_customers c ON o.customernumber = c.customernumber")
    q["join_customers_employees"] = _q(silver_ctes(),
        "SELECT c.customernumber, e.employeenumber, e.officecode "
        "FROM s_customers c JOIN s_employees e ON c.salesrepemployeenumber = e.employeenumber")
    q["join_sales_offices"] = _q(silver_ctes(),
        f"SELECT od.ordernumber, {BUCKET.format(a='od.amount')} AS interval_portsales, "
        f"CAST(sum(od.quantityordered) AS BIGINT) AS qty, CAST(sum(CAST(od.amount AS DECIMAL(38,2))) AS DOUBLE) AS amt, "
        f"o.orderdate, o.customernumber, f.officecode, f.city, f.state, f.country, f.territory "
        f"FROM s_orderdetails od JOIN s_orders o ON od.ordernumber = o.ordernumber "
        f"JOIN s_customers c ON o.customernumber = c.customernumber "
        f"JOIN s_employees e ON c.salesrepemployeenumber = e.employeenumber "
        f"JOIN s_offices f ON e.officecode = f.officecode "
        f"GROUP BY ALL")
    # load
    q["merge_upsert_single_key"] = _q(
        feeds_cte("customers")
        + [("tgt", silver_sql("customers", f"(SELECT * FROM f_customers WHERE extract_at <= '{FEED_CUTOFF}')")),
           ("src", silver_sql("customers", f"(SELECT * FROM f_customers WHERE extract_at > '{FEED_CUTOFF}')"))],
        upsert_sql("tgt", "src", ("customernumber",)))
    q["merge_upsert_composite_key"] = _q(
        feeds_cte("orders", "orderdetails")
        + [("tgt", details_sql(f"(SELECT * FROM f_orderdetails WHERE extract_at <= '{DETAILS_CUTOFF}')", "f_orders")),
           ("src", details_sql(f"(SELECT * FROM f_orderdetails WHERE extract_at > '{DETAILS_CUTOFF}')", "f_orders"))],
        upsert_sql("tgt", "src", ("ordernumber", "productcode", "orderlinenumber")))
    for t in ("customers", "employees", "offices", "orderdetails", "orders", "products"):
        q[f"silver_{t}"] = _q(silver_ctes(), f"SELECT * FROM s_{t}")
    q["silver_employees_nodedup"] = _q(feeds_cte("employees"), silver_sql("employees", "f_employees", dedupe=False))
    q["silver_orders_incremental"] = _q(
        feeds_cte("orders")
        + [("tgt", silver_sql("orders", f"(SELECT * FROM f_orders WHERE extract_at <= '{FEED_CUTOFF}')")),
           ("src", silver_sql("orders", "f_orders", where=f"AND {TS} > (SELECT max(extract_at) FROM tgt)"))],
        upsert_sql("tgt", "src", ("ordernumber",)))
    q["silver_orderdetails_incremental"] = _q(
        feeds_cte("orders", "orderdetails")
        + [("tgt", details_sql(f"(SELECT * FROM f_orderdetails WHERE extract_at <= '{DETAILS_CUTOFF}')", "f_orders")),
           ("src", details_sql("f_orderdetails", "f_orders",
                               where=f"AND {TS} > (SELECT max(extract_at) FROM tgt)"))],
        upsert_sql("tgt", "src", ("ordernumber", "productcode", "orderlinenumber")))
    # Every order moves back to its own date; lines that came before any order
    # and came again take the date too.
    q["merge_moved_partition"] = _q(silver_ctes(),
        "SELECT 'orders' AS dataset, ordernumber, CAST(0 AS BIGINT) AS productcode, CAST(0 AS BIGINT) AS orderlinenumber, "
        "orderdate FROM s_orders UNION ALL SELECT 'orderdetails', ordernumber, productcode, "
        "CAST(orderlinenumber AS BIGINT), orderdate FROM s_orderdetails")
    q["silver_orders_full_refresh"] = _q(silver_ctes(), "SELECT * FROM s_orders")
    # Whatever came late or in which order, the tables end as if all had come at once.
    q["gold_late_groups"] = _gold_q("SELECT * FROM gold")
    q["lines_date_repair"] = _q(silver_ctes(), "SELECT * FROM s_orderdetails")
    for t in ("customers", "orders"):
        q[f"silver_{t}_deletes"] = _q(feeds_cte(t), silver_sql(t, f"f_{t}", live=True))
    # gold
    q["gold_sales_dataset"] = _gold_q("SELECT * FROM gold")
    early = gold_select("s_orderdetails", f"(SELECT * FROM s_orders WHERE orderdate <= TIMESTAMP '{GOLD_CUTOFF}')",
                        "s_customers", "s_employees", "s_offices")
    late = gold_select("s_orderdetails", "s_orders", "s_customers", "s_employees", "s_offices",
                       where="sale.orderdate > (SELECT max(calendar_sales_date) FROM gtgt)")
    q["gold_sales_incremental"] = _q(
        silver_ctes() + [("gtgt", early), ("gsrc", late)],
        "SELECT * FROM gtgt t WHERE NOT EXISTS (SELECT 1 FROM gsrc s WHERE s.locality_officecode = t.locality_officecode "
        "AND s.interval_portsales = t.interval_portsales AND s.calendar_sales_date = t.calendar_sales_date) "
        "UNION ALL SELECT * FROM gsrc")
    old = gold_select("old_lines", "s_orders", "s_customers", "s_employees", "s_offices",
                      where=f"sale.orderdate < TIMESTAMP '{GOLD_CUTOFF}'")
    anew = gold_select("s_orderdetails", "s_orders", "s_customers", "s_employees", "s_offices",
                       where=f"sale.orderdate >= TIMESTAMP '{GOLD_CUTOFF}'")
    with_old_lines = silver_ctes() + [("old_lines", details_sql(
        f"(SELECT * FROM f_orderdetails WHERE extract_at <= '{DETAILS_CUTOFF}')", "f_orders"))]
    q["gold_recompute_late"] = _q(with_old_lines, f"{old} UNION ALL {anew}")
    recomputed = with_old_lines + [("recomputed", f"{old} UNION ALL {anew}")]
    q["bi_quantity_by_country_maintained"] = _q(
        recomputed, "SELECT locality_country, CAST(sum(sales_quantityordered) AS BIGINT) AS total_quantity FROM recomputed GROUP BY locality_country")
    q["bi_quantity_total_maintained"] = _q(
        recomputed, "SELECT CAST(sum(sales_quantityordered) AS BIGINT) AS total_quantity FROM recomputed")
    q["bi_amount_by_territory_city_maintained"] = _q(
        recomputed, "SELECT locality_territory, locality_city, CAST(sum(CAST(sales_amount AS DECIMAL(38,2))) AS DOUBLE) AS total_amount "
        "FROM recomputed GROUP BY locality_territory, locality_city")
    q["bi_quantity_by_country"] = _gold_q(
        "SELECT locality_country, CAST(sum(sales_quantityordered) AS BIGINT) AS total_quantity "
        "FROM gold GROUP BY locality_country")
    q["bi_quantity_total"] = _gold_q(
        "SELECT CAST(sum(sales_quantityordered) AS BIGINT) AS total_quantity FROM gold")
    q["bi_amount_by_territory_city"] = _gold_q(
        "SELECT locality_territory, locality_city, "
        "CAST(sum(CAST(sales_amount AS DECIMAL(38,2))) AS DOUBLE) AS total_amount "
        "FROM gold GROUP BY locality_territory, locality_city")
    q["pipeline_bronze_to_gold"] = _gold_q("SELECT * FROM gold")
    q["stream_gold_sales"] = _gold_q("SELECT * FROM gold")
    q["stream_silver_orders"] = _q(silver_ctes(), "SELECT * FROM s_orders")
    q["stream_silver_orderdetails"] = _q(silver_ctes(), "SELECT * FROM s_orderdetails")
    q["stream_latest_by_key"] = (
        "SELECT * EXCLUDE (_rn) FROM (SELECT *, row_number() OVER (PARTITION BY user_id "
        "ORDER BY ts DESC NULLS LAST, event_id DESC NULLS LAST) AS _rn FROM events) WHERE _rn = 1")
    q["stream_latest_stateful"] = (
        "SELECT e.* FROM events AS e JOIN (SELECT user_id, max((ts, event_id)) AS newest FROM events GROUP BY user_id) AS m "
        "ON e.user_id = m.user_id AND (e.ts, e.event_id) = m.newest")
    return q


ORACLE_SQL = _oracle()
