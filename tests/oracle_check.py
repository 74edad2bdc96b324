"""Run catalogue queries in Spark and their oracle SQL in DuckDB; compare.

Usage: python tests/oracle_check.py [sf_dir] [query ...]

Comparison: same column names, same row count, same multiset of rows (floats
rounded to 6 places, timestamps as ISO text), and compatible column types.
"""

from __future__ import annotations

import datetime as dt
import decimal
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()

SPARK_TO_DUCK = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP WITH TIME ZONE", "boolean": "BOOLEAN",
}


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return v


def _rows(rows, order):
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=repr)


def compare(spark, sf_dir: str, name: str, fn, sql: str | None, con) -> dict:
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_types = [f.dataType.simpleString() for f in sdf.schema.fields]
    s_rows = [tuple(r) for r in sdf.collect()]
    t_spark = time.time() - t0
    res = {"query": name, "spark_rows": len(s_rows), "spark_sec": round(t_spark, 2)}
    if sql is None:
        res["status"] = "rows-only"
        return res
    cur = con.execute(sql)
    d_cols = [c[0] for c in cur.description]
    d_types = [str(c[1]) for c in cur.description]
    d_rows = cur.fetchall()
    res["oracle_rows"] = len(d_rows)
    if sorted(s_cols) != sorted(d_cols):
        res["status"] = f"COLUMNS differ: spark={sorted(s_cols)} oracle={sorted(d_cols)}"
        return res
    names = sorted(s_cols)
    s_idx = [s_cols.index(c) for c in names]
    d_idx = [d_cols.index(c) for c in names]
    type_issues = []
    for c in names:
        st = s_types[s_cols.index(c)]
        dtp = d_types[d_cols.index(c)]
        if SPARK_TO_DUCK.get(st, st) != dtp and not (st.startswith("decimal") and dtp.startswith("DECIMAL")):
            type_issues.append(f"{c}:{st}/{dtp}")
    a, b = _rows(s_rows, s_idx), _rows(d_rows, d_idx)
    if a == b:
        res["status"] = "OK" if not type_issues else f"OK values, types {type_issues}"
    else:
        diff_a = [r for r in a if r not in set(b)][:3]
        diff_b = [r for r in b if r not in set(a)][:3]
        res["status"] = f"VALUES differ: spark-only={diff_a} oracle-only={diff_b}"
    return res


def main(argv: list[str]) -> int:
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    wanted = argv[1:]
    spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
             .config("spark.sql.shuffle.partitions", "8").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    qs, oracle = entry.queries(), entry.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for name in wanted or sorted(qs):
        try:
            r = compare(spark, sf_dir, name, qs[name], oracle.get(name), con)
        except Exception as exc:  # report and go on
            r = {"query": name, "status": f"ERROR {type(exc).__name__}: {str(exc)[:400]}"}
        ok = r["status"].startswith("OK") or r["status"] == "rows-only"
        bad += not ok
        print(("  " if ok else "!!"), r, flush=True)
    print(f"{len(wanted or qs) - bad} ok, {bad} failing")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
