"""Run registered queries in Spark and their oracle SQL in DuckDB and compare
row count, column names and the multiset of rows.

    python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


# Spark type -> DuckDB type name, for the schema part of the check
TYPE_NAMES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "boolean": "BOOLEAN",
              "timestamp_ntz": "TIMESTAMP", "double": "DOUBLE", "timestamp": "TIMESTAMP WITH TIME ZONE"}


def canon(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):
        return "NULL" if v != v else repr(round(v, 9))
    if isinstance(v, decimal.Decimal):
        return format(v.normalize(), "f")
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ", timespec="microseconds")
    return str(v)


def compare(spark, name: str, run, sql: str | None, sf_dir: str, con) -> dict:
    t0 = time.time()
    sdf = run(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(canon(x) for x in r) for r in sdf.collect()]
    t_spark = time.time() - t0
    res = {"name": name, "spark_rows": len(s_rows), "spark_sec": round(t_spark, 2),
           "_plan": sdf._jdf.queryExecution().executedPlan().toString()}
    if sql is None:
        res["status"] = "rows-only"
        return res
    rel = con.sql(sql)
    d_cols = list(rel.columns)
    d_types = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    d_rows = [tuple(canon(x) for x in r) for r in rel.fetchall()]
    res["duck_rows"] = len(d_rows)
    if sorted(s_cols) != sorted(d_cols):
        res["status"] = f"COLUMNS spark={s_cols} duck={d_cols}"
        return res
    s_types = {f.name: TYPE_NAMES.get(f.dataType.simpleString(), f.dataType.simpleString())
               for f in sdf.schema.fields}
    if s_types != d_types:
        res["status"] = f"TYPES spark={s_types} duck={d_types}"
        return res
    order = [d_cols.index(c) for c in sorted(s_cols)]
    s_order = [s_cols.index(c) for c in sorted(s_cols)]
    s_set = sorted(tuple(r[i] for i in s_order) for r in s_rows)
    d_set = sorted(tuple(r[i] for i in order) for r in d_rows)
    if s_set == d_set:
        res["status"] = "OK"
    else:
        only_s = [r for r in s_set if r not in set(d_set)][:3]
        only_d = [r for r in d_set if r not in set(s_set)][:3]
        res["status"] = "VALUES"
        res["cols"] = sorted(s_cols)
        res["only_spark"] = only_s
        res["only_duck"] = only_d
    return res


def main(argv):
    from intake.session import local_session
    import __spark_entry__ as E

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    spark = local_session(8)
    if os.environ.get("ORACLE_TZ"):
        spark.conf.set("spark.sql.session.timeZone", os.environ["ORACLE_TZ"])
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for name, run in qs.items():
        if names and name not in names:
            continue
        try:
            r = compare(spark, name, run, sqls.get(name), sf_dir, con)
        except Exception as e:  # noqa: BLE001
            r = {"name": name, "status": f"ERROR {type(e).__name__}: {str(e)[:400]}"}
        if r["status"] not in ("OK", "rows-only"):
            bad += 1
        r.pop("_plan", None)
        print(r, flush=True)
    print(f"{bad} problems")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
