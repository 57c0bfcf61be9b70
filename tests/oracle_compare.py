"""Compare registered Spark queries with their DuckDB oracles.

Mirrors the driver's check: columns sorted by name, row count, schema (column
names), and an order-insensitive multiset of normalised values.

    python tests/oracle_compare.py [sf_dir] [query ...]
"""

from __future__ import annotations

import datetime as dt
import sys
import time
from collections import Counter
from decimal import Decimal
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return repr(float(v))
    if isinstance(v, Decimal):
        return repr(float(v))
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (bool,)):
        return str(v)
    if isinstance(v, int):
        return str(v)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return str(v)


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def spark_rows(df):
    cols = sorted(df.columns)
    rows = df.select(*[f"`{c}`" for c in cols]).collect()
    return cols, Counter(tuple(norm(r[i]) for i in range(len(cols))) for r in rows)


def duck_rows(con, sql):
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    data = cur.fetchall()
    order = sorted(range(len(names)), key=lambda i: names[i])
    cols = [names[i] for i in order]
    return cols, Counter(tuple(norm(r[i]) for i in order) for r in data)


def compare(spark, name: str, sf_dir: str, con=None) -> dict:
    import __spark_entry__ as E
    con = con or duck(sf_dir)
    t0 = time.time()
    scols, srows = spark_rows(E.queries()[name](spark, sf_dir))
    t1 = time.time()
    sql = E.oracle_sql().get(name)
    if sql is None:
        return {"query": name, "rows": sum(srows.values()), "oracle": None, "spark_s": t1 - t0}
    dcols, drows = duck_rows(con, sql)
    res = {"query": name, "rows": sum(srows.values()), "oracle_rows": sum(drows.values()),
           "schema_match": scols == dcols, "values_match": srows == drows,
           "spark_s": round(t1 - t0, 2)}
    if scols != dcols:
        res["spark_cols"], res["oracle_cols"] = scols, dcols
    elif srows != drows:
        res["only_spark"] = list((srows - drows).items())[:3]
        res["only_oracle"] = list((drows - srows).items())[:3]
    return res


def main(argv):
    from cashbook.session import get_session
    sf = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    import __spark_entry__ as E
    names = argv[2:] or list(E.queries())
    spark = get_session()
    con = duck(sf)
    bad = 0
    for n in names:
        try:
            r = compare(spark, n, sf, con)
        except Exception as e:  # report and continue
            r = {"query": n, "error": f"{type(e).__name__}: {str(e)[:400]}"}
        ok = r.get("values_match") and r.get("schema_match") and r.get("rows") == r.get("oracle_rows")
        bad += 0 if ok or r.get("oracle", 1) is None else 1
        print(("OK  " if ok else "BAD ") + str(r), flush=True)
    print(f"{len(names) - bad}/{len(names)} ok")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
