"""Run a registered query in Spark and its oracle SQL in DuckDB, then compare.

Comparison: row count, column names, and the multiset of rows with columns in
name order (floats rounded to 4 decimals, dates as ISO text).
"""

from __future__ import annotations

import datetime as dt
import decimal
import sys
import time
from collections import Counter

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        return round(v, 4) + 0.0
    if isinstance(v, decimal.Decimal):
        return round(float(v), 4) + 0.0
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), Counter(tuple(_norm(r[i]) for i in order) for r in rows)


def compare(spark, name: str, sf_dir: str, con=None) -> dict:
    import __spark_entry__ as E

    con = con or duck(sf_dir)
    t0 = time.time()
    sdf = E.queries()[name](spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    out = {"name": name, "spark_rows": len(srows), "spark_sec": round(t1 - t0, 2)}
    sql = E.oracle_sql().get(name)
    if sql is None:
        out["oracle"] = "none"
        return out
    cur = con.execute(sql)
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    scols, scount = _rows(sdf.columns, srows)
    ocols_s, ocount = _rows(ocols, orows)
    out["oracle_rows"] = len(orows)
    out["columns_match"] = scols == ocols_s
    out["values_match"] = scount == ocount
    if not out["values_match"]:
        out["only_spark"] = list((scount - ocount).elements())[:5]
        out["only_oracle"] = list((ocount - scount).elements())[:5]
    if not out["columns_match"]:
        out["spark_cols"], out["oracle_cols"] = scols, ocols_s
    return out


if __name__ == "__main__":
    sys.path.insert(0, ".")
    import __spark_entry__ as E
    from strata.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(E.queries())
    spark = local_session(8)
    con = duck(sf)
    bad = 0
    for n in names:
        try:
            r = compare(spark, n, sf, con)
        except Exception as exc:  # report and continue
            r = {"name": n, "error": repr(exc)[:800]}
        ok = r.get("oracle") == "none" or (r.get("columns_match") and r.get("values_match"))
        bad += 0 if ok else 1
        print(("OK  " if ok else "BAD ") + str(r), flush=True)
    print(f"{len(names) - bad}/{len(names)} ok")
