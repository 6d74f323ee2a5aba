"""Run registered Spark queries and their DuckDB oracle side by side.

Compares row count, column names and an order-insensitive hash of the
values (columns sorted by name). Usable from pytest and as a script:

    python tests/oracle_check.py /root/testdata/sf0.01 [query ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"create view {t} as select * from read_parquet('{p}')")
    return con


def _norm(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NULL"
        return f"{v:.9g}"
    if isinstance(v, decimal.Decimal):
        return f"{float(v):.9g}"
    if isinstance(v, bool):
        return "T" if v else "F"
    if isinstance(v, dt.datetime):
        if v.tzinfo is not None:
            v = v.astimezone(dt.timezone.utc).replace(tzinfo=None)
        return v.isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    if hasattr(v, "item"):  # numpy scalar
        return _norm(v.item())
    return str(v)


def table_hash(cols: list[str], rows: list[tuple]) -> tuple[int, list[str], str]:
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    h = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return len(rows), sorted(cols), h


def spark_rows(df):
    return df.columns, [tuple(r) for r in df.collect()]


def duck_rows(con, sql):
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    return cols, cur.fetchall()


def compare(spark, name: str, sf_dir: str, con=None) -> dict:
    import __spark_entry__ as E

    con = con or duck(sf_dir)
    t0 = time.time()
    s_cols, s_rows = spark_rows(E.queries()[name](spark, sf_dir))
    t1 = time.time()
    d_cols, d_rows = duck_rows(con, E.oracle_sql()[name])
    t2 = time.time()
    sn, sc, sh = table_hash(s_cols, s_rows)
    dn, dc, dh = table_hash(d_cols, d_rows)
    return {"name": name, "rows": (sn, dn), "cols_match": sc == dc, "cols": (sc, dc),
            "hash_match": sh == dh, "ok": sn == dn and sc == dc and sh == dh,
            "spark_s": round(t1 - t0, 2), "duck_s": round(t2 - t1, 2),
            "_s": (s_cols, s_rows), "_d": (d_cols, d_rows)}


def diff_rows(res: dict, limit: int = 5) -> None:
    s_cols, s_rows = res["_s"]
    d_cols, d_rows = res["_d"]
    so = sorted(range(len(s_cols)), key=lambda i: s_cols[i])
    do = sorted(range(len(d_cols)), key=lambda i: d_cols[i])
    ss = {"|".join(_norm(r[i]) for i in so) for r in s_rows}
    dd = {"|".join(_norm(r[i]) for i in do) for r in d_rows}
    print("  cols:", [s_cols[i] for i in so])
    for x in sorted(ss - dd)[:limit]:
        print("  spark only:", x)
    for x in sorted(dd - ss)[:limit]:
        print("  duck  only:", x)


if __name__ == "__main__":
    from rankforge.session import get_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_session("local[8]", 8, extra={"spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    import __spark_entry__ as E

    names = sys.argv[2:] or [n for n in E.queries() if n != "quality_summary"]
    con = duck(sf)
    bad = 0
    for n in names:
        try:
            r = compare(spark, n, sf, con)
        except Exception as e:  # report and continue
            print(f"ERROR {n}: {type(e).__name__}: {str(e)[:600]}")
            bad += 1
            continue
        print(f"{'OK ' if r['ok'] else 'BAD'} {n:32s} rows={r['rows']} cols={r['cols_match']} "
              f"hash={r['hash_match']} spark={r['spark_s']}s duck={r['duck_s']}s")
        if not r["ok"]:
            bad += 1
            if not r["cols_match"]:
                print("  ", r["cols"])
            diff_rows(r)
    print("FAILED" if bad else "ALL OK", bad)
