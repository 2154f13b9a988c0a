"""Run every registered query in Spark and its oracle statement in DuckDB on
the same parquet tables, and compare row count, column names, value kinds and
values (order-insensitive, exact).

usage: python tools/oracle_check.py [sf_dir] [name-substring ...]
"""

from __future__ import annotations

import datetime
import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

import duckdb  # noqa: E402

from riskloom.session import build_session  # noqa: E402
from riskloom.sources.tables import TABLES, table_path  # noqa: E402


def _norm(v):
    if v is None:
        return ("null",)
    if isinstance(v, bool):
        return ("bool", v)
    if isinstance(v, int):
        return ("int", v)
    if isinstance(v, float):
        if math.isnan(v):
            return ("null",)
        return ("float", v)
    if isinstance(v, (datetime.datetime, datetime.date)):
        return ("ts", v.isoformat())
    if isinstance(v, (list, tuple)):
        return ("list", tuple(_norm(x) for x in v))
    if isinstance(v, dict):
        return ("map", tuple(sorted((str(k), _norm(x)) for k, x in v.items())))
    if hasattr(v, "asDict"):
        return ("row", tuple(_norm(x) for x in v))
    import decimal
    if isinstance(v, decimal.Decimal):
        return ("decimal", str(v))
    return ("str", str(v))


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=repr)


def duck_con(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        p = table_path(sf_dir, t)
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def check(spark, con, name, entry, sf_dir, verbose=True):
    t0 = time.time()
    df = entry.fn(spark, sf_dir)
    srows = df.collect()
    scols = df.columns
    ts = time.time() - t0
    if entry.sql is None:
        return ("rows-only", len(srows), ts)
    res = con.execute(entry.sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    if sorted(scols) != sorted(dcols):
        return ("COLS", f"spark={sorted(scols)} duck={sorted(dcols)}", ts)
    if len(srows) != len(drows):
        return ("COUNT", f"spark={len(srows)} duck={len(drows)}", ts)
    a, b = _rows(scols, srows), _rows(dcols, drows)
    if a == b:
        return ("OK", len(srows), ts)
    cs = sorted(scols)
    diffs = []
    for x, y in zip(a, b):
        if x != y:
            for i, (u, v) in enumerate(zip(x, y)):
                if u != v:
                    diffs.append((cs[i], u, v))
            if len(diffs) > 6:
                break
    return ("VALUES", diffs[:6], ts)


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    pats = [a for a in argv[1:] if not a.startswith("/")]
    from riskloom.plans.catalog import load_all
    cat = load_all()
    spark = build_session("local[8]", 8)
    con = duck_con(sf_dir)
    bad = 0
    for name, e in cat.items():
        if pats and not any(p in name for p in pats):
            continue
        try:
            st, info, ts = check(spark, con, name, e, sf_dir)
        except Exception as ex:  # report and go on
            st, info, ts = "ERROR", repr(ex)[:600], 0.0
        if st not in ("OK", "rows-only"):
            bad += 1
        print(f"{st:9s} {name:32s} {ts:6.2f}s {info}", flush=True)
    print(f"mismatches/errors: {bad}")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
