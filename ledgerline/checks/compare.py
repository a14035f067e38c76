"""Run registered queries in Spark and their oracle SQL in DuckDB; compare.

    python -m ledgerline.checks.compare /root/testdata/sf0.01 [name ...]

Compares row count, column names, and the order-insensitive multiset of rows
with values normalised (decimals/floats rounded, instants as ISO text).
"""

from __future__ import annotations

import datetime as dt
import decimal
import sys
import time
from collections import Counter

CARRIERS = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
            "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, (decimal.Decimal, float)):
        return round(float(v), 4)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def duck_connect(sf_dir: str):
    import os

    import duckdb
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in CARRIERS:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"create view {t} as select * from read_parquet('{path}')")
    return con


def compare(spark, sf_dir: str, names=None, verbose=True) -> dict:
    from ..registry import oracle_sql, queries

    qs, os_ = queries(), oracle_sql()
    con = duck_connect(sf_dir)
    report = {}
    for name in (names or list(qs)):
        t0 = time.time()
        try:
            df = qs[name](spark, sf_dir)
            s_cols = df.columns
            s_rows = [tuple(norm(x) for x in r) for r in df.collect()]
        except Exception as e:  # noqa: BLE001
            report[name] = {"ok": False, "error": f"spark: {type(e).__name__}: {str(e)[:300]}"}
            if verbose:
                print(name, report[name], flush=True)
            continue
        t1 = time.time()
        if name not in os_:
            report[name] = {"ok": None, "rows": len(s_rows), "note": "no oracle"}
            if verbose:
                print(name, report[name], flush=True)
            continue
        try:
            cur = con.execute(os_[name])
            d_cols = [c[0] for c in cur.description]
            d_rows = [tuple(norm(x) for x in r) for r in cur.fetchall()]
        except Exception as e:  # noqa: BLE001
            report[name] = {"ok": False, "error": f"duckdb: {type(e).__name__}: {str(e)[:300]}"}
            if verbose:
                print(name, report[name], flush=True)
            continue
        res = {"rows": (len(s_rows), len(d_rows)), "spark_s": round(t1 - t0, 2)}
        if sorted(s_cols) != sorted(d_cols):
            res["ok"] = False
            res["cols"] = {"spark_only": sorted(set(s_cols) - set(d_cols)),
                           "duck_only": sorted(set(d_cols) - set(s_cols))}
        else:
            order = sorted(range(len(s_cols)), key=lambda i: s_cols[i])
            dorder = [d_cols.index(s_cols[i]) for i in order]
            sc = Counter(tuple(r[i] for i in order) for r in s_rows)
            dc = Counter(tuple(r[i] for i in dorder) for r in d_rows)
            res["ok"] = sc == dc
            if not res["ok"]:
                names_sorted = [s_cols[i] for i in order]
                diff_cols = set()
                only_s = list((sc - dc).elements())[:200]
                only_d = list((dc - sc).elements())[:200]
                for a, b in zip(only_s, only_d):
                    for k, (x, y) in enumerate(zip(a, b)):
                        if x != y:
                            diff_cols.add(names_sorted[k])
                res["diff_cols"] = sorted(diff_cols)[:10]
                if only_s and only_d:
                    k = names_sorted.index(res["diff_cols"][0]) if res["diff_cols"] else 0
                    res["example"] = (only_s[0][k], only_d[0][k])
        report[name] = res
        if verbose:
            print(name, res, flush=True)
    return report


if __name__ == "__main__":
    from ..session import get_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or None
    spark = get_session()
    rep = compare(spark, sf, names)
    bad = [k for k, v in rep.items() if v.get("ok") is False]
    print("FAILED:", bad)
    print(f"{sum(1 for v in rep.values() if v.get('ok'))}/{len(rep)} match")
