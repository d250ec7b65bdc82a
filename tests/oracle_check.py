"""Compare every registered query with its DuckDB oracle (row count, columns, values).

Usage: python tests/oracle_check.py [sf_dir] [query ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(v)
    if isinstance(v, (bytes, bytearray)):
        return bytes(v).hex()
    return v


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, sf, names=None):
    from skytrace.plans.oracle import oracle_sql
    from skytrace.plans.registry import queries
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    qs, os_ = queries(), oracle_sql()
    results = {}
    for name in names or list(qs):
        t0 = time.time()
        try:
            df = qs[name](spark, sf)
            cols = df.columns
            got = rows_of(cols, [tuple(r) for r in df.collect()])
            t1 = time.time()
            if name not in os_:
                results[name] = ("rows-only", len(got), round(t1 - t0, 2))
                continue
            rel = con.sql(os_[name])
            ocols = rel.columns
            exp = rows_of(ocols, rel.fetchall())
            ok_cols = sorted(cols) == sorted(ocols)
            ok = ok_cols and got == exp
            results[name] = ("OK" if ok else "MISMATCH", len(got), len(exp), round(t1 - t0, 2))
            if not ok:
                print(name, "cols", sorted(cols), sorted(ocols) if not ok_cols else "")
                bad = [(a, b) for a, b in zip(got, exp) if a != b][:3]
                for a, b in bad:
                    print("  spark ", a)
                    print("  oracle", b)
        except Exception as e:  # keep going
            results[name] = ("ERROR", str(e)[:300])
        print(name, results[name], flush=True)
    return results


if __name__ == "__main__":
    from skytrace.session import local_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8)
    res = compare(spark, sf, sys.argv[2:] or None)
    bad = {k: v for k, v in res.items() if v[0] not in ("OK", "rows-only")}
    print("SUMMARY", len(res) - len(bad), "ok of", len(res), "bad:", sorted(bad))
