"""Run registered queries against their SQL twins: python tests/compare.py [folder] [name-prefix ...]"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(folder: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def _cell(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, float):
        return None if math.isnan(v) else v
    return v


def _key(row):
    return tuple((v is None, type(v).__name__ if not isinstance(v, (int, float)) else "n",
                  0 if v is None else (round(v, 4) if isinstance(v, float) else v)) for v in row)


def differences(columns_a, rows_a, columns_b, rows_b, tolerance=1e-9) -> str | None:
    if sorted(columns_a) != sorted(columns_b):
        return f"columns {sorted(columns_a)} vs {sorted(columns_b)}"
    names = sorted(columns_a)
    ia, ib = [columns_a.index(n) for n in names], [columns_b.index(n) for n in names]
    a = sorted((tuple(_cell(r[i]) for i in ia) for r in rows_a), key=_key)
    b = sorted((tuple(_cell(r[i]) for i in ib) for r in rows_b), key=_key)
    if len(a) != len(b):
        return f"{len(a)} rows vs {len(b)}"
    for x, y in zip(a, b):
        for n, u, v in zip(names, x, y):
            if type(u) is not type(v) and not (u is None and v is None):
                return f"{n}: {u!r} vs {v!r} (types)"
            same = u == v or (isinstance(u, float) and math.isclose(u, v, rel_tol=tolerance, abs_tol=tolerance))
            if not same:
                return f"{n}: {u!r} vs {v!r} in {dict(zip(names, x))} / {dict(zip(names, y))}"
    return None


def main(folder: str, prefixes: list[str]) -> int:
    import __spark_entry__ as entry
    from tillwise.session import get_session

    spark = get_session("compare", master="local[8]", partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    run, sql = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, fn in run.items():
        if prefixes and not any(name.startswith(p) for p in prefixes):
            continue
        start = time.time()
        try:
            df = fn(spark, folder)
            rows = df.collect()
            took = time.time() - start
            if name in sql:
                res = con.execute(sql[name])
                cols = [d[0] for d in res.description]
                diff = differences(df.columns, rows, cols, res.fetchall())
            else:
                diff = None if rows else "no rows"
            label = "ok  " if diff is None else "DIFF"
            if name not in sql:
                label += " (rows only)"
            bad += diff is not None
            print(f"{label} {name} {len(rows)} rows {took:.1f}s {diff or ''}", flush=True)
        except Exception as e:  # report and go on with the other queries
            bad += 1
            print(f"FAIL {name} {time.time() - start:.1f}s {type(e).__name__}: {str(e)[:600]}", flush=True)
    print(f"{bad} bad")
    return bad


if __name__ == "__main__":
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    sys.exit(1 if main(folder, sys.argv[2:]) else 0)
