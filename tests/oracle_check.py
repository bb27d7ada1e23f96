"""Run catalog queries against their DuckDB oracles, like the driver's check.

    python tests/oracle_check.py [sf_dir] [name ...]

Prints one line per query: rows on each side, schema match, value match.
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, os.path.dirname(HERE))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET enable_progress_bar = false")
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6) + 0.0
    return v


def _coarse(row):
    return tuple(round(v, 3) if isinstance(v, float) else v for v in row)


def _near(a, b, tol=2e-6):
    """Equal up to ``tol`` on floats (rounding ties at the 6th decimal)."""
    if len(a) != len(b):
        return False
    a, b = sorted(a, key=lambda r: repr(_coarse(r))), sorted(b, key=lambda r: repr(_coarse(r)))
    for x, y in zip(a, b):
        for u, v in zip(x, y):
            if isinstance(u, float) and isinstance(v, float):
                if abs(u - v) > tol:
                    return False
            elif u != v:
                return False
    return True


def rows_of(records, cols):
    return sorted((tuple(_norm(r[c]) for c in cols) for r in records), key=repr)


def compare(spark, name, fn, sql, sf_dir, con):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = sorted(sdf.columns)
    s_rows = [r.asDict() for r in sdf.collect()]
    t1 = time.time()
    rel = con.sql(sql)
    d_cols = sorted(rel.columns)
    d_rows = [dict(zip(rel.columns, r)) for r in rel.fetchall()]
    t2 = time.time()
    schema_ok = s_cols == d_cols
    values_ok = schema_ok and rows_of(s_rows, s_cols) == rows_of(d_rows, d_cols)
    near = values_ok or (schema_ok and _near(rows_of(s_rows, s_cols), rows_of(d_rows, d_cols)))
    detail = ""
    if not schema_ok:
        detail = f" only-spark={sorted(set(s_cols) - set(d_cols))[:5]} only-sql={sorted(set(d_cols) - set(s_cols))[:5]}"
    elif not values_ok:
        a, b = rows_of(s_rows, s_cols), rows_of(d_rows, d_cols)
        bad = [c for i, c in enumerate(s_cols) if sorted(map(repr, (r[i] for r in a))) != sorted(map(repr, (r[i] for r in b)))]
        detail = f" differing-columns={bad[:6]}"
        if bad:
            i = s_cols.index(bad[0])
            sa = sorted(map(repr, (r[i] for r in a)))
            sb = sorted(map(repr, (r[i] for r in b)))
            diff = [(x, y) for x, y in zip(sa, sb) if x != y][:3]
            detail += f" e.g. {diff}"
    print(f"{name:28s} rows {len(s_rows):6d}/{len(d_rows):6d} schema={'ok' if schema_ok else 'BAD'} "
          f"values={'ok' if values_ok else ('TIE' if near else 'BAD')} spark={t1 - t0:5.1f}s sql={t2 - t1:5.1f}s{detail}", flush=True)
    return values_ok or ("tie" if near else False)


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = set(sys.argv[2:])
    import __spark_entry__ as entry
    from riskfeat.session import get_spark
    spark = get_spark("local[8]", 8)
    qs, oracles = entry.queries(), entry.oracle_sql()
    con = duck(sf_dir)
    bad = []
    for name, fn in qs.items():
        if only and name not in only:
            continue
        try:
            if name not in oracles:
                t0 = time.time()
                n = fn(spark, sf_dir).count()
                print(f"{name:28s} rows {n:6d} (no oracle) {time.time() - t0:5.1f}s", flush=True)
                continue
            if compare(spark, name, fn, oracles[name], sf_dir, con) is False:
                bad.append(name)
        except Exception as e:  # report and go on
            print(f"{name:28s} ERROR {type(e).__name__}: {str(e)[:400]}", flush=True)
            bad.append(name)
    print("FAILED:", bad if bad else "none")


if __name__ == "__main__":
    main()
