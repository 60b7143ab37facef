"""Compare registered queries with their SQL oracles (DuckDB) on one scale.

usage: check.py [sf_dir] [name-prefix ...]
"""

from __future__ import annotations

import math
import sys
import time

import duckdb

from rollspan.catalog import oracle_sql, queries
from rollspan.catalog.registry import TABLES
from rollspan.session import make_session


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def same(a, b) -> bool:
    if isinstance(a, float) and isinstance(b, float):
        return a == b or (math.isnan(a) and math.isnan(b))
    return a == b


def sort_key(row):
    return tuple((v is not None, str(v)) for v in row)


def compare(spark, con, name: str, sf_dir: str) -> str:
    start = time.time()
    df = queries()[name](spark, sf_dir)
    cols = sorted(df.columns)
    got = sorted((tuple(r) for r in df.select(*[f"`{c}`" for c in cols]).collect()), key=sort_key)
    took = time.time() - start
    sql = oracle_sql().get(name)
    if sql is None:
        return f"rows-only rows={len(got)} cols={len(cols)} {took:.1f}s"
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    want_cols = sorted(names)
    if want_cols != cols:
        extra, missing = set(cols) - set(want_cols), set(want_cols) - set(cols)
        return f"FAIL columns: only spark {sorted(extra)[:6]} only sql {sorted(missing)[:6]}"
    order = [names.index(c) for c in cols]
    want = sorted((tuple(r[i] for i in order) for r in rel.fetchall()), key=sort_key)
    if len(got) != len(want):
        return f"FAIL rows {len(got)} vs {len(want)}"
    bad = [(i, c, g[j], w[j]) for i, (g, w) in enumerate(zip(got, want)) for j, c in enumerate(cols) if not same(g[j], w[j])]
    if bad:
        kinds = {c for _, c, _, _ in bad}
        return f"FAIL {len(bad)} values in {len(kinds)} columns e.g. {bad[:4]}"
    types = {c: type(next((r[j] for r in got if r[j] is not None), None)) for j, c in enumerate(cols)}
    types2 = {c: type(next((r[j] for r in want if r[j] is not None), None)) for j, c in enumerate(cols)}
    odd = [c for c in cols if types[c] != types2[c]]
    note = f" TYPES {[(c, types[c].__name__, types2[c].__name__) for c in odd][:4]}" if odd else ""
    return f"ok rows={len(got)} cols={len(cols)} {took:.1f}s{note}"


def main() -> None:
    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and "/" in args[0] else "/root/testdata/sf0.01"
    spark = make_session(master="local[8]", **{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8",
                                               "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failed = 0
    for name in queries():
        if args and not any(name.startswith(a) for a in args):
            continue
        try:
            out = compare(spark, con, name, sf_dir)
        except Exception as e:  # report and go on
            out = f"FAIL {type(e).__name__}: {str(e)[:700]}"
        failed += out.startswith("FAIL")
        print(f"{name:32s} {out}", flush=True)
    print("failed:", failed)


if __name__ == "__main__":
    main()
