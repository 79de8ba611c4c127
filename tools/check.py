"""Run registered queries and their SQL side by side and report differences.

usage: python tools/check.py [--sf 0.01] [name ...]
"""

from __future__ import annotations

import argparse
import math
import os
import sys
import time
from concurrent.futures import ThreadPoolExecutor

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from terrasheaf.plans import load_all  # noqa: E402
from terrasheaf.plans.registry import BASE, ORACLES, QUERIES  # noqa: E402
from terrasheaf.session import local_session  # noqa: E402


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def norm(v):
        if isinstance(v, float):
            return "nan" if math.isnan(v) else repr(round(v, 6) + 0.0)
        return repr(v)

    return [columns[i] for i in order], sorted(tuple(norm(r[i]) for i in order) for r in rows)


def duck(sf_dir):
    con = duckdb.connect()
    for name in BASE:
        con.sql(f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')")
    return con


def compare(spark, con, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    got_cols, got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if name not in ORACLES:
        return len(got), None, "rows only"
    rel = con.sql(ORACLES[name])
    odd = [f"{c}:{t}" for c, t in zip(rel.columns, rel.types) if "HUGEINT" in str(t) or "DECIMAL" in str(t)]
    want_cols, want = rows_of(rel.columns, rel.fetchall())
    if got_cols != want_cols:
        return len(got), False, f"columns {got_cols} / {want_cols}"
    if odd:
        return len(got), False, f"types {odd}"
    if got != want:
        a, b = set(got), set(want)
        return len(got), False, f"spark {len(got)} duck {len(want)}\n   cols {got_cols}\n   only spark {sorted(a - b)[:3]}\n   only duck  {sorted(b - a)[:3]}"
    return len(got), True, ""


def main():
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="0.01")
    ap.add_argument("--threads", type=int, default=4)
    ap.add_argument("names", nargs="*")
    args = ap.parse_args()
    load_all()
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir = f"/root/testdata/sf{args.sf}"
    con = duck(sf_dir)
    names = args.names or list(QUERIES)
    names = [n for n in QUERIES if any(n == x or (x.endswith("*") and n.startswith(x[:-1])) for x in names)]
    bad = []

    def run(name):
        start = time.time()
        try:
            n, ok, note = compare(spark, con.cursor(), sf_dir, name)
        except Exception as exc:  # report and go on with the next query
            n, ok, note = 0, False, f"{type(exc).__name__}: {str(exc)[:900]}"
        mark = {True: "ok  ", False: "BAD ", None: "rows"}[ok]
        print(f"{mark} {name:26s} {n:8d} rows {time.time() - start:6.2f}s {note}{'   EMPTY' if n == 0 else ''}", flush=True)
        if ok is False:
            bad.append(name)

    with ThreadPoolExecutor(args.threads) as pool:
        list(pool.map(run, names))
    print(f"{len(names)} queries, bad: {bad}")


if __name__ == "__main__":
    main()
