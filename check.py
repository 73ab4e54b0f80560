"""Compare registered queries with their SQL twins: ``python check.py [sf_dir] [name-prefix ...]``."""

from __future__ import annotations

import math
import sys
import time

import duckdb

from harmlens.plans import REGISTRY
from harmlens.session import local_session
from harmlens.workspace import clear_scratch

BASE = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
        "labels conversations").split()


def canonical(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, (list, tuple)):
        return tuple(canonical(v) for v in value)
    if isinstance(value, dict):
        return tuple(sorted((k, canonical(v)) for k, v in value.items()))
    return value


def kind(value) -> str:
    return "float" if isinstance(value, float) else "int" if isinstance(value, int) else type(value).__name__


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(canonical(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((v is None, str(v)) for v in r))


def main() -> int:
    args = sys.argv[1:]
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    wanted = args[1:]
    spark = local_session()
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in BASE:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    bad = 0
    for name, q in REGISTRY.items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        start = time.time()
        try:
            df = q.run(spark, sf_dir)
            mine = rows_of(df.columns, [tuple(r) for r in df.collect()])
            took = time.time() - start
            if q.sql is None:
                print(f"rows  {name}: {len(mine)} rows {took:.1f}s", flush=True)
                continue
            cur = con.execute(q.sql)
            names = [d[0] for d in cur.description]
            theirs = rows_of(names, cur.fetchall())
        except Exception as e:  # report and go on
            bad += 1
            print(f"ERROR {name}: {type(e).__name__} {str(e)[:900]}", flush=True)
            continue
        if sorted(names) != sorted(df.columns):
            bad += 1
            print(f"COLS  {name}: {sorted(df.columns)} vs {sorted(names)}", flush=True)
            continue
        if mine != theirs:
            bad += 1
            diff = [(a, b) for a, b in zip(mine, theirs) if a != b][:2]
            print(f"DIFF  {name}: {len(mine)} vs {len(theirs)} rows; {diff}", flush=True)
            continue
        types = [{kind(r[i]) for r in side if r[i] is not None} for side in (mine, theirs) for i in range(len(names))]
        half = len(names)
        if types[:half] != types[half:]:
            print(f"TYPES {name}: {[(n, a, b) for n, a, b in zip(sorted(names), types[:half], types[half:]) if a != b]}", flush=True)
            bad += 1
            continue
        empty = " EMPTY" if not mine else ""
        print(f"ok    {name}: {len(mine)} rows {took:.1f}s{empty}", flush=True)
    clear_scratch(spark)
    print("bad:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
