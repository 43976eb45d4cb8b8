"""Compare registered queries with their SQL, run by DuckDB on the same files."""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.9g}")
    if hasattr(v, "isoformat"):
        return str(v)[:26]
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "tolist"):
        return _norm(v.tolist())
    return v


def compare(spark, name: str, fn, sql: str, sf_dir: str) -> str | None:
    """None when equal, else what differs."""
    df = fn(spark, sf_dir)
    got_cols = df.columns
    got = [tuple(r) for r in df.collect()]
    con = connect(sf_dir)
    cur = con.execute(sql)
    want_cols = [c[0] for c in cur.description]
    want = cur.fetchall()
    if sorted(got_cols) != sorted(want_cols):
        return f"{name}: columns {got_cols} / {want_cols}"
    order = sorted(got_cols)
    gi, wi = [got_cols.index(c) for c in order], [want_cols.index(c) for c in order]
    a = sorted(([_norm(r[i]) for i in gi] for r in got), key=repr)
    b = sorted(([_norm(r[i]) for i in wi] for r in want), key=repr)
    if len(a) != len(b):
        sa, sb = {repr(x) for x in a}, {repr(x) for x in b}
        only = sorted(sa - sb)[:1], sorted(sb - sa)[:1]
        return f"{name}: rows {len(a)} / {len(b)} {str(only)[:600]}"
    for x, y in zip(a, b):
        if repr(x) != repr(y):
            return f"{name}: {order} first difference\n   spark {str(x)[:500]}\n   sql   {str(y)[:500]}"
    if not a:
        return f"{name}: both empty"
    return None


if __name__ == "__main__":
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry
    from docweave.session import build_session

    sf = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    wanted = sys.argv[1:]
    session = build_session(master="local[8]", spark__sql__shuffle__partitions=8, spark__driver__memory="8g", spark__ui__enabled="false", spark__ui__showConsoleProgress="false")
    session.sparkContext.setLogLevel("ERROR")
    fns, sqls = entry.queries(), entry.oracle_sql()
    bad = 0
    for key in fns:
        if wanted and not any(w in key for w in wanted):
            continue
        t = time.time()
        try:
            if key in sqls:
                problem = compare(session, key, fns[key], sqls[key], sf)
            else:
                n = len(fns[key](session, sf).collect())
                problem = None if n else f"{key}: no rows"
        except Exception as e:  # report and go on with the next query
            problem = f"{key}: {type(e).__name__} {str(e)[:700]}"
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {key} {time.time() - t:.1f}s{'' if key in sqls else ' (rows only)'}", flush=True)
        if problem:
            print("   ", problem, flush=True)
    print("bad:", bad)
