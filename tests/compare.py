"""Run registered queries next to their SQL and compare the rows.

python -m tests.compare /root/testdata/sf0.01 [name prefix ...]
"""

from __future__ import annotations

import math
import sys
import time
import traceback

import duckdb

from sparrowmill.tables import TABLES


# Spark type name: SQL type name
KINDS = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP"}


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def canon(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return float(f"{v:.9g}") + 0.0
    if isinstance(v, (list, tuple)):
        return tuple(canon(x) for x in v)
    if hasattr(v, "tolist"):
        return canon(v.tolist())
    if isinstance(v, (bytes, bytearray)):
        return bytes(v)
    if hasattr(v, "asDict"):
        return canon(list(v.asDict().values()))
    if isinstance(v, dict):
        return canon(sorted(v.items()))
    return v


def rows_of(cols, rows):
    idx = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(canon(r[i]) for i in idx) for r in rows), key=repr)


def compare(spark, con, fn, sql, sf_dir):
    df = fn(spark, sf_dir)
    got = df.collect()
    cols = df.columns
    if sql is None:
        return len(got), None
    cur = con.execute(sql)
    want_cols = [d[0] for d in cur.description]
    want = cur.fetchall()
    if sorted(cols) != sorted(want_cols):
        return len(got), f"columns {sorted(cols)} vs {sorted(want_cols)}"
    if len(got) != len(want):
        return len(got), f"rows {len(got)} vs {len(want)}"
    a, b = rows_of(cols, [tuple(r) for r in got]), rows_of(want_cols, want)
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        return len(got), f"{len(bad)} of {len(a)} rows differ, e.g. {str(bad[0][0])[:300]} vs {str(bad[0][1])[:300]}"
    types = {f.name: KINDS.get(f.dataType.simpleString(), f.dataType.simpleString().upper()) for f in df.schema.fields}
    for name, d in zip(want_cols, cur.description):
        if str(d[1]) != types[name]:
            return len(got), f"type of {name}: {d[1]} vs {types[name]}"
    return len(got), None


def main(argv):
    from sparrowmill.plans import load_all
    from sparrowmill.plans.registry import ORACLES, QUERIES
    from sparrowmill.session import local_session

    only = [a[2:] for a in argv if a.startswith("g=")]
    load_all(only) if only else load_all()
    argv = [a for a in argv if not a.startswith("g=")]
    sf_dir, prefixes = argv[0], argv[1:]
    spark, con = local_session(), connect(sf_dir)
    bad = 0
    for name, fn in QUERIES.items():
        if prefixes and not any(name.startswith(p) for p in prefixes):
            continue
        t = time.time()
        try:
            n, err = compare(spark, con, fn, ORACLES.get(name), sf_dir)
        except Exception as e:
            n, err = -1, f"{type(e).__name__}: {str(e)[:600]}"
            if "-v" in sys.argv:
                traceback.print_exc()
        bad += err is not None
        state = "FAIL" if err else ("ok" if name in ORACLES else "rows")
        print(f"{state:5}{name:34}{n:8} rows {time.time() - t:6.2f}s {err or ''}", flush=True)
    print("failures:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main([a for a in sys.argv[1:] if a != "-v"]) else 0)
