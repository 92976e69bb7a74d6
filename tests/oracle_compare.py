"""Compare every registered query with its DuckDB oracle (order-insensitive).

Usage: python tests/oracle_compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                 "boolean": "BOOLEAN", "date": "DATE", "float": "FLOAT", "smallint": "SMALLINT"}


# ORACLE_EXACT=1 compares doubles bit for bit instead of to 9 places.
EXACT = os.environ.get("ORACLE_EXACT") == "1"


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return (v if EXACT else round(v, 9)) + 0.0  # -0.0 -> 0.0
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def compare(spark, con, name: str, sf_dir: str, queries, oracle) -> tuple[bool, str]:
    t = time.time()
    sdf = queries[name](spark, sf_dir)
    scols = sdf.columns
    srows = [tuple(r) for r in sdf.collect()]
    st = time.time() - t
    if name not in oracle:
        return True, f"rows-only {len(srows)} rows ({st:.1f}s)"
    res = con.execute(oracle[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    if sorted(scols) != sorted(dcols):
        return False, f"columns differ spark={sorted(scols)} duck={sorted(dcols)}"
    stypes = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
              for f in sdf.schema.fields}
    dtypes = {d[0]: str(d[1]) for d in res.description}
    bad_types = {c: (stypes[c], dtypes[c]) for c in scols if stypes[c] != dtypes[c]}
    if bad_types:
        return False, f"types differ (spark, duck): {bad_types}"
    if len(srows) != len(drows):
        return False, f"row count spark={len(srows)} duck={len(drows)}"
    a, b = _rows(scols, srows), _rows(dcols, drows)
    if a != b:
        for x, y in zip(a, b):
            if x != y:
                return False, f"first diff (cols {sorted(scols)}):\n  spark={x}\n  duck ={y}"
    return True, f"{len(srows)} rows ({st:.1f}s)"


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    from cartwise.session import local_session
    import __spark_entry__ as entry
    spark = local_session(8)
    queries, oracle = entry.queries(), entry.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for name in names or list(queries):
        try:
            ok, msg = compare(spark, con, name, sf_dir, queries, oracle)
        except Exception as e:  # report and continue
            ok, msg = False, f"ERROR {type(e).__name__}: {str(e)[:400]}"
        bad += not ok
        print(f"{'OK ' if ok else 'BAD'} {name}: {msg}", flush=True)
    print(f"{bad} failing")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
