"""Run queries in Spark and their SQL in DuckDB on the same files and compare.

    python tests/oracle.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, (int, float)):
        return f"{float(v):.6g}" if abs(v) < 1e15 else f"{float(v):.9g}"
    if isinstance(v, dt.datetime):
        return v.isoformat()
    if isinstance(v, dt.date):
        return dt.datetime(v.year, v.month, v.day).isoformat()
    return str(v)


def norm_exact(v):
    if isinstance(v, float) and not math.isnan(v):
        return repr(v + 0.0)
    if isinstance(v, int) and not isinstance(v, bool):
        return repr(float(v))
    return norm(v)


def compare(df, con, sql: str) -> str:
    """'' if equal, else what differs."""
    columns = sorted(df.columns)
    rows = df.select(*[f"`{c}`" for c in columns]).collect()
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    if sorted(names) != columns:
        return f"columns {columns} != {sorted(names)}"
    order = [names.index(c) for c in columns]
    other = [tuple(r[i] for i in order) for r in cur.fetchall()]
    if len(rows) != len(other):
        return f"rows {len(rows)} != {len(other)}"
    key = lambda r: tuple((v is not None, norm(v) or "") for v in r)
    a, b = sorted(rows, key=key), sorted(other, key=key)
    for x, y in zip(a, b):
        if [norm(v) for v in x] != [norm(v) for v in y]:
            bad = [(c, p, q) for c, p, q in zip(columns, x, y) if norm(p) != norm(q)]
            return f"values {bad[:3]} in {dict(zip(columns, x))}"[:700]
    inexact = sum([norm_exact(v) for v in x] != [norm_exact(v) for v in y] for x, y in zip(a, b))
    return f"~{inexact} rows differ in the last bits" if inexact else ""


def main() -> int:
    from ordermill.session import get_session

    from __spark_entry__ import oracle_sql, queries

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_session(master="local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false", spark__ui__showConsoleProgress="false", spark__driver__memory="6g")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    qs, sql = queries(), oracle_sql()
    wanted = sys.argv[2:] or list(qs)
    failed = 0
    for name in wanted:
        start = time.time()
        try:
            df = qs[name](spark, sf_dir)
            if name in sql:
                diff = compare(df, con, sql[name])
                state = "ok" if not diff else diff if diff.startswith("~") else "DIFF " + diff
            else:
                state = f"rows only: {df.count()}"
        except Exception as e:  # report and go on
            state = "ERROR " + " ".join(str(e).split())[:500]
        failed += state.startswith(("DIFF", "ERROR"))
        print(f"{name:32s} {time.time() - start:6.2f}s {state}", flush=True)
    print(f"{len(wanted)} queries, {failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(main())
