"""Run checked queries against their SQL form in DuckDB: python tests/compare.py [sf] [name ...]"""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import time
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
TESTDATA = Path("/root/testdata")


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, datetime.datetime):
        return value.date().isoformat() if value.time() == datetime.time() else value.isoformat()
    if isinstance(value, datetime.date):
        return value.isoformat()
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    return value


def sort_key(row):
    return tuple((v is None, str(type(v)), v if v is not None else 0) for v in row)


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(plain(r[i]) for i in order) for r in rows]
    return sorted(columns), sorted(out, key=sort_key)


def differences(spark, con, build, sql, sf_dir, limit=3):
    df = build(spark, sf_dir)
    ours = normal(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    names = [c[0] for c in cur.description]
    theirs = normal(names, cur.fetchall())
    problems = []
    if ours[0] != theirs[0]:
        problems.append(f"columns {ours[0]} != {theirs[0]}")
    if len(ours[1]) != len(theirs[1]):
        problems.append(f"rows {len(ours[1])} != {len(theirs[1])}")
    bad = [(a, b) for a, b in zip(ours[1], theirs[1]) if a != b]
    if bad:
        problems.append(f"{len(bad)} rows differ, e.g. " + "; ".join(f"{a} vs {b}" for a, b in bad[:limit]))
    return problems, len(ours[1])


if __name__ == "__main__":
    sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
    from pulsepanel.plans.checked import REGISTRY
    from pulsepanel.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.001"
    chosen = sys.argv[2:] or list(REGISTRY)
    sf_dir = str(TESTDATA / f"sf{sf}")
    spark, con = local_session(), connect(sf_dir)
    failed = []
    for name in chosen:
        q = REGISTRY[name]
        start = time.time()
        try:
            problems, n = differences(spark, con, q.build, q.sql, sf_dir)
        except Exception as e:  # noqa: BLE001
            problems, n = [f"{type(e).__name__}: {str(e)[:700]}"], -1
        print(f"{'ok  ' if not problems else 'FAIL'} {name} rows={n} {time.time() - start:.1f}s", *problems, flush=True)
        if problems:
            failed.append(name)
    print(len(chosen) - len(failed), "ok;", len(failed), "failed:", " ".join(failed))
