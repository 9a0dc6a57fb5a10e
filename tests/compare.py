"""Runs registered queries in Spark and DuckDB and compares rows by value.

    python tests/compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import __spark_entry__ as entry  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _cell(x):
    if x is None or (isinstance(x, float) and math.isnan(x)):
        return ""
    if isinstance(x, float):
        return repr(round(x, 6) + 0.0)
    return str(x)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def _kind(type_name: str) -> str:
    t = type_name.lower()
    for kinds, name in ((("int", "long", "short", "huge"), "int"), (("double", "float"), "real"), (("varchar", "string"), "text")):
        if any(k in t for k in kinds):
            return name
    return "time" if "timestamp" in t else t


def compare(spark, con, name: str, sf_dir: str) -> str | None:
    """None when equal, else what differs."""
    df = entry.queries()[name](spark, sf_dir)
    got_cols, got = _rows(df.columns, df.collect())
    rel = con.sql(entry.oracle_sql()[name])
    want_cols, want = _rows(rel.columns, rel.fetchall())
    if got_cols != want_cols:
        return f"columns {sorted(set(got_cols) ^ set(want_cols))}"
    got_types = {f.name: _kind(f.dataType.simpleString()) for f in df.schema.fields}
    want_types = {c: _kind(str(t)) for c, t in zip(rel.columns, rel.types)}
    odd = {c: (got_types[c], want_types[c]) for c in got_types if got_types[c] != want_types[c]}
    if odd:
        return f"types {odd}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    if not got:
        return "no rows"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    if bad:
        g, w = bad[0]
        return f"{len(bad)} of {len(got)} rows: " + str([(c, a, b) for c, a, b in zip(got_cols, g, w) if a != b])
    return None


def main() -> None:
    from roadpulse.session import local_session

    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.001"
    spark, con = local_session(), connect(sf_dir)
    oracle = entry.oracle_sql()
    names = args or list(entry.queries())
    failed = 0
    for name in names:
        t = time.time()
        if name not in oracle:
            print(f"--   {name}: no oracle")
            continue
        try:
            problem = compare(spark, con, name, sf_dir)
        except Exception as exc:  # noqa: BLE001
            problem = f"{type(exc).__name__}: {str(exc)[:700]}"
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - t:.1f}s {problem or ''}", flush=True)
    print(f"{failed} of {len(names)} failed")


if __name__ == "__main__":
    main()
