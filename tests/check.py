"""Run registered queries next to their SQL: ``python tests/check.py [--sf DIR] [names...]``."""

from __future__ import annotations

import argparse
import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb  # noqa: E402

import __spark_entry__ as entry  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    return str(value) if value is not None else None


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(([_plain(r[i]) for i in order] for r in rows), key=repr)


def duck(sf: str):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf}/{table}.parquet')")
    return con


def compare(spark, con, name: str, sf: str) -> str:
    started = time.perf_counter()
    df = entry.queries()[name](spark, sf)
    columns, got = rows_of(df.columns, df.collect())
    took = time.perf_counter() - started
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return f"rows  {name}: {len(got)} rows, {took:.2f}s"
    started = time.perf_counter()
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    names, wanted = rows_of(names, result.fetchall())
    duck_took = time.perf_counter() - started
    verdict = "ok   " if (columns, got) == (names, wanted) else "FAIL "
    line = f"{verdict} {name}: {len(got)} rows vs {len(wanted)}, {took:.2f}s (sql {duck_took:.2f}s)"
    if verdict == "FAIL ":
        if columns != names:
            line += f"\n   columns {columns} vs {names}"
        ours, theirs = set(map(repr, got)), set(map(repr, wanted))
        line += f"\n   only spark {str(sorted(ours - theirs)[:2])[:600]}\n   only sql {str(sorted(theirs - ours)[:2])[:600]}"
    return line


def main() -> None:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    from conftest import session

    spark, con = session(), duck(args.sf)
    for name in args.names or entry.queries():
        try:
            print(compare(spark, con, name, args.sf), flush=True)
        except Exception as error:  # report and go on with the next query
            print(f"ERROR {name}: {type(error).__name__} {str(error)[:600]}", flush=True)


if __name__ == "__main__":
    main()
