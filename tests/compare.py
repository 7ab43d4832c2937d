"""Compare registered queries with their SQL over the same tables.

``python -m tests.compare [--sf 0.01] [name ...]``
"""

from __future__ import annotations

import argparse
import glob
import math
import os
import time

import duckdb

from oracles import SQL
from tidelog.catalog import QUERIES

DATA = "/root/testdata"


def duck(sf_dir: str):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return repr(value)


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in data)


def differences(spark, con, sf_dir: str, name: str) -> list[str]:
    df = QUERIES[name](spark, sf_dir)
    mine = rows(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(SQL[name])
    columns = [d[0] for d in cursor.description]
    theirs = rows(columns, cursor.fetchall())
    found = []
    if sorted(df.columns) != sorted(columns):
        found.append(f"columns {sorted(df.columns)} and {sorted(columns)}")
    if len(mine) != len(theirs):
        found.append(f"{len(mine)} rows and {len(theirs)}")
    only_mine = sorted(set(mine) - set(theirs))[:3]
    only_theirs = sorted(set(theirs) - set(mine))[:3]
    if only_mine or only_theirs or mine != theirs:
        found.append(f"rows differ: {only_mine} / {only_theirs}")
    return found


def main():
    from tests.conftest import session

    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    spark, sf_dir = session(), f"{DATA}/sf{args.sf}"
    con = duck(sf_dir)
    for name in args.names or QUERIES:
        start = time.time()
        if name not in SQL:
            print(f"{name}: {QUERIES[name](spark, sf_dir).count()} rows, no SQL")
            continue
        found = differences(spark, con, sf_dir, name)
        count = con.execute(f"SELECT count(*) FROM ({SQL[name]})").fetchall()[0][0]
        print(
            f"{name}: {'; '.join(found) or 'equal'} ({count} rows, {time.time() - start:.1f}s)",
            flush=True,
        )


if __name__ == "__main__":
    main()
