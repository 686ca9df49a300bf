"""Run a query and its SQL side by side. Also a script: python tests/compare.py [folder] [query ...]"""

from __future__ import annotations

import math
import sys
import time
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def duck(folder: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v
    if isinstance(v, Decimal):
        return v
    if isinstance(v, (datetime, date, str, int, bool, type(None))):
        return v
    return str(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(out, key=repr)


def spark_rows(df):
    return rows_of(df.columns, [tuple(r) for r in df.collect()])


def duck_rows(con, sql):
    cur = con.execute(sql)
    return rows_of([d[0] for d in cur.description], cur.fetchall())


def types(df, con, sql):
    """Pairs of column types, to spot a decimal against a double."""
    con.execute(f"CREATE OR REPLACE TEMP VIEW probe AS {sql}")
    found = {r[0]: r[1] for r in con.execute("DESCRIBE probe").fetchall()}
    return {f.name: (f.dataType.simpleString(), found.get(f.name)) for f in df.schema}


def difference(spark, con, build, sql, folder):
    """None if equal, else a short text."""
    df = build(spark, folder)
    got_columns, got = spark_rows(df)
    want_columns, want = duck_rows(con, sql)
    if got_columns != want_columns:
        return f"columns {got_columns} != {want_columns}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    bad = [(g, w) for g, w in zip(got, want) if g != w or [type(x) for x in g] != [type(x) for x in w]]
    if bad:
        g, w = bad[0]
        return f"{len(bad)} rows differ, first: " + str(
            [(c, x, y) for c, x, y in zip(got_columns, g, w) if x != y or type(x) is not type(y)]
        )
    return None


def main(folder: str, *names: str) -> int:
    from conftest import make_spark

    import __spark_entry__ as e

    spark, con = make_spark(), duck(folder)
    sqls, queries, failed = e.oracle_sql(), e.queries(), 0
    for name in names or queries:
        start = time.time()
        if name in sqls:
            found = difference(spark, con, queries[name], sqls[name], folder)
        else:
            found = None
            print(name, queries[name](spark, folder).count(), "rows, no SQL")
        failed += found is not None
        print(f"{name:28s} {time.time() - start:6.2f}s {'ok' if found is None else found[:600]}", flush=True)
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(main(*(sys.argv[1:] or ["/root/testdata/sf0.01"])))
