"""Run registered queries against their SQL counterparts in DuckDB.

    python tests/oracle.py [scale] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from catalog.views import DRIVER_TABLES  # noqa: E402


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for table in DRIVER_TABLES:
        con.execute(f"create view {table} as select * from '{folder}/{table}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.9g}"
    if isinstance(value, bool) or value is None:
        return value
    return str(value)


def normal(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr(tuple(_plain(row[i]) for i in order)) for row in rows)


def compare(spark, con, folder: str, build, sql: str) -> tuple[bool, str]:
    df = build(spark, folder)
    mine = normal(df.columns, df.collect())
    result = con.execute(sql)
    columns = [c[0] for c in result.description]
    theirs = normal(columns, result.fetchall())
    if sorted(df.columns) != sorted(columns):
        return False, f"columns {sorted(df.columns)} vs {sorted(columns)}"
    if mine != theirs:
        only_a, only_b = sorted(set(mine) - set(theirs)), sorted(set(theirs) - set(mine))
        return False, f"{len(mine)} vs {len(theirs)} rows\n   spark {only_a[:2]}\n   duck  {only_b[:2]}"
    return True, f"{len(mine)} rows"


def main(scale: str, names: list[str]) -> None:
    import __spark_entry__ as entry
    from clinspark.session import local_session

    folder = f"/root/testdata/sf{scale}"
    spark, con = local_session("8", 8), duck(folder)
    queries, oracles = entry.queries(), entry.oracle_sql()
    failed = 0
    for name in names or queries:
        begin = time.time()
        try:
            if name in oracles:
                ok, note = compare(spark, con, folder, queries[name], oracles[name])
            else:
                ok, note = True, f"{queries[name](spark, folder).count()} rows, no SQL"
        except Exception as error:  # report and go on with the next query
            ok, note = False, str(error)[:900]
        failed += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name}: {note} ({time.time() - begin:.1f} s)", flush=True)
    print(f"{failed} failed")


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "0.01", sys.argv[2:])
