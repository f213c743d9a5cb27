"""Run queries beside their SQL on the same tables; ``python -m tests.compare [NAME...]`` prints a line for each."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

import __spark_entry__ as entry

DATA = os.environ.get("LEDGERLAKE_DATA", "/root/testdata")


def oracle_rows(sql: str, folder: str) -> tuple[list[str], list[tuple]]:
    con = duckdb.connect()
    for name in os.listdir(folder):
        path = f"{folder}/{name}" + ("/*.parquet" if os.path.isdir(f"{folder}/{name}") else "")
        con.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM read_parquet('{path}')")
    found = con.execute(sql)
    columns = [d[0] for d in found.description]
    return columns, found.fetchall()


def plain(value: object) -> object:
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    if isinstance(value, (list, tuple)):
        return tuple(map(plain, value))
    return float(value) if type(value).__name__ == "Decimal" else value


def normal(columns: list[str], rows: list[tuple]) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(out, key=lambda r: tuple((v is not None, str(type(v)), str(v)) for v in r))


def difference(spark, name: str, folder: str) -> str:
    """Blank if the query gives the rows of its SQL."""
    df = entry.queries()[name](spark, folder)
    mine = normal(df.columns, [tuple(r) for r in df.collect()])
    theirs = normal(*oracle_rows(entry.oracle_sql()[name], folder))
    if mine[0] != theirs[0]:
        return f"columns {mine[0]} / {theirs[0]}"
    if len(mine[1]) != len(theirs[1]):
        return f"rows {len(mine[1])} / {len(theirs[1])}; first of mine {mine[1][:1]}, of SQL {theirs[1][:1]}"
    return next((f"{a} / {b}" for a, b in zip(mine[1], theirs[1]) if a != b), "")


if __name__ == "__main__":
    from ledgerlake.session import local_session

    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    folder = f"{DATA}/{os.environ.get('SF', 'sf0.01')}"
    for name in sys.argv[1:] or entry.oracle_sql():
        t = time.time()
        try:
            said = difference(spark, name, folder) or "same"
        except Exception as e:  # noqa: BLE001
            said = f"{type(e).__name__} {str(e)[:600]}"
        print(f"{name}: {said} ({time.time() - t:.1f} s)", flush=True)
