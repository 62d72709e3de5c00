"""Compare a registered query with its oracle on one data directory."""

from __future__ import annotations

import datetime
import decimal
import time

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
          "pages", "benchmark", "labels", "conversations"]


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _cell(value):
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, (int, float, decimal.Decimal)):
        number = float(value)
        return "0.0" if number == 0 else repr(number)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return str(value)


def canonical(columns: list[str], rows) -> list[tuple[str, ...]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def compare(spark, con, build, sql: str, sf_dir: str) -> tuple[bool, str, int]:
    start = time.time()
    df = build(spark, sf_dir)
    ours = canonical(df.columns, df.collect())
    middle = time.time()
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    theirs = canonical(names, result.fetchall())
    timing = f"spark {middle - start:.1f}s oracle {time.time() - middle:.1f}s"
    if sorted(names) != sorted(df.columns):
        return False, f"columns {sorted(df.columns)} vs {sorted(names)}", len(ours)
    if ours == theirs:
        return True, timing, len(ours)
    only_ours = [r for r in ours if r not in set(theirs)][:2]
    only_theirs = [r for r in theirs if r not in set(ours)][:2]
    return False, f"rows {len(ours)} vs {len(theirs)}\n  {sorted(names)}\n  spark only {only_ours}\n  oracle only {only_theirs}", len(ours)
