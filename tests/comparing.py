"""Holds a query's rows against its DuckDB SQL."""

from __future__ import annotations

import math
from decimal import Decimal
from pathlib import Path

import duckdb

TESTDATA = Path("/root/testdata")


def connection(sf_dir: Path | str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for table in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {table.stem} AS SELECT * FROM read_parquet('{table}')")
    return con


def plain(value):
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.9g}")
    if isinstance(value, (list, tuple)):
        return tuple(plain(x) for x in value)
    if isinstance(value, dict):
        return tuple((k, plain(v)) for k, v in sorted(value.items()))
    if hasattr(value, "isoformat"):
        return value.isoformat().removesuffix("+00:00")
    return value


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(row[i]) for i in order) for row in rows), key=repr)


def compared(spark, query, sql: str, sf_dir: Path | str) -> tuple[list[str], list[str], list[tuple], list[tuple]]:
    """Sorted column names and sorted rows of both sides."""
    df = query(spark, str(sf_dir))
    ours = rows_of(df.columns, [tuple(r) for r in df.collect()])
    found = connection(sf_dir).execute(sql)
    names = [d[0] for d in found.description]
    return sorted(df.columns), sorted(names), ours, rows_of(names, found.fetchall())
