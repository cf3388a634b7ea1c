"""Comparing a catalogue query with its SQL on DuckDB."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    if isinstance(value, float):
        return repr(value + 0.0)
    return str(value) if value is not None else None


def _rows(table) -> tuple[list[str], list[tuple]]:
    names = sorted(table.column_names)
    columns = [[_plain(v) for v in table.column(name).to_pylist()] for name in names]
    rows = list(zip(*columns)) if columns else []
    return names, sorted(rows, key=lambda r: tuple((v is not None, v or "") for v in r))


def _kind(arrow_type) -> str:
    return str(arrow_type).replace("large_", "").split("[")[0]


def difference(spark_df, connection, sql: str) -> str | None:
    """What differs in names, types or values, or None if all agree."""
    mine = spark_df.toArrow()
    theirs = connection.sql(sql).to_arrow_table()
    kinds = [{f.name: _kind(f.type) for f in t.schema} for t in (mine, theirs)]
    if kinds[0] != kinds[1]:
        return f"schema: {kinds[0]} vs {kinds[1]}"
    (_, left), (_, right) = _rows(mine), _rows(theirs)
    if len(left) != len(right):
        return f"rows: {len(left)} vs {len(right)}"
    different = [(a, b) for a, b in zip(left, right) if a != b]
    return f"{len(different)} values differ, first {different[0]}" if different else None
