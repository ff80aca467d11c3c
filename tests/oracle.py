"""Side-by-side run of a catalogue query on Spark and its SQL on DuckDB."""

from __future__ import annotations

import datetime
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return round(value, 9) + 0.0
    if isinstance(value, (datetime.datetime, datetime.date)):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return value


def _kind(arrow_type) -> str:
    text = str(arrow_type)
    return {"large_string": "string", "large_binary": "binary"}.get(text, text)


def rows_and_types(table):
    names = sorted(table.column_names)
    columns = [[_plain(v) for v in table.column(n).to_pylist()] for n in names]
    types = {n: _kind(table.schema.field(n).type) for n in names}
    rows = sorted(zip(*columns), key=repr) if columns else []
    return names, types, rows


def compare(spark_df, con, sql: str) -> list[str]:
    """Differences found; empty where both sides agree."""
    names, types, rows = rows_and_types(spark_df.toArrow())
    want_names, want_types, want_rows = rows_and_types(con.sql(sql).to_arrow_table())
    problems = []
    if names != want_names:
        return [f"columns {names} != {want_names}"]
    for n in names:
        if types[n] != want_types[n]:
            problems.append(f"type of {n}: {types[n]} != {want_types[n]}")
    if len(rows) != len(want_rows):
        problems.append(f"row count {len(rows)} != {len(want_rows)}")
    if rows != want_rows:
        ours, theirs = set(map(repr, rows)), set(map(repr, want_rows))
        problems.append(
            f"values differ: only spark {sorted(ours - theirs)[:3]} only sql {sorted(theirs - ours)[:3]} "
            f"({len(ours - theirs)} / {len(theirs - ours)})"
        )
    if not rows:
        problems.append("no rows")
    return problems
