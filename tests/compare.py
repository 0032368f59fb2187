"""Runs registered queries and their SQL side by side and compares columns and rows."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def _key(row):
    return tuple((v is not None, str(type(v)), v if v is not None else 0) if not isinstance(v, float)
                 else (True, "<class 'float'>", v if not math.isnan(v) else 0.0) for v in row)


def rows_of_spark(df):
    columns = sorted(df.columns)
    return columns, sorted((tuple(r) for r in df.select(*[f"`{c}`" for c in columns]).collect()), key=_key)


def rows_of_sql(con, sql):
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted((tuple(r[i] for i in order) for r in result.fetchall()), key=_key)


def difference(df, con, sql) -> str | None:
    """None when equal, else what differs first."""
    spark_columns, spark_rows = rows_of_spark(df)
    sql_columns, sql_rows = rows_of_sql(con, sql)
    if spark_columns != sql_columns:
        return f"columns {spark_columns} != {sql_columns}"
    if len(spark_rows) != len(sql_rows):
        return f"rows {len(spark_rows)} != {len(sql_rows)}; spark {spark_rows[:2]} sql {sql_rows[:2]}"
    for a, b in zip(spark_rows, sql_rows):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            return f"spark {a} != sql {b}"
    return None
