"""Runs a registered query in Spark and its SQL in DuckDB and compares schema and values."""

from __future__ import annotations

import math

import duckdb

from seqtally.catalog.views import TABLES

KINDS = {"tinyint": "int", "smallint": "int", "int": "int", "bigint": "int", "integer": "int", "double": "float",
         "float": "float", "string": "text", "varchar": "text", "boolean": "bool"}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _cell(x):
    if x is None or (isinstance(x, float) and math.isnan(x)):
        return None
    if isinstance(x, float):
        return round(x, 6) + 0.0
    return x


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    key = lambda r: tuple((c is None, str(type(c)), c if c is not None else 0) for c in r)
    return sorted((tuple(_cell(r[i]) for i in order) for r in rows), key=key)


def compare(spark_df, con, sql: str) -> str | None:
    """A description of the first difference, or None."""
    relation = con.sql(sql)
    theirs = dict(zip(relation.columns, (KINDS.get(str(t).lower(), str(t)) for t in relation.types)))
    ours = {n: KINDS.get(t, t) for n, t in spark_df.dtypes}
    if ours != theirs:
        return f"schema: spark {ours} duckdb {theirs}"
    a = _rows(spark_df.columns, spark_df.collect())
    b = _rows(relation.columns, relation.fetchall())
    if len(a) != len(b):
        return f"rows: spark {len(a)} duckdb {len(b)}"
    if not a:
        return "no rows"
    for x, y in zip(a, b):
        if x != y:
            close = all(p == q or (isinstance(p, float) and isinstance(q, float) and abs(p - q) <= 2e-6)
                        for p, q in zip(x, y))
            return f"{'last-digit ' if close else ''}difference in {sorted(spark_df.columns)}:\n   spark  {x}\n   duckdb {y}"
    return None
