"""Run a named query on Spark and its oracle on DuckDB, and compare all rows."""

from __future__ import annotations

import math
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')")
    return con


def _normal(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return value if value is None else str(value)


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(str(_normal(r[i])) for i in order) for r in rows)


def _kind(type_name: str) -> str:
    name = type_name.lower()
    for kind, spellings in {
        "long": ("bigint", "long"), "int": ("integer", "int"), "double": ("double",), "string": ("varchar", "string"),
        "boolean": ("boolean",), "timestamp_ntz": ("timestamp", "timestamp_ntz"),
    }.items():
        if name in spellings:
            return kind
    return name


def compare(spark, con, query, sql, folder) -> tuple[list[str], int, float]:
    """Differences found (empty when equal), row count, Spark seconds."""
    start = time.time()
    df = query(spark, folder)
    got = [tuple(r) for r in df.collect()]
    seconds = time.time() - start
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    kinds = {d[0]: _kind(str(d[1])) for d in result.description}
    want = result.fetchall()
    problems = []
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"], len(got), seconds
    for field in df.schema:
        if _kind(field.dataType.simpleString()) != kinds[field.name]:
            problems.append(f"type of {field.name}: {field.dataType.simpleString()} != {kinds[field.name]}")
    if len(got) != len(want):
        problems.append(f"rows {len(got)} != {len(want)}")
    a, b = _rows(df.columns, got), _rows(names, want)
    if a != b:
        diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
        problems.append(f"values differ in {sum(x != y for x, y in zip(a, b))} rows: {diff}")
    return problems, len(got), seconds
