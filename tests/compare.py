"""Compare a registered query with its SQL: names, row count, and values without regard to order."""

import math

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


def _cell(value):
    if value is None or value is pd.NaT or (isinstance(value, float) and math.isnan(value)):
        return "~"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, float):
        return repr(value + 0.0)
    return str(value)


def rows(names: list[str], records) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in records)


def difference(spark_df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when both agree, else what differs first."""
    cursor = con.execute(sql)
    want_names = [d[0] for d in cursor.description]
    want = cursor.fetchall()
    got_names = spark_df.columns
    if sorted(got_names) != sorted(want_names):
        return f"columns {sorted(got_names)} != {sorted(want_names)}"
    got = rows(got_names, [tuple(r) for r in spark_df.collect()])
    want = rows(want_names, want)
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    for a, b in zip(got, want):
        if a != b:
            return f"{a} != {b}"
    return None
