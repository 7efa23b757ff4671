"""Side-by-side run of a registered query and its SQL."""

from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        if Path(f"{sf}/{table}.parquet").exists():
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf}/{table}.parquet')")
    return con


def spark_rows(df) -> tuple[list[str], Counter]:
    names = sorted(df.columns)
    return names, Counter(tuple(row) for row in df.select(*[f"`{n}`" for n in names]).collect())


def sql_rows(con, sql: str) -> tuple[list[str], Counter]:
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(row[i] for i in order) for row in result.fetchall())


def difference(df, con, sql: str) -> str | None:
    """Null when both sides agree on names, rows and values; else what differs."""
    left_names, left = spark_rows(df)
    right_names, right = sql_rows(con, sql)
    if left_names != right_names:
        return f"columns: {left_names} != {right_names}"
    if left == right:
        return None if left else "no rows"
    only_left, only_right = left - right, right - left
    return (
        f"{left.total()} rows != {right.total()} rows; only in Spark {only_left.total()}: {list(only_left)[:2]}; "
        f"only in SQL {only_right.total()}: {list(only_right)[:2]}"
    )
