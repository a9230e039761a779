"""Order-insensitive comparison of a Spark result with the same SQL run by DuckDB."""

from __future__ import annotations

from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def spark_rows(df) -> tuple[list[str], Counter]:
    names = sorted(df.columns)
    return names, Counter(tuple(r) for r in df.select(*[f"`{n}`" for n in names]).collect())


def duck_rows(con, sql: str) -> tuple[list[str], Counter]:
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    rows = Counter(tuple(row[i] for i in order) for row in cursor.fetchall())
    return [columns[i] for i in order], rows


def differences(df, con, sql: str) -> str | None:
    names, mine = spark_rows(df)
    other_names, theirs = duck_rows(con, sql)
    if names != other_names:
        return f"columns {names} != {other_names}"
    if mine == theirs:
        return None
    return (
        f"{sum(mine.values())} rows vs {sum(theirs.values())};"
        f" only Spark: {list((mine - theirs).items())[:3]}"
        f" only SQL: {list((theirs - mine).items())[:3]}"
    )
