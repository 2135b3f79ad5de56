"""Run a registered query and its SQL counterpart and compare their rows."""

from __future__ import annotations

import os
from collections import Counter

import duckdb
from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = f"{sf_dir}/{name}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def spark_rows(df: DataFrame) -> tuple[list[str], Counter]:
    names = sorted(df.columns)
    return names, Counter(tuple(row[n] for n in names) for row in df.select(*names).collect())


def sql_rows(con: duckdb.DuckDBPyConnection, sql: str) -> tuple[list[str], Counter]:
    cursor = con.execute(sql)
    found = [d[0] for d in cursor.description]
    order = sorted(range(len(found)), key=lambda i: found[i])
    return [found[i] for i in order], Counter(tuple(row[i] for i in order) for row in cursor.fetchall())


def differences(spark: SparkSession, sf_dir: str, query, sql: str) -> str | None:
    """What differs, None if nothing does."""
    names, got = spark_rows(query(spark, sf_dir))
    expected_names, expected = sql_rows(connect(sf_dir), sql)
    if names != expected_names:
        return f"columns {names} against {expected_names}"
    if got != expected:
        extra, missing = got - expected, expected - got
        return (
            f"{sum(got.values())} rows against {sum(expected.values())}; {sum(extra.values())} extra such as "
            f"{list(extra)[:2]}, {sum(missing.values())} missing such as {list(missing)[:2]}"
        )
    return None if got else "no rows"
