"""Run a Spark query and its checking SQL on the same tables and list the differences."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def _normal(value: object) -> tuple:
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return (0, "")
    if isinstance(value, float):
        return (1, value + 0.0 if value else 0.0)
    if isinstance(value, (int, bool)):
        return (1, value)
    return (2, str(value))


def differences(spark_df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str, show: int = 3) -> list[str]:
    cursor = con.execute(sql)
    names = sorted(d[0] for d in cursor.description)
    order = {d[0]: i for i, d in enumerate(cursor.description)}
    expected = [tuple(r[order[n]] for n in names) for r in cursor.fetchall()]
    if sorted(spark_df.columns) != names:
        return [f"columns differ: {sorted(set(spark_df.columns) ^ set(names))}"]
    actual = [tuple(r) for r in spark_df.select(*[f"`{n}`" for n in names]).collect()]
    if len(actual) != len(expected):
        return [f"rows: spark {len(actual)}, check {len(expected)}"]
    key = lambda row: tuple(_normal(v) for v in row)
    a, b = sorted(map(key, actual)), sorted(map(key, expected))
    if a == b:
        return []
    only_a, only_b = sorted(set(a) - set(b)), sorted(set(b) - set(a))
    out = [f"{len(only_a)} rows differ"]
    for x, y in list(zip(only_a, only_b))[:show]:
        out.append(str({n: (p[1], q[1]) for n, p, q in zip(names, x, y) if p != q}))
    return out
