"""Add many computed columns at once."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame


def add_columns(df: DataFrame, expressions: Mapping[str, str]) -> DataFrame:
    """One projection for all SQL expressions; an existing column of that name is replaced."""
    kept = [f"`{c}`" for c in df.columns if c not in expressions]
    return df.selectExpr(*kept, *[f"{sql} AS `{name}`" for name, sql in expressions.items()])
