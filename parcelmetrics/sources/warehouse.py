"""Scan the warehouse tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelmetrics.sources.schemas import SCHEMAS

Tables = Mapping[str, DataFrame]


def read_table(spark: SparkSession, path: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{path.rstrip('/')}/{name}.parquet")


def read_tables(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """Lazily open every warehouse table under ``path`` with its declared schema."""
    return {name: read_table(spark, path, name) for name in SCHEMAS}


def decimals_to_double(df: DataFrame) -> DataFrame:
    """Decimal columns become doubles; every other column is left alone."""
    return df.select(
        *[
            F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType) else F.col(f.name)
            for f in df.schema
        ]
    )
