"""Keep one row per key."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def keep_highest(df: DataFrame, key: str, value: str, ties: list[str]) -> DataFrame:
    """The row with the highest ``value`` per ``key``; ``ties`` make the choice repeatable.

    ``row_number() == 1`` lets Catalyst place a group limit in front of the shuffle, so
    each map task sends one row per key and a key that holds a third of the table does not
    land whole in one task. Rows without a key cannot be joined later and are left out.
    """
    order = [F.col(c).desc_nulls_last() for c in (value, *ties)]
    return (
        df.filter(F.col(key).isNotNull())
        .withColumn("_rank", F.row_number().over(Window.partitionBy(key).orderBy(*order)))
        .filter(F.col("_rank") == 1)
        .drop("_rank")
    )
