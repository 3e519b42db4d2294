"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelmetrics.operators.columns import add_columns


def splittable_join(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    spread: str,
    how: str = "left",
    only_if: str | None = None,
    also: str | None = None,
    few: bool = False,
) -> DataFrame:
    """Equi-join in which a hot left key can be split over many tasks.

    The hash of the key is a second join key. That gives both sides an exchange of their
    own, even when one is already partitioned by the key, and the skew rule of adaptive
    execution only splits a partition that comes straight from an exchange.

    Left rows that cannot match (no key, or ``only_if`` false) take the hash of ``spread``
    instead, so they are dealt out evenly and not collected under one NULL key.
    ``only_if`` is a left-side condition of the ON clause: rows failing it are kept by a
    left join, with NULLs. ``also`` is a further condition of the ON clause, on columns of both
    sides, whose names must differ. The right key is dropped from the result.

    The right side is shuffled as well, unless it has ``few`` rows for certain, see :func:`many`.
    """
    can_match = f"`{left_key}` IS NOT NULL"
    if only_if is not None:
        can_match += f" AND COALESCE({only_if}, FALSE)"
    a = add_columns(
        left,
        {
            "_can_match": can_match,
            "_hash_left": f"CASE WHEN {can_match} THEN xxhash64(`{left_key}`) ELSE xxhash64(`{spread}`) END",
        },
    )
    kept = [f"`{c}`" for c in right.columns if c != right_key]
    b = right.selectExpr(*kept, f"`{right_key}` AS _key_right", f"xxhash64(`{right_key}`) AS _hash_right")
    on = F.expr(f"`{left_key}` = _key_right AND _hash_left = _hash_right AND _can_match" + (f" AND {also}" if also else ""))
    return a.join(b if few else many(b), on, how).drop("_can_match", "_hash_left", "_hash_right", "_key_right")


def many(df: DataFrame) -> DataFrame:
    """``df`` as the side of a join that is not broadcast, for tables that grow with the packages.

    Spark takes the size of their files for their size. Fees that are mostly zero, or ids in order, are ten to thirty times
    as large as rows, and the driver would have to hold them all.
    """
    return df.hint("merge")


def with_fx(df: DataFrame, fx: DataFrame, day: str, suffix: str) -> DataFrame:
    """Attach both exchange rates of a day as ``origin_<suffix>`` and ``usd_krw_<suffix>``.

    ``fx`` holds one row per calendar date, so it is bounded by the DATE type itself (about
    16,000 rows for 45 years, three fixed-width columns) whatever the packages amount to.
    That makes the broadcast safe; it also keeps a busy day from becoming a hot join key.
    """
    rates = fx.selectExpr(
        f"currency_date AS _day_{suffix}", f"origin_usd_krw AS origin_{suffix}", f"usd_krw AS usd_krw_{suffix}"
    )
    return df.join(F.broadcast(rates), F.expr(f"{day} = _day_{suffix}"), "left").drop(f"_day_{suffix}")
