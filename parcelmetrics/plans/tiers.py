"""Loyalty tiers by period and the transitions between them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcelmetrics.functions.labels import is_admin

# Tiers from low to high and the states of absence.
TIERS = ["Basic", "Bronze", "Silver", "Gold", "VIP"]
ABSENT_BEFORE = "Not available"
ABSENT_AFTER = "No activity"
FROM_STATES = [*TIERS, ABSENT_BEFORE]
TO_STATES = [*TIERS, ABSENT_AFTER]


def assign_tiers(amounts: DataFrame, thresholds: Mapping[str, float]) -> DataFrame:
    """Tier by amount in a period; ``thresholds`` give the lowest amount of each tier above Basic."""
    chosen = F.lit(TIERS[0])
    for tier in TIERS[1:]:
        chosen = F.when(F.col("total_amount") >= F.lit(thresholds[tier]), F.lit(tier)).otherwise(chosen)
    return amounts.select("customer_id", "period", chosen.alias("tier"))


def transitions(tiers: DataFrame, pairs: Sequence[tuple[int, int]]) -> DataFrame:
    """Customers per (from_period, to_period, from_state, to_state).

    A customer's tiers are laid side by side in one aggregate instead of a self-join per
    pair, then counted for every pair in which the customer appears at all.
    """
    periods = sorted({p for pair in pairs for p in pair})
    wide = tiers.filter(F.col("period").isin(periods)).groupBy("customer_id").agg(
        *[F.expr(f"MAX(CASE WHEN period = {p} THEN tier END) AS _{p}") for p in periods]
    )
    moves = ", ".join(
        f"CASE WHEN _{a} IS NOT NULL OR _{b} IS NOT NULL THEN named_struct('from_period', {a}, 'to_period', {b},"
        f" 'from_state', COALESCE(_{a}, '{ABSENT_BEFORE}'), 'to_state', COALESCE(_{b}, '{ABSENT_AFTER}')) END"
        for a, b in pairs
    )
    return (
        wide.selectExpr(f"explode(array_compact(array({moves}))) AS m")
        .groupBy("m.from_period", "m.to_period", "m.from_state", "m.to_state")
        .agg(F.count(F.lit(1)).alias("customers"))
    )


def full_grid(counts: DataFrame) -> DataFrame:
    """All 36 cells of each pair of periods, with zeros and row percentages.

    The grid is 36 constant cells exploded onto each pair, a handful of rows.
    """
    states = lambda names: "array(" + ", ".join(f"'{s}'" for s in names) + ")"
    pairs = counts.select("from_period", "to_period").distinct()
    cells = pairs.selectExpr("*", f"explode({states(FROM_STATES)}) AS from_state").selectExpr(
        "*", f"explode({states(TO_STATES)}) AS to_state"
    )
    keys = ["from_period", "to_period", "from_state", "to_state"]
    filled = cells.join(counts, keys, "left").select(*keys, F.coalesce("customers", F.lit(0)).alias("customers"))
    row = Window.partitionBy("from_period", "to_period", "from_state")
    pct = "CAST(COALESCE(BROUND(try_divide(CAST(customers AS DECIMAL(18,0)) * 100, CAST(_row AS DECIMAL(18,0))), 2), 0) AS DOUBLE)"
    return filled.withColumn("_row", F.sum("customers").over(row)).selectExpr(*keys, "customers", f"{pct} AS row_pct")


def matrix(grid: DataFrame, value: str = "customers") -> DataFrame:
    """One row per from-state with a column per to-state."""
    keys = ["from_period", "to_period", "from_state"]
    return grid.groupBy(*keys).pivot("to_state", TO_STATES).agg(F.first(value))


def summary(counts: DataFrame) -> DataFrame:
    """New, lost, upgraded, downgraded and unchanged customers per pair of periods."""
    order = " ".join(f"WHEN '{t}' THEN {i}" for i, t in enumerate(TIERS))
    a, b = f"CASE from_state {order} END", f"CASE to_state {order} END"
    kinds = {
        "new": f"from_state = '{ABSENT_BEFORE}'",
        "lost": f"to_state = '{ABSENT_AFTER}'",
        "upgrade": f"{b} > {a}",
        "downgrade": f"{b} < {a}",
        "maintain": f"{a} = {b}",
    }
    return counts.groupBy("from_period", "to_period").agg(
        *[F.expr(f"COALESCE(SUM(CASE WHEN {test} THEN customers END), 0) AS `{name}`") for name, test in kinds.items()]
    )


def without_admin_customers(tiers: DataFrame, customer: DataFrame) -> DataFrame:
    """Drop the customers behind administrator suites."""
    return tiers.join(customer.filter(is_admin()).select("customer_id"), "customer_id", "left_anti")
