"""Weekly KPI reports. Input rows have service, category, week_start, n and revenue."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcelmetrics.functions.labels import reporting_week
from parcelmetrics.operators.columns import add_columns


def weekly_series(payments: DataFrame, keys: Sequence[str] = ("category", "service")) -> DataFrame:
    """Payments and revenue per service and Monday-based week from (day, revenue) rows."""
    week = "CAST(date_trunc('WEEK', day) AS DATE) AS week_start"
    return (
        payments.selectExpr(*keys, week, "revenue")
        .groupBy(*keys, "week_start")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("revenue").alias("revenue"))
    )


@dataclass(frozen=True)
class Verdicts:
    """Thresholds in percent. Inferred from published labels, hence parameters."""

    surge: float = 20
    good: float = 10
    caution: float = -10
    crisis: float = -20

    def label(self, wow: str, versus_average: str) -> str:
        return (
            f"CASE WHEN {wow} IS NULL THEN NULL"
            f" WHEN {wow} <= {self.crisis} THEN 'crisis' WHEN {wow} >= {self.surge} THEN 'surge'"
            f" WHEN {wow} <= {self.caution} THEN 'caution' WHEN {versus_average} >= {self.good} THEN 'good' ELSE 'normal' END"
        )


def percent_change(now: str, before: str) -> str:
    """Change in percent, one decimal, ties to even; NULL without a base."""
    n, b = f"CAST({now} AS DECIMAL(20,2))", f"CAST({before} AS DECIMAL(20,2))"
    return f"CAST(BROUND(try_divide(({n} - {b}) * 100, {b}), 1) AS DOUBLE)"


def average_order(revenue: str, n: str) -> str:
    return f"try_divide(CAST({revenue} AS DOUBLE), CAST({n} AS DOUBLE))"


def weekly_trend(series: DataFrame, keys: Sequence[str], verdicts: Verdicts | None = None) -> DataFrame:
    """Week over week and against the four weeks before, which leave the current week out.

    Weeks are calendar weeks: there is no change against a week before without payments, and
    weeks without payments count as zero in the average once the series has begun. Average
    order value over several weeks is revenue over count of those weeks, not a mean of weekly
    averages. A service has one row per week, so its window is bounded by the calendar.
    """
    day = F.datediff("week_start", F.lit("1970-01-01"))
    weekly = Window.partitionBy(*keys).orderBy(day)
    prior, four = weekly.rangeBetween(-7, -7), weekly.rangeBetween(-28, -7)
    begun = F.min("week_start").over(Window.partitionBy(*keys))
    df = series.select(*keys, "week_start", "n", "revenue").withColumns(
        {
            "prior_n": F.sum("n").over(prior),
            "prior_revenue": F.sum("revenue").over(prior),
            "_weeks": F.least(F.lit(4), F.floor(F.datediff("week_start", begun) / 7)).cast("long"),
            "_sum_n": F.sum("n").over(four),
            "_sum_revenue": F.sum("revenue").over(four),
        }
    )
    df = add_columns(
        df,
        {
            "aov": average_order("revenue", "n"),
            "n_wow_pct": percent_change("n", "prior_n"),
            "revenue_wow_pct": percent_change("revenue", "prior_revenue"),
            "n_avg4": "try_divide(CAST(_sum_n AS DOUBLE), CAST(_weeks AS DOUBLE))",
            "revenue_avg4": "try_divide(CAST(_sum_revenue AS DOUBLE), CAST(_weeks AS DOUBLE))",
            "aov_avg4": average_order("_sum_revenue", "_sum_n"),
            "n_vs_avg4_pct": percent_change("n * _weeks", "_sum_n"),
            "revenue_vs_avg4_pct": percent_change("revenue * _weeks", "_sum_revenue"),
        },
    ).drop("_weeks", "_sum_n", "_sum_revenue")
    rule = verdicts or Verdicts()
    return add_columns(
        df,
        {
            "n_verdict": rule.label("n_wow_pct", "n_vs_avg4_pct"),
            "revenue_verdict": rule.label("revenue_wow_pct", "revenue_vs_avg4_pct"),
        },
    )


def total_series(series: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """The series of coarser groups: a category, or everything under the key ``scope``."""
    if not keys:
        series, keys = series.withColumn("scope", F.lit("all")), ["scope"]
    return series.groupBy(*keys, "week_start").agg(F.sum("n").alias("n"), F.sum("revenue").alias("revenue"))


def contributions(series: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Each service's part of the week's total revenue change, in percent.

    A service absent in one of the two weeks counts as zero there.
    """
    now = series.select(*keys, "week_start", F.col("revenue").alias("delta"))
    before = series.select(*keys, F.date_add("week_start", 7).alias("week_start"), (-F.col("revenue")).alias("delta"))
    weeks = series.select("week_start").distinct()
    # Weeks are few: the calendar bounds both sides of these two joins.
    both = weeks.select("week_start").join(
        weeks.select(F.date_add("week_start", 7).alias("week_start")), "week_start", "left_semi"
    )
    change = now.unionByName(before).groupBy(*keys, "week_start").agg(F.sum("delta").alias("delta"))
    change = change.join(F.broadcast(both), "week_start", "left_semi")
    total = Window.partitionBy("week_start")
    share = "CAST(BROUND(try_divide(CAST(delta AS DECIMAL(20,2)) * 100, CAST(_total AS DECIMAL(20,2))), 1) AS DOUBLE)"
    return change.withColumn("_total", F.sum("delta").over(total)).selectExpr(
        *keys, "week_start", "delta", f"{share} AS contribution_pct"
    )


def package_mix(payments: DataFrame) -> DataFrame:
    """Count, revenue and share of each package type per week, with week-over-week change."""
    series = weekly_series(payments, ["package_type"])
    trend = weekly_trend(series, ["package_type"]).select(
        "package_type", "week_start", "n", "revenue", "n_wow_pct", "revenue_wow_pct"
    )
    share = "CAST(BROUND(CAST({0} AS DECIMAL(20,2)) * 100 / CAST(SUM({0}) OVER (PARTITION BY week_start) AS DECIMAL(20,2)), 1) AS DOUBLE)"
    return add_columns(trend, {"n_share_pct": share.format("n"), "revenue_share_pct": share.format("revenue")})


# Days as columns, Monday first.
WEEKDAYS = ["mon", "tue", "wed", "thu", "fri", "sat", "sun"]


def weekday_distribution(payments: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Payments per weekday of each week, and the change against the week before."""
    rows = payments.selectExpr(*keys, "CAST(date_trunc('WEEK', day) AS DATE) AS week_start", "WEEKDAY(day) AS d")
    days = rows.groupBy(*keys, "week_start").agg(
        *[F.expr(f"COUNT_IF(d = {i}) AS {name}") for i, name in enumerate(WEEKDAYS)]
    )
    before = days.select(
        *keys, F.date_add("week_start", 7).alias("week_start"), *[F.col(d).alias(f"_{d}") for d in WEEKDAYS]
    )
    return days.join(before, [*keys, "week_start"], "left").select(
        *keys, "week_start", *WEEKDAYS, *[(F.col(d) - F.col(f"_{d}")).alias(f"{d}_change") for d in WEEKDAYS]
    )


def lead_lag(series: DataFrame, leading: str, following: str, max_lag: int = 3) -> DataFrame:
    """Correlation of one category's weekly count with another's ``lag_weeks`` later.

    From exact sums, so the figure does not depend on the order of rows.
    """
    total = total_series(series, ["category"])
    lags = ", ".join(str(k) for k in range(max_lag + 1))
    x = total.filter(F.col("category") == leading).selectExpr("week_start AS _at", "n AS x", f"explode(array({lags})) AS lag_weeks")
    x = x.selectExpr("date_add(_at, 7 * lag_weeks) AS week_start", "x", "lag_weeks")
    y = total.filter(F.col("category") == following).selectExpr("week_start", "n AS y")
    sums = (
        x.join(y, "week_start")
        .groupBy("lag_weeks")
        .agg(
            F.count(F.lit(1)).alias("weeks"),
            *[F.expr(f"CAST(SUM(CAST({e} AS DECIMAL(38,0))) AS DECIMAL(38,0)) AS {n}") for n, e in
              {"_x": "x", "_y": "y", "_xy": "x * y", "_xx": "x * x", "_yy": "y * y"}.items()],
        )
    )
    d = lambda c: f"CAST({c} AS DOUBLE)"
    top = f"weeks * {d('_xy')} - {d('_x')} * {d('_y')}"
    bottom = f"SQRT((weeks * {d('_xx')} - {d('_x')} * {d('_x')}) * (weeks * {d('_yy')} - {d('_y')} * {d('_y')}))"
    return sums.selectExpr("lag_weeks", "weeks", f"ROUND(try_divide({top}, {bottom}), 6) AS correlation")


def service_changes(series: DataFrame) -> DataFrame:
    """Services new in a week, or missing from it, against the week before."""
    weeks = series.select("week_start").distinct()
    now = series.select("service", "week_start").distinct()
    shifted = now.select("service", F.date_add("week_start", 7).alias("week_start"))
    # Only weeks with data both in themselves and in the week before can be compared.
    known = weeks.join(weeks.select(F.date_add("week_start", 7).alias("week_start")), "week_start", "left_semi")
    new = now.join(shifted, ["service", "week_start"], "left_anti").withColumn("status", F.lit("new"))
    missing = shifted.join(now, ["service", "week_start"], "left_anti").withColumn("status", F.lit("missing"))
    return new.unionByName(missing).join(F.broadcast(known), "week_start", "left_semi").select("week_start", "service", "status")


def weeks_before(payments: DataFrame, report_date: str, weeks: int = 1, column: str = "paid_at") -> DataFrame:
    """Payments of the ``weeks`` full weeks, Monday to Sunday, that end before the week of the report date.

    The bounds are on the raw time stamp, so they reach the scan and no other week is read.
    """
    monday = date.fromisoformat(report_date) - timedelta(days=date.fromisoformat(report_date).weekday())
    first = monday - timedelta(days=7 * weeks)
    kind = payments.schema[column].dataType
    return payments.filter((F.col(column) >= F.lit(first.isoformat()).cast(kind)) & (F.col(column) < F.lit(monday.isoformat()).cast(kind)))


def report_week(payments: DataFrame, report_date: str, keys: Sequence[str] = ("category", "service")) -> DataFrame:
    """Count and revenue in the full week before the report date."""
    return weekly_series(weeks_before(payments, report_date), keys)


def week_against_before(payments: DataFrame, report_date: str, keys: Sequence[str]) -> DataFrame:
    """The report's week beside the week before and the sums of the four weeks before, from these five weeks alone."""
    series = weekly_series(weeks_before(payments, report_date, 5), keys)
    latest = f"week_start = {reporting_week(repr(report_date))}"
    before = f"week_start = {reporting_week(repr(report_date))} - INTERVAL 7 DAY"
    sums = series.groupBy(*keys).agg(
        *[F.expr(f"COALESCE(SUM(CASE WHEN {latest} THEN {c} END), 0) AS {c}") for c in ("n", "revenue")],
        *[F.expr(f"COALESCE(SUM(CASE WHEN {before} THEN {c} END), 0) AS prior_{c}") for c in ("n", "revenue")],
        *[F.expr(f"COALESCE(SUM(CASE WHEN NOT ({latest}) THEN {c} END), 0) AS four_weeks_{c}") for c in ("n", "revenue")],
    )
    changes = {f"{c}_wow_pct": f"CASE WHEN prior_{c} > 0 THEN {percent_change(c, f'prior_{c}')} END" for c in ("n", "revenue")}
    return add_columns(sums, changes)
