"""Effective-dated rates: the rate of a fee, a marketplace and a day, looked up in a table of periods.

A row (fee, market_id, valid_from, valid_to, rate) holds from ``valid_from`` on and before ``valid_to``, which is empty for
the current rate. A changed rate is a changed row; no code knows a date. ``rate_problems`` lists what a table should not
hold: periods that overlap, leave a gap, or end before they begin.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelmetrics.functions.money import FEE_KINDS, FeeSchedule
from parcelmetrics.operators.columns import add_columns
from parcelmetrics.operators.joins import splittable_join

RATES = T.StructType(
    [
        T.StructField("fee", T.StringType()),
        T.StructField("market_id", T.IntegerType()),
        T.StructField("valid_from", T.DateType()),
        T.StructField("valid_to", T.DateType()),
        T.StructField("rate", T.DecimalType(5, 4)),
    ]
)
#: Days before and after all periods. A row without ``valid_from`` holds since ever.
FIRST, LAST = "DATE '0001-01-01'", "DATE '9999-12-31'"


def rate_table(spark: SparkSession, schedule: FeeSchedule) -> DataFrame:
    """The published schedule as a rate table."""
    return spark.createDataFrame([(*row[:4], Decimal(row[4])) for row in schedule.rows()], RATES)


def _periods(rates: DataFrame) -> DataFrame:
    return rates.selectExpr("fee", "market_id", f"COALESCE(valid_from, {FIRST}) AS since", f"COALESCE(valid_to, {LAST}) AS until", "rate")


def rate_problems(rates: DataFrame) -> DataFrame:
    """(fee, market_id, problem, since, until) of overlaps, gaps and empty periods."""
    periods = _periods(rates)
    following = "OVER (PARTITION BY fee, market_id ORDER BY since, until, rate ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    seen = periods.filter("since < until").selectExpr("*", f"MAX(until) {following} AS reached")
    between = seen.selectExpr(
        "fee",
        "market_id",
        "CASE WHEN since < reached THEN 'overlap' WHEN since > reached THEN 'gap' END AS problem",
        "LEAST(since, reached) AS since",
        "CASE WHEN since < reached THEN LEAST(until, reached) ELSE since END AS until",
        "since AS _from",
    )
    # An overlap begins where the later period does.
    between = between.selectExpr("fee", "market_id", "problem", "IF(problem = 'overlap', _from, since) AS since", "until")
    empty = periods.filter("since >= until").selectExpr("fee", "market_id", "'empty' AS problem", "since", "until")
    return between.filter("problem IS NOT NULL").unionByName(empty)


def elementary_periods(rates: DataFrame, fees: tuple[str, ...] = FEE_KINDS) -> DataFrame:
    """(market_id, since, until, <fee>_rate ...): each market's time cut at every change, one row a piece.

    Pieces of a market do not overlap, so a day is in one of them. Where periods of a fee overlap, the one that began last counts; a
    fee without a period is zero.
    """
    periods = _periods(rates).filter("since < until")
    cuts = periods.selectExpr("market_id", f"EXPLODE(ARRAY(since, until, {FIRST}, {LAST})) AS since").distinct()
    pieces = cuts.selectExpr("market_id", "since", "LEAD(since) OVER (PARTITION BY market_id ORDER BY since) AS until")
    pieces = pieces.filter("until IS NOT NULL")
    own = periods.selectExpr("market_id AS _market", "fee", "since AS _since", "until AS _until", "rate")
    held = pieces.join(own, F.expr("market_id = _market AND since >= _since AND until <= _until"))
    rate = "COALESCE(MAX_BY(rate, STRUCT(_since, rate)) FILTER (WHERE fee = '{}'), CAST(0 AS DECIMAL(5,4))) AS {}_rate"
    return held.groupBy("market_id", "since", "until").agg(*[F.expr(rate.format(f, f)) for f in fees])


def with_rates(
    df: DataFrame, rates: DataFrame, market: str, day: str, spread: str, fees: tuple[str, ...] = FEE_KINDS, few: bool = False
) -> DataFrame:
    """Add ``<fee>_rate`` for the row's market and day; zero for an unknown market, the earliest rate without a day.

    An equality join on the market with the period as a further condition: Spark broadcasts the periods while they are
    small, and beyond that a hot market is split. ``few`` says that they are, as those of a schedule: Spark has no size of
    rows that come from the driver, and would shuffle the purchases to find out. Rates do not grow with the packages.
    """
    periods = elementary_periods(rates, fees).withColumnRenamed("market_id", "_rate_market")
    if few:
        periods = F.broadcast(periods)
    dated = add_columns(df, {"_day": f"COALESCE({day}, {FIRST})"})
    joined = splittable_join(dated, periods, market, "_rate_market", spread=spread, also="_day >= since AND _day < until", few=True)
    return add_columns(joined.drop("_day", "since", "until"), {f"{f}_rate": f"COALESCE({f}_rate, 0)" for f in fees})
