"""Exact ranks and quantiles without a global sort, and without counting every distinct value.

Values are whole numbers. A quantile is bracketed by a sketch, whose bounds a plain aggregate then checks; only values
between them are counted and put in order, some hundred-thousandths of all rows. Where a sketch does not hold the rank, as
it cannot in a small table, the bracket is the whole range, so results are exact in any case. No row is multiplied but those
inside a bracket.

A rank is found by range: cuts from a sketch deal the rows into buckets, a count per bucket gives the rows below it, and a
window orders a bucket. A value that is a cut is a bucket of its own, whose rank follows from the counts, so that a value
held by half of all rows is in no window.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelmetrics.operators.joins import many

#: A sketch's rank error is at most 1 / ACCURACY of the rows; brackets reach four times as far.
ACCURACY = 100_000
MARGIN = 4 / ACCURACY
#: Cuts of a ranking, one less than a power of two; there are at most 2 * CUTS + 1 buckets.
CUTS, CUT_ACCURACY = 255, 10_000

#: A rank, from 0, as a function of the number of rows.
Rank = Callable[[Column], Column]


def _at(p: float, n: Column) -> Column:
    return F.lit(p) * (n - 1)


def quantile_picks(quantiles: Mapping[str, float]) -> dict[str, tuple[float, Rank]]:
    """Both neighbours of each quantile: name, where to look for it, and its rank."""
    picks: dict[str, tuple[float, Rank]] = {}
    for name, p in quantiles.items():
        picks[f"{name}_lo"] = (p, lambda n, p=p: F.floor(_at(p, n)))
        picks[f"{name}_hi"] = (p, lambda n, p=p: F.ceil(_at(p, n)))
    return picks


def _values(df: DataFrame, values: Mapping[str, str]) -> DataFrame:
    return df.selectExpr(*[f"CAST({sql} AS BIGINT) AS v{i}" for i, sql in enumerate(values.values())])


def order_values(df: DataFrame, values: Mapping[str, str], picks: Mapping[str, tuple[float, Rank]]) -> DataFrame:
    """(metric, <pick> ...): the values at the picked ranks of each of ``values`` (metric to expression), NULLs left out.

    A metric without values has no row.
    """
    rows = _values(df, values)
    metrics = range(len(values))
    shares = sorted({share for share, _ in picks.values()})
    brackets = [(i, k) for i in metrics for k in range(len(shares))]
    edges = F.array(*[F.lit(min(1.0, max(0.0, p + d))) for p in shares for d in (-MARGIN, MARGIN)])

    # Each scalar becomes one column: an expression that names it again would carry its plan again.
    facts = rows.agg(
        *[
            column
            for i in metrics
            for column in (
                F.count(f"v{i}").alias(f"n{i}"),
                F.min(f"v{i}").alias(f"least{i}"),
                F.max(f"v{i}").alias(f"most{i}"),
                F.percentile_approx(f"v{i}", edges, F.lit(ACCURACY)).alias(f"edges{i}"),
            )
        ]
    )
    facts = facts.select(F.struct("*")).scalar().alias("f")
    edge = lambda i, k, side: F.get(F.col(f"f.edges{i}"), F.lit(2 * k + side))
    tested = rows.select("*", facts).agg(
        *[
            column
            for i, k in brackets
            for column in (
                F.count_if(F.col(f"v{i}") < edge(i, k, 0)).alias(f"below{i}_{k}"),
                F.count_if(F.col(f"v{i}") <= edge(i, k, 1)).alias(f"through{i}_{k}"),
            )
        ]
    )

    def bracket(i: int, k: int) -> tuple[Column, Column, Column]:
        """Least and greatest value of the bracket, and the rows below it."""
        n = F.col(f"f.n{i}")
        ranks = [rank(n) for share, rank in picks.values() if share == shares[k]]
        first, last = (ranks[0], ranks[0]) if len(ranks) == 1 else (F.least(*ranks), F.greatest(*ranks))
        holds_first, holds_last = F.col(f"below{i}_{k}") <= first, F.col(f"through{i}_{k}") > last
        low = F.when(holds_first, edge(i, k, 0)).otherwise(F.col(f"f.least{i}"))
        high = F.when(holds_last, edge(i, k, 1)).otherwise(F.col(f"f.most{i}"))
        return low, high, F.when(holds_first, F.col(f"below{i}_{k}")).otherwise(F.lit(0).cast("long"))

    columns = zip(("low", "high", "below"), zip(*[bracket(i, k) for i, k in brackets]))
    bounds = tested.select("*", facts).select(
        *[F.array(*column).alias(name) for name, column in columns], F.array(*[F.col(f"f.n{i}") for i in metrics]).alias("size")
    )
    bounds = bounds.select(F.struct("*")).scalar().alias("b")

    def inside(place: int, i: int, k: int) -> Column:
        held = F.col(f"v{i}").between(F.get(F.col("b.low"), F.lit(place)), F.get(F.col("b.high"), F.lit(place)))
        return F.when(held, F.struct(F.lit(i).alias("metric"), F.lit(k).alias("share"), F.col(f"v{i}").alias("value")))

    near = rows.select("*", bounds).select(F.inline(F.array_compact(F.array(*[inside(place, i, k) for place, (i, k) in enumerate(brackets)]))))
    counts = near.groupBy("metric", "share", "value").agg(F.count("*").alias("n")).select("*", bounds)
    below = F.get(F.col("b.below"), F.col("metric") * len(shares) + F.col("share"))
    through = below + F.sum("n").over(Window.partitionBy("metric", "share").orderBy("value"))
    placed = counts.select("metric", "share", "value", "n", through.alias("through"), F.get(F.col("b.size"), F.col("metric")).alias("size"))

    def picked(name: str) -> Column:
        share, rank = picks[name]
        at = rank(F.col("size"))
        here = (F.col("share") == shares.index(share)) & (F.col("through") - F.col("n") <= at) & (at < F.col("through"))
        return F.max(F.when(here, F.col("value"))).alias(name)

    labels = F.get(F.array(*[F.lit(name) for name in values]), F.col("metric"))
    return placed.groupBy("metric").agg(*[picked(name) for name in picks]).withColumn("metric", labels)


QUARTILES = {"p25": 0.25, "p50": 0.5, "p75": 0.75}


def describe(df: DataFrame, values: Mapping[str, str], quantiles: Mapping[str, float] | None = None) -> DataFrame:
    """(metric, count, mean, std, min, <quantile> ..., max, sum) of each of ``values`` (metric to expression).

    Sums are exact, so the figures do not depend on partitioning; quantiles are interpolated, the deviation is the
    sample's. A metric without values has zeros.
    """
    quantiles = QUARTILES if quantiles is None else quantiles
    rows = _values(df, values)
    figures = []
    for i in range(len(values)):
        exact = f"CAST(v{i} AS DECIMAL(19,0))"
        figures += [
            F.count(f"v{i}").alias(f"n{i}"),
            F.expr(f"CAST(SUM({exact}) AS DECIMAL(38,0)) AS s{i}"),
            F.expr(f"CAST(SUM(CAST({exact} * {exact} AS DECIMAL(38,0))) AS DECIMAL(38,0)) AS q{i}"),
            F.min(f"v{i}").alias(f"a{i}"),
            F.max(f"v{i}").alias(f"z{i}"),
        ]
    structs = ", ".join(
        f"named_struct('metric', '{name}', 'count', n{i}, '_sum', s{i}, '_squares', q{i}, '_min', a{i}, '_max', z{i})" for i, name in enumerate(values)
    )
    stats = rows.agg(*figures).selectExpr(f"inline(array({structs}))")
    stats = stats.join(order_values(df, values, quantile_picks(quantiles)), "metric", "left")
    total = "COALESCE(CAST(_sum AS DOUBLE), 0D)"
    variance = f"(CAST(_squares AS DOUBLE) - {total} * {total} / count) / (count - 1)"

    def interpolated(name: str, p: float) -> str:
        at = f"{p}D * (count - 1)"
        lo, hi = f"CAST({name}_lo AS DOUBLE)", f"CAST({name}_hi AS DOUBLE)"
        return f"COALESCE({lo} + ({hi} - {lo}) * ({at} - FLOOR({at})), 0D) AS {name}"

    return stats.selectExpr(
        "metric",
        "count",
        f"COALESCE(try_divide({total}, count), 0D) AS mean",
        f"CASE WHEN count > 1 THEN SQRT(GREATEST({variance}, 0D)) ELSE 0D END AS std",
        "COALESCE(CAST(_min AS DOUBLE), 0D) AS min",
        *[interpolated(name, p) for name, p in quantiles.items()],
        "COALESCE(CAST(_max AS DOUBLE), 0D) AS max",
        f"{total} AS sum",
    )


def _percentile(below: Column, n: Column, size: Column) -> Column:
    """Rank with ties averaged, divided by the number of rows, rounded up to a whole percent."""
    return F.ceil((below + (n + 1) / 2) / size * 100).cast("long")


def _bucket(cuts: Column, value: Column) -> Column:
    """Twice the number of cuts up to the value, less one where the value is a cut: a binary search."""
    steps = F.array(*[F.lit(1 << k) for k in reversed(range((CUTS + 1).bit_length() - 1))])
    reaches = lambda i, s: (i + s <= CUTS) & (F.get(cuts, i + s - 1) <= value)
    passed = F.aggregate(steps, F.lit(0), lambda i, s: F.when(reaches(i, s), i + s).otherwise(i))
    return F.transform(F.array(passed), lambda i: 2 * i - F.when((i > 0) & (F.get(cuts, i - 1) == value), 1).otherwise(0))[0]


def with_percentile_ranks(df: DataFrame, key: list[str], group: list[str], values: Mapping[str, str]) -> DataFrame:
    """Add a percentile within each ``group``, 1 to 100, for each of ``values`` (result name to column).

    ``key`` names a row; ranks are found on keys and values alone, put together by key and then joined back, so that the wide rows
    move once however many values there are. Groups are few, as years are. A
    row without value has no percentile.
    """
    own = F.concat_ws("\x1f", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in group]) if group else F.lit("")
    found = []
    for name, value in values.items():
        rows = df.select(*key, own.alias("_group"), F.col(value).cast("long").alias("_value")).where("_value IS NOT NULL")
        shares = F.array(*[F.lit(k / (CUTS + 1)) for k in range(1, CUTS + 1)])
        cuts = rows.groupBy("_group").agg(F.percentile_approx("_value", shares, F.lit(CUT_ACCURACY)).alias("cuts"))
        cuts = cuts.agg(F.map_from_entries(F.collect_list(F.struct("_group", "cuts")))).scalar()
        rows = rows.withColumn("_cuts", cuts[F.col("_group")]).withColumn("_bucket", _bucket(F.col("_cuts"), F.col("_value"))).drop("_cuts")
        counts = rows.groupBy("_group", "_bucket").agg(F.count("*").alias("n"))
        # One array per group: how many rows lie below each bucket, and at last all of them.
        by_group = counts.groupBy("_group").agg(F.map_from_entries(F.collect_list(F.struct("_bucket", "n"))).alias("n"))
        dense = F.transform(F.sequence(F.lit(0), F.lit(2 * CUTS)), lambda b: F.coalesce(F.col("n")[b], F.lit(0).cast("long")))
        sums = F.aggregate(dense, F.array(F.lit(0).cast("long")), lambda done, n: F.concat(done, F.array(F.element_at(done, -1) + n)))
        below = by_group.select("_group", sums.alias("below")).agg(F.map_from_entries(F.collect_list(F.struct("_group", "below")))).scalar()
        rows = rows.withColumn("_below", below[F.col("_group")]).select(
            *key,
            "_group",
            "_value",
            "_bucket",
            F.get("_below", F.col("_bucket")).alias("_before"),
            F.get("_below", F.col("_bucket") + 1).alias("_through"),
            F.get("_below", F.lit(2 * CUTS + 1)).alias("_size"),
        )
        is_cut = F.col("_bucket") % 2 == 1
        # Rows at a cut need no order and are spread.
        rows = rows.withColumn("_spread", F.when(is_cut, F.pmod(F.xxhash64(*key), F.lit(1 << 20))).otherwise(0))
        own_bucket = ["_group", "_bucket", "_spread"]
        inside = F.rank().over(Window.partitionBy(*own_bucket).orderBy("_value")) - 1
        peers = F.count("*").over(Window.partitionBy(*own_bucket, "_value"))
        ranked = rows.select(
            *key,
            F.when(is_cut, F.col("_before")).otherwise(F.col("_before") + inside).alias("_below"),
            F.when(is_cut, F.col("_through") - F.col("_before")).otherwise(peers).alias("_n"),
            "_size",
        )
        found.append(ranked.select(*key, _percentile(F.col("_below"), F.col("_n"), F.col("_size")).alias(name)))
    ranks = reduce(lambda a, b: _with_key(a, b, key, "full"), found)
    return _with_key(df.drop(*values), ranks, key, "left")


def _with_key(a: DataFrame, b: DataFrame, key: list[str], how: str) -> DataFrame:
    """Columns of ``b`` beside those of ``a``; a NULL in a key is a key as well."""
    b = b.withColumnsRenamed({c: f"_key_{c}" for c in key})
    joined = a.join(many(b), reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"_key_{c}")) for c in key]), how)
    if how == "full":
        joined = joined.withColumns({c: F.coalesce(c, f"_key_{c}") for c in key})
    return joined.drop(*[f"_key_{c}" for c in key])


def top_share(df: DataFrame, value: str, share: float = 0.1) -> DataFrame:
    """One row (top, total): the sum of the highest ``share`` of the values, one at least, and of all of them.

    Of the rows that share the last value as many count as still fit, so ties need no order.
    """
    wanted: Rank = lambda n: F.greatest(F.lit(1), F.floor(n * F.lit(share))).cast("long")
    last = order_values(df, {"v": value}, {"at": (1 - share, lambda n: n - wanted(n))}).select("at").scalar()
    sums = _values(df, {"v": value}).select("v0", last.alias("_last")).agg(
        F.count("v0").alias("_n"),
        F.count_if(F.col("v0") > F.col("_last")).alias("_above"),
        F.expr("CAST(SUM(CAST(v0 AS DECIMAL(19,0))) AS DECIMAL(38,0)) AS total"),
        F.sum(F.when(F.col("v0") > F.col("_last"), F.col("v0").cast("decimal(19,0)"))).cast("decimal(38,0)").alias("_over"),
        F.max("_last").alias("_last"),
    )
    fitting = (wanted(F.col("_n")) - F.col("_above")).cast("decimal(19,0)") * F.col("_last").cast("decimal(19,0)")
    return sums.select((F.coalesce("_over", F.lit(0)) + F.coalesce(fitting, F.lit(0))).cast("decimal(38,0)").alias("top"), "total")
