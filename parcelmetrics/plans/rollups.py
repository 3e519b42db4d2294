"""Roll-ups of the combined cases: KPIs, statistics, case summaries, suite profiles."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelmetrics.functions.labels import (
    CASE_NAMES,
    UNKNOWN_SUITE,
    WEIGHT_LABELS,
    case_name,
    is_admin,
    is_country_code,
    kst_minute,
    weight_bin,
)
from parcelmetrics.operators.columns import add_columns
from parcelmetrics.operators.packages import PARENT_TYPES
from parcelmetrics.operators.ranking import describe, top_share, with_percentile_ranks

CURRENCIES = ("krw", "usd")
REVENUE_PARTS = {"buy": "goods_revenue", "storage": "warehouse_revenue", "ship": "shipping_revenue"}
PROFIT_PARTS = ["goods_profit", "warehouse_profit", "shipping_profit"]

# Columns a roll-up may use; everything else is pruned at the scan.
COMBINED = [
    "source_case",
    "suite_number",
    "package_id",
    "package_type",
    "country_code",
    "package_weight",
    "dimension_weight",
    "ship_date_kst",
    "origin_usd_krw_package",
    "original_cost_krw",
    "marked_up_cost_krw",
    *[f"revenue_{c}" for c in CURRENCIES],
    *[f"revenue_{part}_{c}" for part in REVENUE_PARTS for c in CURRENCIES],
    *[f"profit_{c}" for c in CURRENCIES],
    *[f"{part}_{c}" for part in PROFIT_PARTS for c in CURRENCIES],
]

# What these are made from in the case rows.
COMBINED_FROM = [
    "profit_case",
    *[c for c in COMBINED if c != "source_case" and not c.startswith("revenue")],
    *[f"{part}_{c}" for part in REVENUE_PARTS.values() for c in CURRENCIES],
]

# The nine option fees summed when a result has no warehouse revenue.
FALLBACK_FEES = [
    "storage_fee",
    "request_photo_fee",
    "repack_fee",
    "bubble_wrap_fee",
    "vacuum_repack_fee",
    "plasticbox_fee",
    "remove_papertube_fee",
    "inclusion_fee",
    "bfm_extra_fee",
]
FALLBACK_GOODS = ["total_goods_price", "domestic_shipping_price", "fee_handling_fee", "pg_fee", "service_fee", "surtax"]

#: An expression for a schema, given as the names of its columns.
Expression = Callable[[set[str]], str]


def sum_present(columns: Iterable[str], present: set[str]) -> str:
    """Sum of the columns that exist, NULL as zero; zero when none does."""
    return " + ".join(f"COALESCE({c}, 0)" for c in columns if c in present) or "0"


def total_of(*columns: str) -> Expression:
    return lambda have: sum_present(columns, have)


def plain(sql: str) -> Expression:
    return lambda have: sql


def _converted(have: set[str]) -> str:
    return f"BROUND({sum_present(['shipping_fee'], have)} * {'COALESCE(usd_krw_package, 1450)' if 'usd_krw_package' in have else '1450'}, 0)"


def _each(target: str, source: Callable[[str], Expression]) -> dict[str, Expression]:
    return {f"{target}_{c}": source(c) for c in CURRENCIES}


@dataclass(frozen=True)
class Candidate:
    """A way to fill targets: for results that have the column ``needs``, of the given cases (all if empty)."""

    fills: Mapping[str, Expression]
    needs: str | None = None
    cases: tuple[int, ...] = ()


#: Missing column to its candidates, of which the first that fits an older result counts.
RESOLVED: dict[str, tuple[Candidate, ...]] = {
    "warehouse_revenue_krw": (
        Candidate(_each("warehouse_revenue", lambda c: total_of(f"revenue_sto_{c}")), "revenue_sto_krw"),
        Candidate(_each("warehouse_revenue", lambda c: total_of(*[f"{fee}_{c}" for fee in FALLBACK_FEES]))),
    ),
    "shipping_revenue_krw": (
        Candidate(_each("shipping_revenue", lambda c: total_of(f"revenue_shp_{c}")), "revenue_shp_krw"),
        Candidate({"shipping_revenue_krw": total_of("shipping_fee_krw"), "shipping_revenue_usd": total_of("shipping_fee")}, "shipping_fee_krw"),
        Candidate({"shipping_revenue_krw": _converted, "shipping_revenue_usd": total_of("shipping_fee")}),
    ),
    "goods_revenue_krw": (
        Candidate(_each("goods_revenue", lambda c: total_of(f"revenue_buy_{c}")), "revenue_buy_krw"),
        Candidate(_each("goods_revenue", lambda c: plain("0")), cases=(1, 3)),
        Candidate(_each("goods_revenue", lambda c: total_of(*[f"{goods}_{c}" for goods in FALLBACK_GOODS]))),
    ),
    "ship_date_kst": (Candidate({"ship_date_kst": plain("ship_at_kst")}, "ship_at_kst"), Candidate({"ship_date_kst": plain("CAST(NULL AS DATE)")})),
    "marked_up_cost_krw": (Candidate({"marked_up_cost_krw": plain("0")}),),
    "origin_usd_krw_package": (
        Candidate({"origin_usd_krw_package": plain("usd_krw_package")}, "usd_krw_package"),
        Candidate({"origin_usd_krw_package": plain("1450")}),
    ),
}


def standardize(df: DataFrame, case: int) -> DataFrame:
    """Fill in measure columns an older result lacks, from what it does have, by the table of candidates."""
    have = set(df.columns)
    new: dict[str, str] = {}
    for missing in RESOLVED.keys() - have:
        fitting = (c for c in RESOLVED[missing] if (c.needs is None or c.needs in have) and (not c.cases or case in c.cases))
        new |= {name: sql(have) for name, sql in next(fitting).fills.items()}
    return add_columns(df, new) if new else df


def combine(cases: Mapping[int, DataFrame]) -> DataFrame:
    """One frame of all cases with revenue parts, top-level rows only.

    Revenue is the sum of its rounded parts, not the case's own total. Parts of profit are
    NULL wherever total profit is. Child rows are left out; frames of ``CaseQueries.parents`` do not compute them at all.
    """
    frames = []
    for case, df in cases.items():
        df = standardize(df, case)
        if case in (3, 4, 5) and "profit_case" in df.columns:
            df = df.filter(F.col("profit_case").cast("string").isin("3", "4", "5"))
        frames.append(_with_revenue_parts(df, f"'Case {case}'"))
    combined = frames[0]
    for frame in frames[1:]:
        combined = combined.unionByName(frame, allowMissingColumns=True)
    return combined


def combine_table(rows: DataFrame) -> DataFrame:
    """The same from one table of all case rows: child rows are pruned at the scan."""
    parents = rows.filter(F.col("profit_case").isin("1", "2", "3", "4", "5"))
    return _with_revenue_parts(parents, "CONCAT('Case ', profit_case)")


def _with_revenue_parts(df: DataFrame, source_case: str) -> DataFrame:
    have = set(df.columns)
    out = {
        name: f"`{name}`" if name in have else "NULL"
        for name in COMBINED
        if not name.startswith(("revenue", "profit", *PROFIT_PARTS))
    }
    out["source_case"] = source_case
    out["suite_number"] = f"COALESCE(CAST(suite_number AS STRING), '{UNKNOWN_SUITE}')"
    out["ship_date_kst"] = "try_cast(ship_date_kst AS DATE)"
    for c in CURRENCIES:
        parts = {f"revenue_{k}_{c}": f"COALESCE({v}_{c}, 0)" for k, v in REVENUE_PARTS.items()}
        out |= parts
        out[f"revenue_{c}"] = " + ".join(parts.values())
        out[f"profit_{c}"] = f"profit_{c}" if f"profit_{c}" in have else "0"
        for p in PROFIT_PARTS:
            value = f"COALESCE({p}_{c}, 0)" if f"{p}_{c}" in have else "0"
            out[f"{p}_{c}"] = f"CASE WHEN profit_krw IS NOT NULL THEN {value} END"
    return df.selectExpr(*[f"{out[name]} AS `{name}`" for name in COMBINED])


def without_admins(df: DataFrame) -> DataFrame:
    return df.filter(f"NOT {is_admin()}")


# KPI block -----------------------------------------------------------------------------

KPI_SUMS = {
    "total_profit": "profit",
    "total_revenue": "revenue",
    "total_buy_revenue": "revenue_buy",
    "total_storage_revenue": "revenue_storage",
    "total_ship_revenue": "revenue_ship",
}


def _distinct(df: DataFrame, column: str) -> Column:
    """Number of distinct values but NULL, as a scalar: combined on the map side, one row a value."""
    return df.select(column).where(F.col(column).isNotNull()).distinct().agg(F.count("*")).scalar()


def kpi_totals(df: DataFrame) -> DataFrame:
    """Totals, distinct packages and customers, and the period with measurable profit.

    Rows are summed per package first, so the number of packages is a plain count and no row is copied for a
    distinct count.
    """
    measures = [f"{col}_{c}" for col in KPI_SUMS.values() for c in CURRENCIES]
    eligible = "CASE WHEN profit_krw IS NOT NULL THEN ship_date_kst END"
    per_package = df.groupBy("package_id").agg(
        *[F.sum(m).alias(m) for m in measures], F.expr(f"MIN({eligible}) AS _first"), F.expr(f"MAX({eligible}) AS _last")
    )
    sums = [F.expr(f"CAST(COALESCE(SUM({col}_krw), 0) AS BIGINT) AS {name}") for name, col in KPI_SUMS.items()]
    usd = [F.expr(f"BROUND(COALESCE(SUM({col}_usd), 0), 2) AS {name}_usd") for name, col in KPI_SUMS.items()]
    totals = per_package.agg(
        *sums,
        F.count("package_id").alias("total_packages"),
        *usd,
        F.expr("CAST(MIN(_first) AS STRING) AS profit_start_date"),
        F.expr("CAST(MAX(_last) AS STRING) AS profit_end_date"),
    )
    days = df.selectExpr(f"{eligible} AS _day")
    return totals.select("*", _distinct(df, "suite_number").alias("total_customers"), _distinct(days, "_day").alias("profit_days"))


def median_exchange_rate(df: DataFrame) -> DataFrame:
    """Median of the positive posted rates, 1450 without any."""
    rates = df.selectExpr(
        "CASE WHEN origin_usd_krw_package > 0 THEN CAST(origin_usd_krw_package * 100 AS BIGINT) END AS value"
    )
    median = describe(rates, {"rate": "value"}, {"median": 0.5})
    rate = "BROUND(CAST(median AS DECIMAL(20,1)) / 100, 2)"
    return median.selectExpr(f"CASE WHEN count > 0 THEN CAST({rate} AS DOUBLE) ELSE 1450D END AS exchange_rate")


def kpis(df: DataFrame, updated_at_utc: str | None = None) -> DataFrame:
    """The KPI block; ``updated_at_utc`` is a parameter so that results can be repeated."""
    block = kpi_totals(df).withColumn("exchange_rate", median_exchange_rate(df).scalar())
    stamp = kst_minute(f"TIMESTAMP '{updated_at_utc}'") if updated_at_utc else "CAST(NULL AS STRING)"
    return add_columns(block, {"last_updated": stamp})


# Statistics ----------------------------------------------------------------------------

PACKAGE_METRICS = [
    "revenue_krw",
    "revenue_buy_krw",
    "revenue_storage_krw",
    "revenue_ship_krw",
    "profit_krw",
    "goods_profit_krw",
    "warehouse_profit_krw",
    "shipping_profit_krw",
    "marked_up_cost_krw",
]


def package_statistics(df: DataFrame) -> DataFrame:
    return describe(df, {m: m for m in PACKAGE_METRICS})


# Case summary --------------------------------------------------------------------------

SUMMED = [
    *[f"{name}_{c}" for c in CURRENCIES for name in ["revenue", *[f"revenue_{p}" for p in REVENUE_PARTS]]],
    *[f"{name}_{c}" for c in CURRENCIES for name in ["profit", *PROFIT_PARTS]],
]
HAS_COST = "COALESCE(original_cost_krw > 0, FALSE)"


def _weight(column: str) -> str:
    return f"try_cast({column} AS DOUBLE)"


def exact_weight(column: str) -> str:
    """A weight in decimals, so that sums do not depend on the order of rows; digits beyond the fourth are cut."""
    return f"CAST({_weight(column)} AS DECIMAL(20,4))"


def case_summary(df: DataFrame) -> DataFrame:
    """Sums, distinct counts and per-package and per-suite ratios of each case.

    Distinct counts are counts of rows grouped per package and per suite, of which a flag says whether any has a profit.
    """
    weights = {
        "package_weight": exact_weight("package_weight"),
        "dimension_weight": exact_weight("dimension_weight"),
        "total_act_weight_profit": f"CASE WHEN {HAS_COST} THEN {exact_weight('package_weight')} END",
        "total_dim_weight_profit": f"CASE WHEN {HAS_COST} THEN {exact_weight('dimension_weight')} END",
    }
    profit = F.expr("MAX(CASE WHEN profit_krw IS NOT NULL THEN 1 ELSE 0 END) AS _profit")
    per_package = df.groupBy("source_case", "package_id").agg(
        profit, *[F.sum(c).alias(c) for c in SUMMED], *[F.expr(f"SUM({sql}) AS {name}") for name, sql in weights.items()]
    )
    counted = "CASE WHEN {} IS NOT NULL THEN _profit END"
    packages = per_package.groupBy("source_case").agg(
        F.count("package_id").alias("package_id"),
        *[F.expr(f"COALESCE(SUM({c}), 0) AS {c}") for c in SUMMED],
        *[F.expr(f"COALESCE(CAST(SUM({name}) AS DOUBLE), 0D) AS {name}") for name in weights],
        F.expr(f"COALESCE(SUM({counted.format('package_id')}), 0) AS profit_pkg_count"),
    )
    per_suite = df.groupBy("source_case", "suite_number").agg(profit)
    suites = per_suite.groupBy("source_case").agg(
        F.count("suite_number").alias("suite_count"), F.expr(f"COALESCE(SUM({counted.format('suite_number')}), 0) AS profit_suite_count")
    )
    sums = packages.join(suites, "source_case")

    def ratio(top: str, count: str) -> str:
        return f"CAST({top} AS DOUBLE) / GREATEST({count}, 1)"

    ratios = {
        "profit_per_pkg": ratio("profit_krw", "profit_pkg_count"),
        "profit_per_suite": ratio("profit_krw", "profit_suite_count"),
        "profit_per_pkg_usd": ratio("profit_usd", "profit_pkg_count"),
        "profit_per_suite_usd": ratio("profit_usd", "profit_suite_count"),
        "revenue_per_pkg": ratio("revenue_krw", "package_id"),
        "revenue_per_suite": ratio("revenue_krw", "suite_count"),
        "revenue_per_pkg_usd": ratio("revenue_usd", "package_id"),
        "revenue_per_suite_usd": ratio("revenue_usd", "suite_count"),
        "avg_act_weight_pkg": one_decimal("package_weight", "package_id"),
        "avg_dim_weight_pkg": one_decimal("dimension_weight", "package_id"),
        "avg_act_weight_pkg_profit": one_decimal("total_act_weight_profit", "profit_pkg_count"),
        "avg_dim_weight_pkg_profit": one_decimal("total_dim_weight_profit", "profit_pkg_count"),
        "case_name": case_name(),
    }
    return add_columns(sums, ratios)


def one_decimal(total: str, count: str) -> str:
    """A mean rounded half to even to one decimal; the tie is judged on exact decimals."""
    return f"CAST(BROUND(CAST({total} AS DECIMAL(24,3)) / CAST(GREATEST({count}, 1) AS DECIMAL(12,0)), 1) AS DOUBLE)"


# Suites --------------------------------------------------------------------------------

SUITE_TOTALS = {
    "total_revenue": "revenue_krw",
    "total_rev_buy": "revenue_buy_krw",
    "total_rev_storage": "revenue_storage_krw",
    "total_rev_ship": "revenue_ship_krw",
    "total_profit": "profit_krw",
    "total_buy_profit": "goods_profit_krw",
    "total_storage_profit": "warehouse_profit_krw",
    "total_ship_profit": "shipping_profit_krw",
    "total_markup": "marked_up_cost_krw",
    "total_revenue_usd": "revenue_usd",
    "total_rev_buy_usd": "revenue_buy_usd",
    "total_rev_storage_usd": "revenue_storage_usd",
    "total_rev_ship_usd": "revenue_ship_usd",
    "total_profit_usd": "profit_usd",
    "total_buy_profit_usd": "goods_profit_usd",
    "total_storage_profit_usd": "warehouse_profit_usd",
    "total_ship_profit_usd": "shipping_profit_usd",
}
SUITE = ["suite_number"]


CASE_DETAIL = {
    "revenue": "revenue_krw",
    "profit": "profit_krw",
    "buy": "revenue_buy_krw",
    "storage": "revenue_storage_krw",
    "ship": "revenue_ship_krw",
    "revenue_usd": "revenue_usd",
    "profit_usd": "profit_usd",
    "buy_usd": "revenue_buy_usd",
    "storage_usd": "revenue_storage_usd",
    "ship_usd": "revenue_ship_usd",
}



#: Country codes are numbered AA = 0 to ZZ = 675; a package's are bits of as many words.
_LETTERS, _BITS = 26, 60
_WORDS = -(-_LETTERS * _LETTERS // _BITS)
_CODE = f"(ascii(country_code) - 65) * {_LETTERS} + ascii(substr(country_code, 2, 1)) - 65"


def _code_text(number: str) -> str:
    return f"CONCAT(chr(65 + {number} DIV {_LETTERS}), chr(65 + {number} % {_LETTERS}))"


def _codes_of_bits() -> str:
    """The country codes of a package from its words of bits."""
    bits = " ".join(f"WHEN {k} THEN _c{k}" for k in range(_WORDS))
    code = _code_text("x")
    held = f"(shiftright(CASE x DIV {_BITS} {bits} END, x % {_BITS}) & 1) = 1"
    return f"transform(filter(sequence(0, {_LETTERS * _LETTERS - 1}), x -> {held}), x -> {code})"


def suite_rows(df: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """One row per suite: every scalar, the weight histograms, and maps of its cases and countries, in one pass.

    The first step adds amounts up by suite and case, which the map side combines, and what packages show, as bits, by suite
    and package, so a very large suite is spread over its packages, and a distinct count of packages that meet a
    condition becomes a sum of flags: no set of packages is ever held per suite, and amounts take no part in it.
    All its buffers have a fixed width, or the aggregate would have to sort its rows.
    The second step groups by suite and country; a package in several countries counts once in the flags and
    once in each of them. The third adds cases and countries of a suite up.
    """
    keys = keys or SUITE
    parents = ", ".join(f"'{t}'" for t in PARENT_TYPES)
    weights = {"package": "package_weight", "dim": "dimension_weight"}
    numbers = range(len(CASE_NAMES))
    measures = {
        **SUITE_TOTALS,
        **{f"_w_{n}": exact_weight(c) for n, c in weights.items()},
        **{f"_x_{n}": f"CASE WHEN {HAS_COST} THEN {exact_weight(c)} END" for n, c in weights.items()},
    }
    # What a package shows, a bit each: is it a parent, has it profit, has it cost, its cases, and the bins of both weights.
    shown = [f"package_type IN ({parents})", "profit_krw IS NOT NULL", HAS_COST, *[f"source_case = '{name}'" for name in CASE_NAMES]]
    bits = [f"IF({test}, shiftleft(1, {i}), 0)" for i, test in enumerate(shown)]
    bits += [f"COALESCE(shiftleft(1, {len(shown) + i * len(WEIGHT_LABELS)} + {weight_bin(c)}), 0)" for i, c in enumerate(weights.values())]
    # A row counts twice: with its amounts in its case, and with what it shows in its package.
    sides = "inline(array(named_struct('_sums', TRUE, '_case', source_case, '_package', IF(FALSE, package_id, NULL)), named_struct('_sums', FALSE, '_case', IF(FALSE, source_case, NULL), '_package', package_id)))"
    rows = df.selectExpr(
        *keys,
        "source_case",
        "package_id",
        *[f"{sql} AS {name}" for name, sql in measures.items()],
        *[f"{_weight(c)} IS NOT NULL AS _n_{n}" for n, c in weights.items()],
        f"{' | '.join(bits)} AS _shows",
        f"CASE WHEN {is_country_code()} THEN {_CODE} END AS _code",
    ).selectExpr("*", sides)
    grouped = rows.groupBy(*keys, "_sums", "_case", "_package").agg(
        *[F.expr(f"SUM(CASE WHEN _sums THEN {name} END) AS {name}") for name in measures],
        *[F.expr(f"COUNT_IF(_sums AND _n_{n}) AS _n_{n}") for n in weights],
        F.expr("BIT_OR(IF(_sums, 0, _shows)) AS _shows"),
        F.expr("MIN(CASE WHEN NOT _sums THEN _code END) AS _first"),
        F.expr("MAX(CASE WHEN NOT _sums THEN _code END) AS _last"),
        *[F.expr(f"BIT_OR(CASE WHEN NOT _sums AND _code DIV {_BITS} = {k} THEN shiftleft(1L, CAST(_code % {_BITS} AS INT)) ELSE 0L END) AS _c{k}") for k in range(_WORDS)],
    )
    # A package of one country, or of none, is one row; of several, a row for what it shows and one for each country.
    one = f"array(named_struct('country', {_code_text('_first')}, 'shows', NOT _sums))"
    several = f"concat(array(named_struct('country', CAST(NULL AS STRING), 'shows', TRUE)), transform({_codes_of_bits()}, c -> named_struct('country', c, 'shows', FALSE)))"
    placed = grouped.selectExpr("*", f"explode(IF(_first IS NULL OR _first = _last, {one}, {several})) AS _in").drop("_first", "_last", *[f"_c{k}" for k in range(_WORDS)])

    def shows(bit: int) -> str:
        return f"SUM(CASE WHEN _in.shows THEN shiftright(_shows, {bit}) & 1 END)"

    def packages(flag: str) -> str:
        # A NULL package id is a group of its own here, but not a package.
        return f"SUM(CASE WHEN _in.shows AND _package IS NOT NULL THEN {flag} END)"

    flags = {"total_packages": "1"}
    names = ["console_packages", "profit_pkg_count", "cost_pkg_count", *[f"_k{k}" for k in numbers]]
    flags |= {name: f"shiftright(_shows, {i}) & 1" for i, name in enumerate(names)}
    bins = [f"_b_{n}_{i}" for n in weights for i in range(len(WEIGHT_LABELS))]
    by_country = placed.groupBy(*keys, "_sums", "_case", F.col("_in.country").alias("_country")).agg(
        *[F.sum(name).alias(name) for name in measures],
        *[F.sum(f"_n_{n}").alias(f"_n_{n}") for n in weights],
        *[F.expr(f"{packages(sql)} AS {name}") for name, sql in flags.items()],
        *[F.expr(f"{shows(len(shown) + i)} AS {name}") for i, name in enumerate(bins)],
        F.count("_package").alias("_here"),
    )
    counted = "collect_list(CASE WHEN _country IS NOT NULL THEN named_struct('k', _country, 'v', _here) END)"

    def histogram(n: str) -> str:
        counts = ", ".join(f"'{label}', COALESCE(SUM(_b_{n}_{i}), 0)" for i, label in enumerate(WEIGHT_LABELS))
        return f"map_filter(map({counts}), (k, v) -> v > 0)"

    summed = [*measures, *[f"_n_{n}" for n in weights]]
    type_of = {f.name: f.dataType.simpleString() for f in by_country.schema}
    held = ", ".join(f"'{name}', {name}" for name in summed)

    def case_stats() -> str:
        # A case is listed where it has rows, even if none of them has a package id.
        known = ", ".join(f"'{name}'" for name in CASE_NAMES)
        total = {source: name for name, source in SUITE_TOTALS.items()}
        count = " ".join(f"WHEN '{name}' THEN COALESCE(_k{k}, 0)" for k, name in enumerate(CASE_NAMES))
        fields = ", ".join(f"'{f}', COALESCE(s.{total[source]}, 0)" for f, source in CASE_DETAIL.items())
        cases = f"filter(array_sort(_cases), s -> s.k IN ({known}))"
        return f"map_from_entries(transform({cases}, s -> struct(s.k, named_struct('count', CASE s.k {count} END, {fields}))))"

    def total_of_cases(name: str) -> str:
        kind = type_of[name]
        return f"aggregate(_cases, CAST(0 AS {kind}), (sum, s) -> CAST(sum + COALESCE(s.{name}, 0) AS {kind}))"

    # Amounts come once, in the list of cases: beside it, sums of them would double what is shuffled.
    totals = by_country.groupBy(*keys).agg(
        F.expr(f"collect_list(CASE WHEN _sums THEN named_struct('k', _case, {held}) END) AS _cases"),
        *[F.expr(f"COALESCE(SUM({name}), 0) AS {name}") for name in flags],
        F.expr(f"{histogram('package')} AS weight_bins_actual"),
        F.expr(f"{histogram('dim')} AS weight_bins_volumetric"),
        F.expr(f"map_from_entries(array_sort({counted})) AS country_counts"),
    )
    totals = totals.selectExpr(
        *keys,
        *[f"{total_of_cases(name)} AS {name}" for name in SUITE_TOTALS],
        "total_packages", "profit_pkg_count", "console_packages", "cost_pkg_count",
        *[f"{total_of_cases(f'_w_{n}')} AS total_{n}_weight" for n in weights],
        *[f"{total_of_cases(f'_n_{n}')} AS _n_{n}" for n in weights],
        *[f"{total_of_cases(f'_x_{n}')} AS total_{n}_weight_cost" for n in weights],
        "weight_bins_actual",
        "weight_bins_volumetric",
        f"{case_stats()} AS case_stats",
        "country_counts",
    )
    means = {f"avg_{n}_weight": f"CASE WHEN _n_{n} > 0 THEN {one_decimal(f'total_{n}_weight', f'_n_{n}')} END" for n in weights}
    sums = {
        c: f"CAST(BROUND(CAST({c} AS DECIMAL(24,3)), 1) AS DOUBLE)"
        for n in weights
        for c in (f"total_{n}_weight", f"total_{n}_weight_cost")
    }
    more = {"shipping_countries": "SIZE(country_counts)"}
    return add_columns(totals, {**means, **sums, **more}).drop(*[f"_n_{n}" for n in weights])


NESTED = ["case_stats", "country_counts", "shipping_countries"]


def suite_totals(df: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """The scalars of a suite and its weight histograms."""
    return suite_rows(df, keys).drop(*NESTED)


def suite_case_detail(df: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Packages and sums per suite and case, again by way of packages."""
    keys = keys or SUITE
    per_package = df.groupBy(*keys, "source_case", "package_id").agg(
        *[F.expr(f"SUM({source}) AS {name}") for name, source in CASE_DETAIL.items()]
    )
    return per_package.groupBy(*keys, "source_case").agg(
        F.count("package_id").alias("count"),
        *[F.expr(f"COALESCE(SUM({name}), 0) AS {name}") for name in CASE_DETAIL],
    )


def suite_countries(df: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Distinct packages per suite and valid country code."""
    keys = keys or SUITE
    pairs = df.filter(is_country_code()).select(*keys, "country_code", "package_id").distinct()
    return pairs.groupBy(*keys, "country_code").agg(F.count("package_id").alias("count"))


def suite_weight_histogram(df: DataFrame) -> DataFrame:
    """Distinct packages per suite and weight bin, for actual and volumetric weight."""
    weighed = df.selectExpr(
        "suite_number",
        "package_id",
        f"stack(2, 'actual', {weight_bin('package_weight')}, 'volumetric', {weight_bin('dimension_weight')}) AS (kind, bin)",
    ).filter("bin IS NOT NULL")
    labels = ", ".join(f"'{label}'" for label in WEIGHT_LABELS)
    return (
        weighed.distinct()
        .groupBy("suite_number", "kind", "bin")
        .agg(F.count("package_id").alias("packages"))
        .selectExpr("suite_number", "kind", f"element_at(array({labels}), bin + 1) AS bin", "packages")
    )


def with_percentiles(totals: DataFrame, group: list[str]) -> DataFrame:
    """Revenue and profit percentiles of suites, within each ``group``."""
    values = {"rev_percentile": "total_revenue", "profit_percentile": "total_profit"}
    return add_columns(with_percentile_ranks(totals, [*group, *SUITE], group, values), {"percentile": "rev_percentile"})


def suite_profiles(df: DataFrame, period: list[str] | None = None) -> DataFrame:
    """One row per suite (and period): scalars, percentiles and nested maps.

    The maps hold at most five cases, six bins and the countries of the two-letter code space.
    """
    period = period or []
    return with_percentiles(suite_rows(df, [*period, *SUITE]), period)


def with_ship_year(df: DataFrame) -> DataFrame:
    return df.filter("ship_date_kst IS NOT NULL").withColumn("ship_year", F.year("ship_date_kst"))


def suite_profiles_by_year(df: DataFrame) -> DataFrame:
    return suite_profiles(with_ship_year(df), ["ship_year"])


def available_years(df: DataFrame) -> DataFrame:
    return with_ship_year(df).select("ship_year").distinct().orderBy("ship_year")


SUITE_METRICS = ["total_revenue", "total_rev_buy", "total_rev_storage", "total_rev_ship", "total_profit", "total_markup", "total_packages"]


def suite_statistics(totals: DataFrame) -> DataFrame:
    return describe(totals, {m: m for m in SUITE_METRICS})


PAGE_METRICS = {
    "total_profit": True,
    "total_buy_profit": True,
    "total_storage_profit": True,
    "total_ship_profit": True,
    "total_revenue": False,
    "total_rev_buy": False,
    "total_rev_storage": False,
    "total_rev_ship": False,
}


def suite_distribution(totals: DataFrame) -> DataFrame:
    """Distribution over suites; profit figures only over suites with measurable profit."""
    values = {m: f"CASE WHEN profit_pkg_count > 0 THEN {m} END" if needs else m for m, needs in PAGE_METRICS.items()}
    return describe(totals, values).drop("std")


PAGE_KPIS = {
    "total_profit": "total_profit",
    "buy_profit": "total_buy_profit",
    "storage_profit": "total_storage_profit",
    "ship_profit": "total_ship_profit",
    "total_revenue": "total_revenue",
    "total_buy_revenue": "total_rev_buy",
    "total_storage_revenue": "total_rev_storage",
    "total_ship_revenue": "total_rev_ship",
}


def page_kpis(totals: DataFrame, exclude_admins: bool = False) -> DataFrame:
    """KPIs summed again from suites: a package with two suites counts for both."""
    if exclude_admins:
        totals = without_admins(totals)
    weights = ["total_package_weight", "total_dim_weight", "total_package_weight_cost", "total_dim_weight_cost"]
    sums = totals.agg(
        *[F.expr(f"COALESCE(SUM({c}), 0) AS {name}") for name, c in PAGE_KPIS.items()],
        *[F.expr(f"COALESCE(SUM({c}_usd), 0) AS {name}_usd") for name, c in PAGE_KPIS.items()],
        F.expr("COALESCE(SUM(total_packages), 0) AS total_packages"),
        F.expr("COUNT(*) AS total_customers"),
        F.expr("COALESCE(SUM(cost_pkg_count), 0) AS cost_pkg_count"),
        F.expr("COUNT_IF(cost_pkg_count > 0) AS cost_customers"),
        *[F.expr(f"COALESCE(SUM({w}), 0D) AS {w}") for w in weights],
    )

    def mean(total: str, count: str) -> str:
        return f"COALESCE(try_divide({total}, {count}), 0D)"

    return add_columns(
        sums,
        {
            "avg_package_weight": mean("total_package_weight", "total_packages"),
            "avg_dim_weight": mean("total_dim_weight", "total_packages"),
            "avg_package_weight_cost": mean("total_package_weight_cost", "cost_pkg_count"),
            "avg_dim_weight_cost": mean("total_dim_weight_cost", "cost_pkg_count"),
        },
    )


# Splits and rankings -------------------------------------------------------------------


def revenue_split(df: DataFrame, by_case: bool = False) -> DataFrame:
    """Revenue by part, in KRW cut to whole numbers and USD to two decimals."""
    grouped = df.groupBy("source_case") if by_case else df.groupBy()
    return grouped.agg(
        *[F.expr(f"CAST(COALESCE(SUM(revenue_{p}_krw), 0) AS BIGINT) AS {p}") for p in REVENUE_PARTS],
        *[F.expr(f"BROUND(COALESCE(SUM(revenue_{p}_usd), 0), 2) AS {p}_usd") for p in REVENUE_PARTS],
    )


def split_shares(split: DataFrame, scope: str) -> DataFrame:
    """Each part's percentage of its scope's total, one decimal."""
    pairs = ", ".join(f"'{p}', {p}" for p in REVENUE_PARTS)
    share = "CAST(amount AS DECIMAL(20,0)) * 100 / CAST(SUM(amount) OVER (PARTITION BY scope) AS DECIMAL(18,0))"
    return split.selectExpr(f"{scope} AS scope", f"stack({len(REVENUE_PARTS)}, {pairs}) AS (part, amount)").selectExpr(
        "scope", "part", "amount", f"CAST(CASE WHEN amount > 0 THEN ROUND({share}, 1) END AS DOUBLE) AS share_pct"
    )


def top_suites(totals: DataFrame, n: int = 50) -> DataFrame:
    """The ``n`` suites with the highest revenue."""
    return totals.orderBy(F.col("total_revenue").desc(), "suite_number").limit(n)


def top_profiles(totals: DataFrame, n: int = 50) -> DataFrame:
    """The same with their percentiles among all suites, which are ranked without their other columns."""
    ranks = with_percentiles(totals.select(*SUITE, "total_revenue", "total_profit"), []).drop("total_revenue", "total_profit")
    first = top_suites(totals, n)
    ranked = first.join(ranks.withColumnsRenamed({c: f"_of_{c}" for c in SUITE}), F.col("suite_number").eqNullSafe(F.col("_of_suite_number")), "left")
    return top_suites(ranked.drop(*[f"_of_{c}" for c in SUITE]), n)


def concentration(totals: DataFrame) -> DataFrame:
    """How many suites are in the top percent, and what the top tenth contributes."""
    ranked = with_percentile_ranks(totals.select(*SUITE, "total_revenue"), SUITE, [], {"_percentile": "total_revenue"})
    highest = ranked.agg(F.count_if(F.col("_percentile") >= 99).alias("n")).scalar()
    share = "CAST(top AS DOUBLE) / CAST(GREATEST(total, 1) AS DOUBLE) * 100"
    sums = top_share(totals, "total_revenue")
    return sums.select(highest.alias("top_1_percent_count"), F.expr(f"COALESCE({share}, 0D) AS top_10_percent_contribution"))


def search_suites(totals: DataFrame, query: str, exclude_admins: bool = False, n: int = 10) -> DataFrame:
    """First ``n`` suites whose number contains the upper-cased text; two characters at least."""
    text = query.upper()
    found = totals.filter(F.col("suite_number").contains(text) & F.lit(len(text) >= 2))
    if exclude_admins:
        found = without_admins(found)
    return found.select("suite_number", "total_profit", "total_profit_usd").orderBy("suite_number").limit(n)
