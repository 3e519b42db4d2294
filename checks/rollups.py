"""Roll-up checks in DuckDB SQL."""

from __future__ import annotations

from checks.base import with_views
from checks.cases import PARENT_PIECES, PIECES, steps_of

KRW_AMOUNTS = [
    "goods_revenue", "warehouse_revenue", "shipping_revenue", "profit",
    "goods_profit", "warehouse_profit", "shipping_profit",
]


def _combined() -> list[tuple[str, str]]:
    rows = " UNION ALL ".join(
        f"SELECT 'Case {i}' AS source_case, * FROM ({PIECES[name][0]})" for i, name in enumerate(PARENT_PIECES, start=1)
    )
    d = lambda c, s: f"CAST({c} AS DECIMAL(18,{s}))"
    cols = []
    for c, s in (("krw", 0), ("usd", 2)):
        parts = {p: d(f"{m}_{c}", s) for p, m in [("buy", "goods_revenue"), ("storage", "warehouse_revenue"), ("ship", "shipping_revenue")]}
        cols += [f"{sql} AS revenue_{p}_{c}" for p, sql in parts.items()]
        cols.append(f"{' + '.join(parts.values())} AS revenue_{c}")
        cols.append(f"{d(f'profit_{c}', s)} AS profit_{c}")
        for p in ("goods_profit", "warehouse_profit", "shipping_profit"):
            cols.append(f"CASE WHEN profit_krw IS NOT NULL THEN COALESCE({d(f'{p}_{c}', s)}, 0) END AS {p}_{c}")
    combined = f"""SELECT source_case, COALESCE(suite_number, 'Unknown') AS suite_number, package_id, package_type, country_code,
        package_weight, dimension_weight, CAST(ship_date_kst AS DATE) AS ship_date_kst,
        {d('origin_usd_krw_package', 2)} AS origin_usd_krw_package, {d('original_cost_krw', 0)} AS original_cost_krw,
        {d('marked_up_cost_krw', 0)} AS marked_up_cost_krw, {', '.join(cols)} FROM ({rows})"""
    return [*steps_of(*PARENT_PIECES), ("c", combined)]


COMBINED = _combined()
NO_ADMIN = ("c2", "SELECT * FROM c WHERE lower(suite_number) NOT IN ('z9996', 'z9997', 'z9998', 'z9999')")


def over_combined(body: str, *steps: tuple[str, str]) -> str:
    return with_views(body, *COMBINED, *steps)


def dbl(c: str, name: str) -> str:
    return f"CAST({c} AS DOUBLE) AS {name}"


def half_even(num: str, den: str) -> str:
    """num / den to one decimal, ties to even, in integers."""
    t, q = f"(CAST({num} AS HUGEINT) * 10)", f"CAST({den} AS HUGEINT)"
    down, rest = f"({t} // {q})", f"({t} % {q})"
    return f"({down} + CASE WHEN 2 * {rest} > {q} OR (2 * {rest} = {q} AND {down} % 2 = 1) THEN 1 ELSE 0 END) / 10.0"


def combined_rows() -> str:
    amounts = [f"{n}_{c}" for n in ["revenue", "revenue_buy", "revenue_storage", "revenue_ship", "profit", "goods_profit",
               "warehouse_profit", "shipping_profit"] for c in ("krw", "usd")]
    amounts += ["origin_usd_krw_package", "original_cost_krw", "marked_up_cost_krw"]
    return over_combined(
        f"""SELECT source_case, suite_number, package_id, package_type, country_code, package_weight, dimension_weight,
        CAST(ship_date_kst AS VARCHAR) AS ship_date_kst, {', '.join(dbl(a, a) for a in amounts)} FROM c"""
    )


MEDIAN = (
    "med",
    """SELECT CASE WHEN n = 0 THEN 1450 ELSE (CASE WHEN s % 2 = 1 THEN (s // 2) + (s // 2) % 2 ELSE s // 2 END) / 100.0 END AS rate
    FROM (SELECT len(l) AS n, l[(len(l) + 1) // 2] + l[len(l) // 2 + 1] AS s
          FROM (SELECT list_sort(list(CAST(origin_usd_krw_package * 100 AS BIGINT))) AS l FROM c WHERE origin_usd_krw_package > 0))""",
)


def kpi_block(stamp: str) -> str:
    names = {"profit": "profit", "revenue": "revenue", "buy_revenue": "revenue_buy", "storage_revenue": "revenue_storage", "ship_revenue": "revenue_ship"}
    krw = [f"CAST(SUM({c}_krw) AS BIGINT) AS total_{n}" for n, c in names.items()]
    usd = [dbl(f"SUM({c}_usd)", f"total_{n}_usd") for n, c in names.items()]
    return over_combined(
        f"""SELECT {', '.join(krw + usd)}, COUNT(DISTINCT package_id) AS total_packages,
        COUNT(DISTINCT suite_number) AS total_customers,
        CAST(MIN(ship_date_kst) FILTER (profit_krw IS NOT NULL) AS VARCHAR) AS profit_start_date,
        CAST(MAX(ship_date_kst) FILTER (profit_krw IS NOT NULL) AS VARCHAR) AS profit_end_date,
        COUNT(DISTINCT ship_date_kst) FILTER (profit_krw IS NOT NULL) AS profit_days,
        CAST((SELECT rate FROM med) AS DOUBLE) AS exchange_rate, '{stamp}' AS last_updated FROM c""",
        MEDIAN,
    )


def stats_select(source: str, group: str = "metric", std: bool = True) -> str:
    v = "CAST(value AS DOUBLE)"
    deviation = "ROUND(COALESCE(STDDEV_SAMP(CAST(value AS DOUBLE)), 0), 2) AS std," if std else ""
    return f"""SELECT {group}, COUNT(value) AS count, COALESCE(CAST(SUM(value) AS DOUBLE) / COUNT(value), 0) AS mean,
        {deviation} COALESCE(MIN({v}), 0) AS min, COALESCE(quantile_cont({v}, 0.25), 0) AS p25,
        COALESCE(quantile_cont({v}, 0.5), 0) AS p50, COALESCE(quantile_cont({v}, 0.75), 0) AS p75,
        COALESCE(MAX({v}), 0) AS max, COALESCE(CAST(SUM(value) AS DOUBLE), 0) AS sum FROM ({source}) GROUP BY {group}"""


def long(metrics: dict[str, str], source: str) -> str:
    return " UNION ALL ".join(f"SELECT '{m}' AS metric, CAST({sql} AS BIGINT) AS value FROM {source}" for m, sql in metrics.items())


PACKAGE_METRICS = ["revenue_krw", "revenue_buy_krw", "revenue_storage_krw", "revenue_ship_krw", "profit_krw",
                   "goods_profit_krw", "warehouse_profit_krw", "shipping_profit_krw", "marked_up_cost_krw"]


def package_statistics(admins: bool) -> str:
    source = "c" if admins else "c2"
    return over_combined(stats_select(long({m: m for m in PACKAGE_METRICS}, source)), NO_ADMIN)


SUMMED = [f"{n}_{c}" for c in ("krw", "usd") for n in ["revenue", "revenue_buy", "revenue_storage", "revenue_ship", "profit",
          "goods_profit", "warehouse_profit", "shipping_profit"]]


def case_summary(admins: bool) -> str:
    source = "c" if admins else "c2"
    one = lambda n: f"GREATEST({n}, 1)"
    ratios = []
    for n, per in [("pkg", "profit_pkg_count"), ("suite", "profit_suite_count")]:
        ratios += [f"CAST(profit_krw AS DOUBLE) / {one(per)} AS profit_per_{n}", f"CAST(profit_usd AS DOUBLE) / {one(per)} AS profit_per_{n}_usd"]
    for n, per in [("pkg", "package_id"), ("suite", "suite_count")]:
        ratios += [f"CAST(revenue_krw AS DOUBLE) / {one(per)} AS revenue_per_{n}", f"CAST(revenue_usd AS DOUBLE) / {one(per)} AS revenue_per_{n}_usd"]
    inner = f"""SELECT source_case, COUNT(DISTINCT package_id) AS package_id, COUNT(DISTINCT suite_number) AS suite_count,
        {', '.join(f'COALESCE(SUM({c}), 0) AS {c}' for c in SUMMED)},
        COALESCE(SUM(package_weight), 0) AS package_weight, COALESCE(SUM(dimension_weight), 0) AS dimension_weight,
        COUNT(DISTINCT package_id) FILTER (profit_krw IS NOT NULL) AS profit_pkg_count,
        COUNT(DISTINCT suite_number) FILTER (profit_krw IS NOT NULL) AS profit_suite_count,
        COALESCE(SUM(package_weight) FILTER (original_cost_krw > 0), 0) AS total_act_weight_profit,
        COALESCE(SUM(dimension_weight) FILTER (original_cost_krw > 0), 0) AS total_dim_weight_profit
        FROM {source} GROUP BY source_case"""
    names = {
        "Case 1": "배송대행(ASN) 단독",
        "Case 2": "구매대행(Buy Request) 단독",
        "Case 3": "배송대행(ASN) 합포장",
        "Case 4": "구매대행(Buy Request) 합포장",
        "Case 5": "배송대행(ASN) + 구매대행(Buy Request) 혼합",
    }
    label = "CASE source_case " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in names.items()) + " END AS case_name"
    return over_combined(
        f"""SELECT source_case, package_id, suite_count, {', '.join(dbl(c, c) for c in SUMMED)}, package_weight, dimension_weight,
        profit_pkg_count, profit_suite_count, total_act_weight_profit, total_dim_weight_profit, {', '.join(ratios)},
        {half_even('package_weight', one('package_id'))} AS avg_act_weight_pkg,
        {half_even('dimension_weight', one('package_id'))} AS avg_dim_weight_pkg,
        {half_even('total_act_weight_profit', one('profit_pkg_count'))} AS avg_act_weight_pkg_profit,
        {half_even('total_dim_weight_profit', one('profit_pkg_count'))} AS avg_dim_weight_pkg_profit, {label} FROM ({inner})""",
        NO_ADMIN,
    )


TOTALS = {
    "total_revenue": "revenue", "total_rev_buy": "revenue_buy", "total_rev_storage": "revenue_storage",
    "total_rev_ship": "revenue_ship", "total_profit": "profit", "total_buy_profit": "goods_profit",
    "total_storage_profit": "warehouse_profit", "total_ship_profit": "shipping_profit",
}
WEIGHTS = {"package": "package_weight", "dim": "dimension_weight"}


def _bin(c: str) -> str:
    tops = [1000, 3000, 5000, 10000, 20000]
    return f"CASE WHEN {c} >= 0 THEN " + " + ".join(f"CAST({c} > {t} AS INT)" for t in tops) + " END"


BIN_LABELS = "['~1kg', '1~3kg', '3~5kg', '5~10kg', '10~20kg', '20kg+']"


def suite_step(keys: str = "suite_number", source: str = "c") -> tuple[str, str]:
    sums = [f"COALESCE(SUM({c}_{u}), 0) AS {n}{'' if u == 'krw' else '_usd'}" for n, c in TOTALS.items() for u in ("krw", "usd")]
    cols = [*sums, "COALESCE(SUM(marked_up_cost_krw), 0) AS total_markup", "COUNT(DISTINCT package_id) AS total_packages",
            "COUNT(DISTINCT package_id) FILTER (profit_krw IS NOT NULL) AS profit_pkg_count",
            "COUNT(DISTINCT package_id) FILTER (package_type IN ('CONSOLE', 'REPACK')) AS console_packages",
            "COUNT(DISTINCT package_id) FILTER (original_cost_krw > 0) AS cost_pkg_count"]
    for n, w in WEIGHTS.items():
        cols += [f"COALESCE(SUM({w}), 0) AS total_{n}_weight", f"COALESCE(SUM({w}) FILTER (original_cost_krw > 0), 0) AS total_{n}_weight_cost",
                 f"CASE WHEN COUNT({w}) > 0 THEN {half_even(f'SUM({w})', f'COUNT({w})')} END AS avg_{n}_weight"]
    return ("s", f"SELECT {keys}, {', '.join(cols)} FROM {source} GROUP BY {keys}")


SCALARS = (
    [f"{n}{u}" for n in TOTALS for u in ("", "_usd")]
    + ["total_markup"]
)
COUNTS = ["total_packages", "profit_pkg_count", "console_packages", "cost_pkg_count"]
WEIGHT_COLUMNS = [f"{a}_{n}_weight{b}" for n in WEIGHTS for a, b in (("total", ""), ("total", "_cost"), ("avg", ""))]


BRACE_OPEN, BRACE_CLOSE = "{", "}"


def _json_step(name: str, keys: str, sort: str, entry: str, source: str) -> tuple[str, str]:
    text = f"'{BRACE_OPEN}' || string_agg({entry}, ',' ORDER BY {sort}) || '{BRACE_CLOSE}'"
    return (name, f"SELECT {keys}, {text} AS j, COUNT(*) AS k FROM ({source}) GROUP BY {keys}")


def bins_source(keys: str, weight: str, source: str) -> str:
    return f"""SELECT {keys}, {_bin(weight)} AS bin, COUNT(DISTINCT package_id) AS n FROM {source}
        WHERE {weight} >= 0 GROUP BY {keys}, {_bin(weight)}"""


def _detail(keys: str, source: str) -> str:
    names = {"revenue": "revenue", "profit": "profit", "buy": "revenue_buy", "storage": "revenue_storage", "ship": "revenue_ship"}
    sums = [f"COALESCE(SUM({c}_{u}), 0) AS {n}{'' if u == 'krw' else '_usd'}" for u in ("krw", "usd") for n, c in names.items()]
    return f"SELECT {keys}, source_case, COUNT(DISTINCT package_id) AS count, {', '.join(sums)} FROM {source} GROUP BY {keys}, source_case"


DETAIL_NAMES = ["revenue", "profit", "buy", "storage", "ship", "revenue_usd", "profit_usd", "buy_usd", "storage_usd", "ship_usd"]


def _rank(value: str, part: str) -> str:
    over = f"PARTITION BY {part}" if part else ""
    ties = f"PARTITION BY {part + ', ' if part else ''}{value}"
    return f"""CAST(CEIL(CAST((2 * RANK() OVER ({over} ORDER BY {value}) + COUNT(*) OVER ({ties}) - 1) AS DOUBLE) / 2
        / COUNT(*) OVER ({over}) * 100) AS BIGINT)"""


def suite_totals() -> str:
    pieces = profile_pieces("suite_number", "c")
    return over_combined(
        f"SELECT s.suite_number, {_scalars()}, {_bins()} FROM s {_joins(('ba', 'bd'), 'suite_number')}", suite_step(), *pieces[:2]
    )


def _scalars() -> str:
    return ", ".join([*[dbl(f"s.{c}", c) for c in SCALARS], *[f"s.{c}" for c in COUNTS], *[dbl(f"s.{c}", c) for c in WEIGHT_COLUMNS]])


def _bins() -> str:
    return "COALESCE(ba.j, '{}') AS weight_bins_actual, COALESCE(bd.j, '{}') AS weight_bins_volumetric"


def _joins(names: tuple[str, ...], keys: str) -> str:
    return " ".join(f"LEFT JOIN {n} ON " + " AND ".join(f"{n}.{k} = s.{k}" for k in keys.split(", ")) for n in names)


def profile_pieces(keys: str, source: str) -> list[tuple[str, str]]:
    label = f"'\"' || {BIN_LABELS}[bin + 1] || '\":' || n"
    members = " || ',' || ".join(f"'\"{n}\":' || CAST({n} AS VARCHAR)" for n in ["count", *DETAIL_NAMES])
    country = f"""SELECT {keys}, country_code, COUNT(DISTINCT package_id) AS n FROM {source}
        WHERE regexp_full_match(country_code, '[A-Z][A-Z]') GROUP BY {keys}, country_code"""
    case_entry = f"'\"' || source_case || '\":{BRACE_OPEN}' || {members} || '{BRACE_CLOSE}'"
    country_entry = "'\"' || country_code || '\":' || n"
    return [
        _json_step("ba", keys, "bin", label, bins_source(keys, "package_weight", source)),
        _json_step("bd", keys, "bin", label, bins_source(keys, "dimension_weight", source)),
        _json_step("cs", keys, "source_case", case_entry, _detail(keys, source)),
        _json_step("cc", keys, "country_code", country_entry, country),
    ]


def suite_profiles(by_year: bool) -> str:
    keys, source = ("ship_year, suite_number", "cy") if by_year else ("suite_number", "c")
    year = ("cy", "SELECT *, CAST(year(ship_date_kst) AS INT) AS ship_year FROM c WHERE ship_date_kst IS NOT NULL")
    part = "s.ship_year" if by_year else ""
    return over_combined(
        f"""SELECT {', '.join('s.' + k for k in keys.split(', '))}, {_scalars()}, {_bins()}, cs.j AS case_stats,
        COALESCE(cc.j, '{{}}') AS country_counts, CAST(COALESCE(cc.k, 0) AS INT) AS shipping_countries,
        {_rank('s.total_revenue', part)} AS rev_percentile, {_rank('s.total_profit', part)} AS profit_percentile,
        {_rank('s.total_revenue', part)} AS percentile
        FROM s {_joins(('ba', 'bd', 'cs', 'cc'), keys)}""",
        year,
        suite_step(keys, source),
        *profile_pieces(keys, source),
    )


def suite_case_detail() -> str:
    return over_combined(
        f"SELECT suite_number, source_case, count, {', '.join(dbl(n, n) for n in DETAIL_NAMES)} FROM ({_detail('suite_number', 'c')})"
    )


def suite_countries() -> str:
    return over_combined(
        """SELECT suite_number, country_code, COUNT(DISTINCT package_id) AS count FROM c
        WHERE length(country_code) = 2 AND regexp_full_match(country_code, '[A-Z]+') GROUP BY ALL"""
    )


def weight_histogram() -> str:
    return over_combined(
        " UNION ALL ".join(
            f"SELECT suite_number, '{kind}' AS kind, {BIN_LABELS}[bin + 1] AS bin, n AS packages FROM ({bins_source('suite_number', w, 'c')})"
            for kind, w in [("actual", "package_weight"), ("volumetric", "dimension_weight")]
        )
    )


def suite_percentiles() -> str:
    return over_combined(
        f"""SELECT suite_number, {dbl('total_revenue', 'total_revenue')}, {dbl('total_profit', 'total_profit')},
        {_rank('total_revenue', '')} AS rev_percentile, {_rank('total_profit', '')} AS profit_percentile FROM s""",
        suite_step(),
    )


def available_years() -> str:
    return over_combined("SELECT DISTINCT CAST(year(ship_date_kst) AS INT) AS ship_year FROM c WHERE ship_date_kst IS NOT NULL")


def suite_statistics() -> str:
    metrics = ["total_revenue", "total_rev_buy", "total_rev_storage", "total_rev_ship", "total_profit", "total_markup", "total_packages"]
    return over_combined(stats_select(long({m: m for m in metrics}, "s")), suite_step())


def suite_distribution() -> str:
    profit = {m: f"CASE WHEN profit_pkg_count > 0 THEN {m} END" for m in ["total_profit", "total_buy_profit", "total_storage_profit", "total_ship_profit"]}
    revenue = {m: m for m in ["total_revenue", "total_rev_buy", "total_rev_storage", "total_rev_ship"]}
    return over_combined(stats_select(long({**profit, **revenue}, "s"), std=False), suite_step())


def page_kpis(admins: bool) -> str:
    names = {"total_profit": "total_profit", "buy_profit": "total_buy_profit", "storage_profit": "total_storage_profit",
             "ship_profit": "total_ship_profit", "total_revenue": "total_revenue", "total_buy_revenue": "total_rev_buy",
             "total_storage_revenue": "total_rev_storage", "total_ship_revenue": "total_rev_ship"}
    cols = [dbl(f"SUM({c}{u})", f"{n}{u}") for n, c in names.items() for u in ("", "_usd")]
    cols += ["CAST(SUM(total_packages) AS BIGINT) AS total_packages", "COUNT(*) AS total_customers",
             "CAST(SUM(cost_pkg_count) AS BIGINT) AS cost_pkg_count", "COUNT(*) FILTER (cost_pkg_count > 0) AS cost_customers"]
    for n in WEIGHTS:
        cols += [f"SUM(total_{n}_weight) AS total_{n}_weight", f"SUM(total_{n}_weight_cost) AS total_{n}_weight_cost",
                 f"SUM(total_{n}_weight) / SUM(total_packages) AS avg_{n}_weight",
                 f"SUM(total_{n}_weight_cost) / SUM(cost_pkg_count) AS avg_{n}_weight_cost"]
    return over_combined(f"SELECT {', '.join(cols)} FROM s", NO_ADMIN, suite_step(source="c" if admins else "c2"))


PARTS = ["buy", "storage", "ship"]


def revenue_split(by_case: bool, admins: bool = True) -> str:
    cols = [f"CAST(SUM(revenue_{p}_krw) AS BIGINT) AS {p}" for p in PARTS] + [dbl(f"SUM(revenue_{p}_usd)", f"{p}_usd") for p in PARTS]
    head = ["source_case"] if by_case else []
    tail = "GROUP BY source_case" if by_case else ""
    return over_combined(f"SELECT {', '.join(head + cols)} FROM {'c' if admins else 'c2'} {tail}", NO_ADMIN)


def split_shares() -> str:
    parts = " UNION ALL ".join(
        f"SELECT source_case AS scope, '{p}' AS part, CAST(SUM(revenue_{p}_krw) AS BIGINT) AS amount FROM c GROUP BY source_case" for p in PARTS
    )
    return over_combined(
        """SELECT scope, part, amount, CASE WHEN amount > 0 THEN
        (CAST(amount AS HUGEINT) * 2000 + t) // (2 * t) / 10.0 END AS share_pct
        FROM (SELECT *, CAST(SUM(amount) OVER (PARTITION BY scope) AS HUGEINT) AS t FROM parts)""",
        ("parts", parts),
    )


def top_suites() -> str:
    return f"SELECT * FROM ({suite_profiles(False)}) ORDER BY total_revenue DESC, suite_number LIMIT 50"


def page_amounts() -> str:
    return f"""SELECT suite_number, COALESCE(CAST(NULLIF(total_revenue_usd, 0) AS DOUBLE), CAST(total_revenue AS DOUBLE) / 1450) AS revenue_usd,
        total_package_weight / 1000 AS package_kg, total_dim_weight / 1000 AS dimension_kg,
        CASE WHEN cost_pkg_count = 0 THEN 0 ELSE total_package_weight_cost / cost_pkg_count END AS cost_weight
        FROM ({suite_totals()})"""


def older_results() -> str:
    """Each layout by what its columns hold, written out."""
    fees = ["storage_fee", "request_photo_fee", "repack_fee", "bubble_wrap_fee", "vacuum_repack_fee", "plasticbox_fee", "remove_papertube_fee", "inclusion_fee", "bfm_extra_fee"]
    goods = ["total_goods_price", "domestic_shipping_price", "fee_handling_fee", "pg_fee", "service_fee", "surtax"]
    add = lambda names, c: " + ".join(f"CAST(COALESCE({n}_{c}, 0) AS DECIMAL(18,2))" for n in names)
    parts = []
    for case, piece in ((1, "case_1"), (4, "case_4_parents")):
        body = f"FROM ({PIECES[piece][0]})"
        head = f"{case} AS case_number, package_id"
        parts.append(f"""SELECT 'named otherwise' AS layout, {head}, goods_revenue_krw, goods_revenue_usd, warehouse_revenue_krw, warehouse_revenue_usd,
            shipping_revenue_krw, shipping_revenue_usd, ship_date_kst, 0 AS marked_up_cost_krw, usd_krw_package AS origin_usd_krw_package {body}""")
        own = ["0", "0"] if case == 1 else [add(goods, "krw"), add(goods, "usd")]
        parts.append(f"""SELECT 'fees only', {head}, {own[0]}, {own[1]}, {add(fees, 'krw')}, {add(fees, 'usd')},
            COALESCE(shipping_fee_krw, 0), COALESCE(shipping_fee_usd, 0), ship_date_kst, marked_up_cost_krw, origin_usd_krw_package {body}""")
        exact = "CAST(COALESCE(shipping_fee_usd, 0) * 100 AS HUGEINT) * CAST(ROUND(COALESCE(usd_krw_package, 1450) * 100) AS HUGEINT)"
        down, rest = f"(({exact}) // 10000)", f"(({exact}) % 10000)"
        even = f"({down} + CASE WHEN {rest} > 5000 OR ({rest} = 5000 AND {down} % 2 = 1) THEN 1 ELSE 0 END)"
        parts.append(f"""SELECT 'dollars only', {head}, 0, 0, COALESCE(storage_fee_krw, 0), 0, {even}, COALESCE(shipping_fee_usd, 0), NULL, 0, usd_krw_package {body}""")
    names = ["goods_revenue_krw", "goods_revenue_usd", "warehouse_revenue_krw", "warehouse_revenue_usd", "shipping_revenue_krw", "shipping_revenue_usd", "marked_up_cost_krw", "origin_usd_krw_package"]
    columns = ", ".join(f"CAST({n} AS DOUBLE) AS {n}" for n in names)
    return with_views(f"SELECT layout, case_number, package_id, ship_date_kst, {columns} FROM ({' UNION ALL '.join(parts)})", *steps_of("case_1", "case_4_parents"))


def exported_cases() -> str:
    columns = "package_id, profit_case, inner_package_id, revenue_krw, profit_usd, ship_date_kst AS ship_date"
    rows = " UNION ALL ".join(f"SELECT * FROM ({PIECES[n][0]})" for n in ("case_4_parents", "case_4_children"))
    return with_views(f"SELECT {columns}, 'reference_type,revenue_krw,revenue_usd' AS beside_reference FROM ({rows})", *steps_of("case_4_parents", "case_4_children"))


def dashboard_file() -> str:
    columns = "source_case, buy, storage, ship, buy_usd, storage_usd, ship_usd"
    return f"""SELECT 'revenue_split' AS section, {columns.replace('source_case', 'NULL AS source_case')} FROM ({revenue_split(False)})
        UNION ALL SELECT 'case_revenue_splits', {columns} FROM ({revenue_split(True)})"""


def concentration() -> str:
    return over_combined(
        f"""SELECT COUNT(*) FILTER (pct >= 99) AS top_1_percent_count,
        CAST(SUM(total_revenue) FILTER (rn <= GREATEST(1, n // 10)) AS DOUBLE) / GREATEST(CAST(SUM(total_revenue) AS BIGINT), 1) * 100
            AS top_10_percent_contribution
        FROM (SELECT total_revenue, {_rank('total_revenue', '')} AS pct, ROW_NUMBER() OVER (ORDER BY total_revenue DESC) AS rn,
              COUNT(*) OVER () AS n FROM s)""",
        suite_step(),
    )


def suite_search(text: str) -> str:
    return over_combined(
        f"""SELECT suite_number, {dbl('total_profit', 'total_profit')}, {dbl('total_profit_usd', 'total_profit_usd')} FROM s
        WHERE contains(suite_number, '{text}') ORDER BY suite_number LIMIT 10""",
        NO_ADMIN,
        suite_step(source="c2"),
    )
