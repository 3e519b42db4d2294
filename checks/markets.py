"""Competitor, weekly and tier checks in DuckDB SQL."""

from __future__ import annotations

from checks.base import with_views
from checks.cases import BOUGHT_STEPS, COST_TOP, FX_DAILY, FEE, ITEM_SUMS, PIECES, items, steps_of


def half_even(num: str, den: str, digits: int = 1) -> str:
    """num / den for whole numbers, den > 0: rounded to ``digits``, ties to even."""
    scale = 10**digits
    t, q = f"(ABS(CAST({num} AS HUGEINT)) * {scale})", f"CAST({den} AS HUGEINT)"
    down, rest = f"({t} // {q})", f"({t} % {q})"
    up = f"CASE WHEN 2 * {rest} > {q} OR (2 * {rest} = {q} AND {down} % 2 = 1) THEN 1 ELSE 0 END"
    return f"CAST(SIGN(CAST({num} AS HUGEINT)) * ({down} + {up}) AS DOUBLE) / {scale}.0"


OWN, RIVALS = "('own')", "('rival_a', 'rival_b')"
CLASS = "CASE WHEN carrier = 'k-packet' THEN 'standard' WHEN carrier IN ('DHL', 'EMS', 'FEDEX', 'UPS') THEN 'express' END"


def _gaps(source: str, rivals: str = RIVALS) -> str:
    cols, joins = [], []
    for c in ("standard", "express"):
        joins.append(
            f"""LEFT JOIN (SELECT country, weight, fee, carrier FROM (SELECT country, weight, fee, carrier,
                ROW_NUMBER() OVER (PARTITION BY country, weight ORDER BY fee, carrier) AS rn FROM priced
                WHERE class = '{c}' AND platform IN {OWN}) WHERE rn = 1) o{c} ON o{c}.country = g.country AND o{c}.weight = g.weight
            LEFT JOIN (SELECT country, weight, MIN(fee) AS fee FROM priced WHERE class = '{c}' AND platform IN {rivals}
                GROUP BY country, weight) r{c} ON r{c}.country = g.country AND r{c}.weight = g.weight"""
        )
        both = f"o{c}.fee IS NOT NULL AND r{c}.fee IS NOT NULL"
        gap = half_even(f"(o{c}.fee - r{c}.fee) * 100", f"r{c}.fee")
        for name, sql in [(f"gap_{c}_pct", gap), (f"{c}_cheapest_fee", f"o{c}.fee"), (f"{c}_cheapest_carrier", f"o{c}.carrier"),
                          (f"competitor_{c}_min", f"r{c}.fee")]:
            cols.append(f"CASE WHEN {both} THEN {sql} END AS {name}")
    return f"SELECT g.country, g.weight, {', '.join(cols)} FROM (SELECT DISTINCT country, weight FROM priced) g {' '.join(joins)}"


def _priced(source: str) -> tuple[str, str]:
    return ("priced", f"SELECT *, {CLASS} AS class FROM {source} WHERE fee > 0 AND {CLASS} IS NOT NULL")


TARIFF = (
    "tariff",
    """SELECT country, weight, carrier, 'rival_c' AS platform, fee FROM (
        SELECT TRIM(country_text) AS country, CAST(TRIM(weight_text) AS DOUBLE) AS weight, TRIM(carrier_text) AS carrier,
               CAST(TRUNC(CAST(REPLACE(TRIM(fee_text), ',', '') AS DOUBLE)) AS BIGINT) AS fee, row_order
        FROM {tariff_text} WHERE TRIM(platform_text) = 'Rival C')
    WHERE country <> 'US' AND weight <= 10
    QUALIFY ROW_NUMBER() OVER (PARTITION BY country, weight, carrier ORDER BY row_order DESC) = 1""",
)
MERGED = (
    "merged",
    """SELECT country, weight, carrier, platform, fee FROM {rate_card}
    UNION ALL
    SELECT t.* FROM tariff t WHERE EXISTS (SELECT 1 FROM {rate_card} r WHERE r.country = t.country AND r.weight = t.weight)""",
)


# Gaps before the tariff, and after it where a country has one and both sides have a fee.
GAP_FIELDS = [f"{name}" for c in ("standard", "express") for name in (f"gap_{c}_pct", f"{c}_cheapest_fee", f"{c}_cheapest_carrier", f"competitor_{c}_min")]


def _both_gaps() -> list[tuple[str, str]]:
    before = _gaps("v").replace("priced", "priced_before")
    after = _gaps("v", "('rival_a', 'rival_b', 'rival_c')").replace("priced", "priced_after")
    return [
        TARIFF,
        MERGED,
        ("priced_before", _priced("{rate_card}")[1]),
        ("priced_after", _priced("merged")[1]),
        ("gaps_before", before),
        ("gaps_after", f"{after} WHERE g.country IN (SELECT country FROM tariff)"),
    ]


def refreshed_gaps() -> str:
    fields = ", ".join(f"COALESCE(a.{f}, b.{f}) AS {f}" for f in GAP_FIELDS)
    return with_views(f"SELECT b.country, b.weight, {fields} FROM gaps_before b LEFT JOIN gaps_after a ON a.country = b.country AND a.weight = b.weight", *_both_gaps())


def rate_card_document() -> str:
    figures = ["total", "DHL", "EMS", "FEDEX", "UPS", "kpacket"]
    stale = "CASE WHEN CAST(g.weight * 2 AS INT) % 2 = 0 THEN -1 END"
    volumes = []
    for p in ("p1998", "p1999"):
        for f in figures:
            old = stale if (p, f) == ("p1998", "total") else "NULL"
            volumes.append(f"CAST(CASE WHEN g.country IN (SELECT country FROM volume WHERE period = '{p}') THEN COALESCE(v{p}.{f}, 0) ELSE {old} END AS BIGINT) AS {p}_{f}")
    joins = " ".join(f"LEFT JOIN volume v{p} ON v{p}.period = '{p}' AND v{p}.country = g.country AND v{p}.weight = g.weight" for p in ("p1998", "p1999"))
    gaps = ", ".join(f"COALESCE(a.{f}, {'99.5' if f == 'gap_express_pct' else 'NULL'}) AS {f}" for f in GAP_FIELDS)
    columns = (
        "columns_of",
        """SELECT country, string_agg(carrier || '=' || platforms, ';' ORDER BY carrier) AS columns FROM (
            SELECT country, carrier, string_agg(platform, ',' ORDER BY platform = 'rival_c', platform) AS platforms FROM (
                SELECT DISTINCT country, carrier, platform FROM {rate_card}
                UNION SELECT c.country, c.carrier, 'rival_c' FROM (SELECT DISTINCT country, carrier FROM {rate_card}) c
                JOIN tariff t ON t.country = c.country AND t.carrier = c.carrier) GROUP BY country, carrier) GROUP BY country""",
    )
    fees = (
        "fees_of",
        """SELECT country, weight, string_agg(f, ',' ORDER BY f) AS fees FROM (
            SELECT country, weight, carrier || ':' || platform || '=' || fee AS f FROM merged) GROUP BY country, weight""",
    )
    steps = {name: sql for name, sql in [*_both_gaps(), *VOLUME, columns, fees]}
    return with_views(
        f"""SELECT g.country, k.columns, g.weight + CASE WHEN CAST(g.weight * 2 AS INT) % 3 = 0 THEN CAST(0.04 AS DOUBLE) ELSE 0 END AS weight,
            'keep ' || g.country AS note, f.fees, {gaps}, {', '.join(volumes)},
            CASE WHEN CAST(g.weight * 2 AS INT) % 2 = 0 THEN 'kept' END AS p1998_memo
        FROM (SELECT DISTINCT country, weight FROM {{rate_card}}) g
        JOIN columns_of k ON k.country = g.country JOIN fees_of f ON f.country = g.country AND f.weight = g.weight
        LEFT JOIN gaps_after a ON a.country = g.country AND a.weight = g.weight {joins}""",
        *steps.items(),
    )


def _volume_steps() -> list[tuple[str, str]]:
    cols = "package_id, country_code, dimension_weight, carrier, carrier_service, trans_at_utc_package"
    rows = " UNION ALL ".join(f"SELECT {cols} FROM ({sql})" for sql, _ in PIECES.values())
    tagged = """SELECT package_id, country_code AS country, carrier,
        CASE WHEN COALESCE(dimension_weight, 0) <= 500 THEN 0.5 ELSE CEIL(dimension_weight / 500) / 2 END AS weight,
        CASE WHEN upper(carrier_service) = 'KPACKET' THEN 'kpacket' WHEN upper(carrier_service) = 'EMS' THEN 'EMS'
             WHEN upper(carrier) IN ('DHL', 'DHL_EXPRESS') THEN 'DHL' WHEN upper(carrier) IN ('EMS', 'FEDEX', 'UPS') THEN upper(carrier)
             ELSE 'other' END AS key,
        CASE substr(trans_at_utc_package, 1, 4) WHEN '1998' THEN 'p1998' WHEN '1999' THEN 'p1999' END AS period
        FROM (""" + rows + """) WHERE country_code IN ('AU','BR','CA','DE','FR','GB','JP','MX','SG','US')"""
    volume = "SELECT period, country, weight, COUNT(DISTINCT package_id) AS total, " + ", ".join(
        f"COUNT(DISTINCT package_id) FILTER (key = '{k}') AS {k}" for k in ["DHL", "EMS", "FEDEX", "UPS", "kpacket"]
    ) + " FROM tagged WHERE period IS NOT NULL GROUP BY period, country, weight"
    return [*steps_of(*PIECES), ("tagged", tagged), ("volume", volume)]


VOLUME = _volume_steps()

SERIES = (
    "series",
    """SELECT category, service, CAST(date_trunc('week', day) AS DATE) AS week_start, COUNT(*) AS n,
       SUM(CAST(revenue * 100 AS BIGINT)) AS cents FROM {weekly_orders} GROUP BY ALL""",
)


def _pct(now: str, before: str) -> str:
    return f"CASE WHEN {before} > 0 THEN {half_even(f'({now} - {before}) * 100', before)} END"


def _trend(source: str, keys: str, more: str = "") -> str:
    w = f"PARTITION BY {keys} ORDER BY week_start"
    # Every calendar week of a series from its first to its last, absent ones with NULL.
    grid = f"""SELECT {keys}, CAST(UNNEST(generate_series(MIN(week_start), MAX(week_start), INTERVAL 7 DAY)) AS DATE) AS week_start
        FROM {source} GROUP BY {keys}"""
    four = f"({w} ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING)"
    base = f"""SELECT * FROM (SELECT *, LAG(n) OVER ({w}) AS pn, LAG(cents) OVER ({w}) AS pc, COUNT(*) OVER {four} AS k,
        SUM(n) OVER {four} AS sn, SUM(cents) OVER {four} AS sc
        FROM ({grid}) g LEFT JOIN {source} s USING ({keys}, week_start)) WHERE n IS NOT NULL"""
    figures = f"""SELECT *, {_pct('n', 'pn')} AS nw, {_pct('cents', 'pc')} AS rw, {_pct('n * k', 'sn')} AS na, {_pct('cents * k', 'sc')} AS ra FROM ({base})"""
    verdict = lambda w_, a: (
        f"CASE WHEN {w_} IS NULL THEN NULL WHEN {w_} <= -20 THEN 'crisis' WHEN {w_} >= 20 THEN 'surge'"
        f" WHEN {w_} <= -10 THEN 'caution' WHEN {a} >= 10 THEN 'good' ELSE 'normal' END"
    )
    money = lambda c: f"CAST({c} AS DOUBLE) / 100"
    return f"""SELECT {keys}, CAST(week_start AS VARCHAR) AS week_start, n, {money('cents')} AS revenue, pn AS prior_n, {money('pc')} AS prior_revenue,
        {money('cents')} / n AS aov, nw AS n_wow_pct, rw AS revenue_wow_pct, CAST(sn AS DOUBLE) / k AS n_avg4,
        {money('sc')} / k AS revenue_avg4, {money('sc')} / sn AS aov_avg4, na AS n_vs_avg4_pct, ra AS revenue_vs_avg4_pct,
        {verdict('nw', 'na')} AS n_verdict, {verdict('rw', 'ra')} AS revenue_verdict {more} FROM ({figures})"""


def weekly_trend() -> str:
    return with_views(_trend("series", "category, service"), SERIES)


def weekly_total_trend() -> str:
    total = ("t", "SELECT 'all' AS scope, week_start, CAST(SUM(n) AS BIGINT) AS n, SUM(cents) AS cents FROM series GROUP BY week_start")
    return with_views(_trend("t", "scope"), SERIES, total)


def weekly_category_trend() -> str:
    total = ("t", "SELECT category, week_start, CAST(SUM(n) AS BIGINT) AS n, SUM(cents) AS cents FROM series GROUP BY ALL")
    return with_views(_trend("t", "category"), SERIES, total)


def report_categories() -> str:
    """Weeks from 1998-05-11 to 1998-06-14; the last of them is reported."""
    last, before = "week_start = DATE '1998-06-08'", "week_start = DATE '1998-06-01'"
    sums = f"""SELECT category, COALESCE(SUM(n) FILTER ({last}), 0) AS n, COALESCE(SUM(cents) FILTER ({last}), 0) AS cents,
        COALESCE(SUM(n) FILTER ({before}), 0) AS pn, COALESCE(SUM(cents) FILTER ({before}), 0) AS pc,
        COALESCE(SUM(n) FILTER (NOT {last}), 0) AS fn, COALESCE(SUM(cents) FILTER (NOT {last}), 0) AS fc
        FROM series WHERE week_start BETWEEN DATE '1998-05-11' AND DATE '1998-06-08' GROUP BY category"""
    money = lambda c: f"CAST({c} AS DOUBLE) / 100"
    return with_views(
        f"""SELECT category, CAST(n AS BIGINT) AS n, {money('cents')} AS revenue, CAST(pn AS BIGINT) AS prior_n, {money('pc')} AS prior_revenue,
        CAST(fn AS BIGINT) AS four_weeks_n, {money('fc')} AS four_weeks_revenue, {_pct('n', 'pn')} AS n_wow_pct, {_pct('cents', 'pc')} AS revenue_wow_pct FROM ({sums})""",
        SERIES,
    )


def report_week() -> str:
    return with_views(
        """SELECT service, CAST(week_start AS VARCHAR) AS week_start, n, CAST(cents AS DOUBLE) / 100 AS revenue FROM series
        WHERE week_start = DATE '1998-06-08'""",
        SERIES,
    )


def contributions() -> str:
    return with_views(
        f"""SELECT service, CAST(week_start AS VARCHAR) AS week_start, CAST(delta AS DOUBLE) / 100 AS delta,
        CASE WHEN t <> 0 THEN {half_even('delta * 100 * SIGN(t)', 'ABS(t)')} END AS contribution_pct
        FROM (SELECT *, SUM(delta) OVER (PARTITION BY week_start) AS t FROM (
            SELECT COALESCE(a.service, b.service) AS service, COALESCE(a.week_start, b.week_start) AS week_start,
                   COALESCE(a.cents, 0) - COALESCE(b.cents, 0) AS delta
            FROM series a FULL JOIN (SELECT service, week_start + 7 AS week_start, cents FROM series) b
              ON a.service = b.service AND a.week_start = b.week_start)
        WHERE week_start IN (SELECT week_start FROM series) AND week_start - 7 IN (SELECT week_start FROM series))""",
        SERIES,
    )


def package_mix() -> str:
    base = (
        "m",
        """SELECT package_type, CAST(date_trunc('week', day) AS DATE) AS week_start, COUNT(*) AS n,
        SUM(CAST(revenue * 100 AS BIGINT)) AS cents FROM {weekly_orders} GROUP BY ALL""",
    )
    return with_views(
        f"""SELECT package_type, CAST(week_start AS VARCHAR) AS week_start, n, CAST(cents AS DOUBLE) / 100 AS revenue,
        {_pct('n', 'pn')} AS n_wow_pct, {_pct('cents', 'pc')} AS revenue_wow_pct,
        {half_even('n * 100', 'tn')} AS n_share_pct, {half_even('cents * 100', 'tc')} AS revenue_share_pct
        FROM (SELECT m.*, b.n AS pn, b.cents AS pc, SUM(m.n) OVER (PARTITION BY m.week_start) AS tn,
              SUM(m.cents) OVER (PARTITION BY m.week_start) AS tc
              FROM m LEFT JOIN m b ON b.package_type = m.package_type AND b.week_start = m.week_start - 7)""",
        base,
    )


DAYS = ["mon", "tue", "wed", "thu", "fri", "sat", "sun"]


def weekday_distribution() -> str:
    counts = ", ".join(f"COUNT(*) FILTER (isodow(day) = {i}) AS {d}" for i, d in enumerate(DAYS, start=1))
    base = ("d", f"SELECT service, CAST(date_trunc('week', day) AS DATE) AS week_start, {counts} FROM {{weekly_orders}} GROUP BY ALL")
    cols = ", ".join([f"d.{x}" for x in DAYS] + [f"d.{x} - p.{x} AS {x}_change" for x in DAYS])
    return with_views(
        f"""SELECT d.service, CAST(d.week_start AS VARCHAR) AS week_start, {cols} FROM d
        LEFT JOIN d p ON p.service = d.service AND p.week_start + 7 = d.week_start""",
        base,
    )


def lead_lag() -> str:
    return with_views(
        """SELECT CAST(k AS INT) AS lag_weeks, COUNT(*) AS weeks, ROUND(CORR(a.n, b.n), 6) AS correlation
        FROM (SELECT week_start, SUM(n) AS n FROM series WHERE category = 'purchase' GROUP BY 1) a
        CROSS JOIN (SELECT UNNEST([0, 1, 2, 3]) AS k) lags
        JOIN (SELECT week_start, SUM(n) AS n FROM series WHERE category = 'forwarding' GROUP BY 1) b
          ON b.week_start = a.week_start + CAST(7 * k AS INT)
        GROUP BY k""",
        SERIES,
    )


def service_changes() -> str:
    return with_views(
        """SELECT CAST(w.week_start AS VARCHAR) AS week_start, s.service, CASE WHEN a.n IS NULL THEN 'missing' ELSE 'new' END AS status
        FROM (SELECT DISTINCT week_start FROM series WHERE week_start - 7 IN (SELECT week_start FROM series)) w
        CROSS JOIN (SELECT DISTINCT service FROM series) s
        LEFT JOIN series a ON a.service = s.service AND a.week_start = w.week_start
        LEFT JOIN series b ON b.service = s.service AND b.week_start = w.week_start - 7
        WHERE (a.n IS NULL) <> (b.n IS NULL)""",
        SERIES,
    )


def _moves(admins: bool) -> list[tuple[str, str]]:
    where = "" if admins else """WHERE customer_id NOT IN (SELECT customer_id FROM {customer}
        WHERE upper(suite_number) IN ('Z9996', 'Z9997', 'Z9998', 'Z9999'))"""
    tiers = f"""SELECT customer_id, period, CASE WHEN total_amount >= 900000 THEN 'VIP' WHEN total_amount >= 650000 THEN 'Gold'
        WHEN total_amount >= 400000 THEN 'Silver' WHEN total_amount >= 200000 THEN 'Bronze' ELSE 'Basic' END AS tier
        FROM {{customer_year}} {where}"""
    moves = " UNION ALL ".join(
        f"""SELECT {a} AS from_period, {b} AS to_period, COALESCE(x.tier, 'Not available') AS from_state,
            COALESCE(y.tier, 'No activity') AS to_state, COUNT(*) AS customers
            FROM (SELECT * FROM tiers WHERE period = {a}) x FULL JOIN (SELECT * FROM tiers WHERE period = {b}) y
              ON x.customer_id = y.customer_id GROUP BY ALL"""
        for a, b in [(1996, 1997), (1997, 1998), (1996, 1998)]
    )
    return [("tiers", tiers), ("moves", moves)]


def tier_transition(admins: bool = True) -> str:
    tiers = "['Basic', 'Bronze', 'Silver', 'Gold', 'VIP', '{}']"
    pct = half_even("customers * 100", "GREATEST(r, 1)", 2)
    return with_views(
        f"""SELECT from_period, to_period, from_state, to_state, customers, {pct} AS row_pct
        FROM (SELECT *, SUM(customers) OVER (PARTITION BY from_period, to_period, from_state) AS r FROM (
            SELECT p.from_period, p.to_period, f.s AS from_state, t.s AS to_state, COALESCE(m.customers, 0) AS customers
            FROM (SELECT DISTINCT from_period, to_period FROM moves) p
            CROSS JOIN (SELECT UNNEST({tiers.format('Not available')}) AS s) f
            CROSS JOIN (SELECT UNNEST({tiers.format('No activity')}) AS s) t
            LEFT JOIN moves m ON m.from_period = p.from_period AND m.to_period = p.to_period AND m.from_state = f.s AND m.to_state = t.s))""",
        *_moves(admins),
    )


def tier_matrix_percent() -> str:
    cols = ", ".join(f"MAX(row_pct) FILTER (to_state = '{s}') AS \"{s}\"" for s in ["Basic", "Bronze", "Silver", "Gold", "VIP", "No activity"])
    return f"SELECT from_period, to_period, from_state, {cols} FROM ({tier_transition()}) GROUP BY from_period, to_period, from_state"


def tier_matrix() -> str:
    cols = ", ".join(
        f"CAST(COALESCE(SUM(customers) FILTER (to_state = '{s}'), 0) AS BIGINT) AS \"{s}\""
        for s in ["Basic", "Bronze", "Silver", "Gold", "VIP", "No activity"]
    )
    return with_views(
        f"""SELECT p.from_period, p.to_period, f.s AS from_state, {cols}
        FROM (SELECT DISTINCT from_period, to_period FROM moves) p
        CROSS JOIN (SELECT UNNEST(['Basic', 'Bronze', 'Silver', 'Gold', 'VIP', 'Not available']) AS s) f
        LEFT JOIN moves m ON m.from_period = p.from_period AND m.to_period = p.to_period AND m.from_state = f.s
        GROUP BY ALL""",
        *_moves(True),
    )


def tier_summary() -> str:
    at = lambda c: f"list_position(['Basic', 'Bronze', 'Silver', 'Gold', 'VIP'], {c})"
    total = lambda test: f"CAST(COALESCE(SUM(customers) FILTER ({test}), 0) AS BIGINT)"
    return with_views(
        f"""SELECT from_period, to_period, {total("from_state = 'Not available'")} AS "new", {total("to_state = 'No activity'")} AS lost,
        {total(f"{at('to_state')} > {at('from_state')}")} AS upgrade, {total(f"{at('to_state')} < {at('from_state')}")} AS downgrade,
        {total('to_state = from_state')} AS maintain FROM moves GROUP BY from_period, to_period""",
        *_moves(True),
    )


def market_checks() -> dict[str, str]:
    d = lambda c: f"CAST({c} AS DOUBLE) AS {c}"
    fees = ", ".join(
        f"CAST(ROUND({FEE[f]}, 0) AS DOUBLE) AS {f}_krw, CAST(ROUND(b.{f}_usd, 2) AS DOUBLE) AS {f}_usd"
        for f in ["pg", "service", "surtax", "vendor", "vendor_child"]
    )
    volumes = "total, DHL, EMS, FEDEX, UPS, kpacket"
    return {
        "daily_exchange_rate": with_views(
            f"SELECT CAST(currency_date AS VARCHAR) AS currency_date, {d('origin_usd_krw')}, {d('usd_krw')} FROM fx", ("fx", FX_DAILY)
        ),
        "highest_shipping_cost": with_views(
            f"SELECT tracking_number, {', '.join(map(d, ['customer_cost', 'original_cost', 'fuel_surcharge_cost', 'marked_up_cost']))} FROM top",
            ("top", COST_TOP),
        ),
        "child_mix": with_views(
            """SELECT package_id, COUNT(*) AS n_children, SUM(buy) > 0 AS has_buy, SUM(asn) > 0 AS has_asn, SUM(buy) < COUNT(*) AS has_non_buy,
            SUM(buy + asn) < COUNT(*) AS has_other, COUNT(reference_type) > SUM(asn) AS has_non_asn
            FROM (SELECT *, CASE WHEN reference_type IN ('BUY_REQUEST', 'BUYFORME') THEN 1 ELSE 0 END AS buy,
                  CASE WHEN reference_type = 'ASN' THEN 1 ELSE 0 END AS asn FROM {package} WHERE package_type = 'INNER')
            GROUP BY package_id"""
        ),
        "purchase_fees": with_views(
            f"SELECT b.request_id, b.market_id, CAST(b.paid_on AS VARCHAR) AS purchase_date, CAST(b.g AS DOUBLE) AS goods_krw, {fees} FROM bought b",
            *BOUGHT_STEPS,
        ),
        "goods_per_parent": with_views(
            f"SELECT package_id, {', '.join(d(n) for n in items('b.fxb', 'vendor'))} FROM item_sums", *BOUGHT_STEPS, ("item_sums", ITEM_SUMS)
        ),
        "rate_gap": with_views(_gaps("v"), _priced("{rate_card}")),
        "tariff_rows": with_views("SELECT * FROM tariff", TARIFF),
        "tariff_file": with_views("SELECT * FROM tariff", TARIFF),
        "rate_card_file": with_views("""SELECT country, ROUND(weight + CASE WHEN CAST(weight * 2 AS INT) % 3 = 0 THEN 0.04 ELSE 0 END, 1) AS weight,
            carrier, platform, fee FROM {rate_card}"""),
        "tariff_merge": with_views("SELECT * FROM merged", TARIFF, MERGED),
        "tariff_merge_gap": with_views(_gaps("v", "('rival_a', 'rival_b', 'rival_c')"), TARIFF, MERGED, _priced("merged")),
        "tariff_platforms": with_views(
            """SELECT country, carrier, string_agg(platform, ',' ORDER BY platform) AS platforms FROM (
               SELECT DISTINCT country, carrier, platform FROM {rate_card}
               UNION SELECT c.country, c.carrier, 'rival_c' FROM (SELECT DISTINCT country, carrier FROM {rate_card}) c
               JOIN tariff t ON t.country = c.country AND t.carrier = c.carrier) GROUP BY country, carrier""",
            TARIFF,
        ),
        "tariff_refreshed_gaps": refreshed_gaps(),
        "rate_card_document": rate_card_document(),
        "carrier_volume": with_views(f"SELECT period, country, weight, {volumes} FROM volume", *VOLUME),
        "rate_card_volume": with_views(
            """SELECT a.period, g.country, g.weight, """ + ", ".join(f"COALESCE(v.{c}, 0) AS {c}" for c in volumes.split(", ")) + """
            FROM (SELECT DISTINCT country, weight FROM {rate_card}) g JOIN (SELECT DISTINCT period, country FROM volume) a ON a.country = g.country
            LEFT JOIN volume v ON v.period = a.period AND v.country = g.country AND v.weight = g.weight""",
            *VOLUME,
        ),
        "carrier_diagnostics": with_views(
            "SELECT carrier, bool_or(key = 'other') AS unmatched FROM tagged WHERE carrier IS NOT NULL GROUP BY carrier", *VOLUME
        ),
        "weekly_trend": weekly_trend(),
        "weekly_total_trend": weekly_total_trend(),
        "weekly_category_trend": weekly_category_trend(),
        "weekly_report_rows": report_week(),
        "weekly_report_categories": report_categories(),
        "weekly_contribution": contributions(),
        "weekly_package_mix": package_mix(),
        "weekday_distribution": weekday_distribution(),
        "weekly_lead_lag": lead_lag(),
        "weekly_service_changes": service_changes(),
        "tier_transition": tier_transition(),
        "tier_transition_no_admin": tier_transition(False),
        "tier_matrix": tier_matrix(),
        "tier_matrix_percent": tier_matrix_percent(),
        "tier_summary": tier_summary(),
    }
