"""The five cases as DuckDB SQL over the sample views."""

from __future__ import annotations

from checks.base import with_views
from parcelmetrics.plans.cases import CANONICAL, column_type
from parcelmetrics.sources.schemas import COSTS, FEES

START = "DATE '1995-06-01'"
STANDARD = "[1,4,5,6,7,8,9,10,11,12,13,14,18,19,26,27,28,29,30]"
STANDARD_LIST = STANDARD.strip("[]")


MARKETS = range(1, 35)


def _rates(market: int) -> str:
    """Rates of a market before and after the day on which its fee changed; most never change."""
    standard = market in map(int, STANDARD_LIST.split(","))
    pg = ("0.0778", "0.1164") if market in (2, 21) else ("0.08",) * 2 if standard or market == 20 else ("0.0778",) * 2 if market == 22 else ("0",) * 2
    vendor = {2: ("0.0718", "0.0218"), 21: ("0.0718", "0.0218"), 22: ("0.05", "0.04"), 19: ("0.05",) * 2}.get(market, ("0",) * 2)
    service = "0.05" if standard else {3: "0.08", 24: "0.08", 33: "0.08", 20: "0.07", 34: "0.07", 22: "0.0718"}.get(market, "0")
    surtax = "0.10" if standard or market == 20 else "0"
    change = "1999-06-01" if market == 22 else "1998-01-01"
    money = ", ".join(f"CAST({r} AS DECIMAL(5,4))" for r in (*pg, *vendor, service, surtax))
    return f"({market}, DATE '{change}', {money})"


# One row per market, plain columns.
MARKET_RATES = f"""
    SELECT * FROM (VALUES {', '.join(map(_rates, MARKETS))})
    AS r(market_id, vendor_change, pg_old, pg_new, vendor_old, vendor_new, service_rate, surtax_rate)"""
PG_CHANGE = "DATE '1998-01-02'"


def q9(krw: str, fx: str) -> str:
    return f"CAST(CAST({krw} AS DOUBLE) / CAST({fx} AS DOUBLE) AS DECIMAL(28,9))"


def z(c: str) -> str:
    return f"COALESCE({c}, 0)"


FX_DAILY = """
    SELECT currency_date, origin_usd_krw, usd_krw FROM {currency}
    QUALIFY ROW_NUMBER() OVER (PARTITION BY currency_date ORDER BY origin_usd_krw DESC, usd_krw DESC) = 1"""
COST_TOP = """
    SELECT * FROM {shipping_cost}
    QUALIFY ROW_NUMBER() OVER (PARTITION BY tracking_number
        ORDER BY original_cost DESC, customer_cost DESC, marked_up_cost DESC, fuel_surcharge_cost DESC) = 1"""

# One row of a request and payment, with everything that fees need.
PAID = f"""
    SELECT m.*, t.reference_id AS paid_id, CAST(t.trans_at_utc AS DATE) AS paid_on,
           {z('t.discount_value')} AS disc, {z('t.coupon_discount_value')} AS coup,
           {z('m.fee_unit_price_krw')} * {z('m.quotation_quantity')} AS g,
           {z('m.fee_handling_fee_usd')} AS hand, {z('m.fee_domestic_shipping_price_usd')} AS dom,
           COALESCE(m.last_status = 'CANCELED', FALSE) AS gone
    FROM {{market_request}} m
    LEFT JOIN {{payment}} t ON m.request_id = t.reference_id
         AND t.pay_service IN ('NewWeBuy', 'BUY_REQUEST') AND t.transaction_status = 'CNF'"""

# Each fee once, as a column.
CHARGED = f"""
    SELECT p.*, COALESCE(x.origin_usd_krw, 1450) AS fxo, COALESCE(x.usd_krw, 1450) AS fxb,
           p.g * COALESCE(CASE WHEN p.paid_on >= {PG_CHANGE} THEN r.pg_new ELSE r.pg_old END, 0) AS pg_fee,
           p.g * COALESCE(r.service_rate, 0) AS service_fee,
           p.g * COALESCE(r.surtax_rate, 0) AS surtax_fee,
           p.g * COALESCE(CASE WHEN p.paid_on >= r.vendor_change THEN r.vendor_new ELSE r.vendor_old END, 0) AS vendor_fee
    FROM paid p
    LEFT JOIN fx_daily x ON x.currency_date = p.paid_on
    LEFT JOIN market_rates r ON r.market_id = p.market_id"""

BOUGHT = f"""
    SELECT c.*, CASE WHEN c.market_id = 22 THEN 0 ELSE c.vendor_fee END AS vendor_child_fee,
           {q9('c.g', 'c.fxb')} AS g_usd, {q9('c.pg_fee', 'c.fxb')} AS pg_usd, {q9('c.service_fee', 'c.fxb')} AS service_usd,
           {q9('c.surtax_fee', 'c.fxb')} AS surtax_usd, {q9('c.vendor_fee', 'c.fxb')} AS vendor_usd,
           {q9('CASE WHEN c.market_id = 22 THEN 0 ELSE c.vendor_fee END', 'c.fxb')} AS vendor_child_usd
    FROM charged c"""


# Goods amounts of one purchase row b. KRW terms of children are rounded one by one.
FEE = {f: f"b.{f}_fee" for f in ["pg", "service", "surtax", "vendor", "vendor_child"]}


def child_terms(vendor: str) -> dict[str, str]:
    r = lambda x: f"ROUND({x}, 0)"
    return {
        "gr": f"b.g + {r('b.dom * b.fxb')} + {r('b.hand * b.fxb')} + {r(FEE['pg'])} + {r(FEE['surtax'])}"
        f" + {r(FEE['service'])} - {r('b.disc * b.fxb')} - {r('b.coup * b.fxb')}",
        "gp": f"{r('b.hand * b.fxb')} + {r(FEE['surtax'])} + {r(FEE['service'])} - {r('b.disc * b.fxb')}"
        f" - {r('b.coup * b.fxb')} - {r(FEE[vendor])}",
        "gru": "b.g_usd + b.dom + b.hand + b.pg_usd + b.surtax_usd + b.service_usd - b.disc - b.coup",
        "gpu": f"b.hand + b.surtax_usd + b.service_usd - b.disc - b.coup - b.{vendor}_usd",
    }


SINGLE_TERMS = {
    "gr": f"b.g + b.dom * b.fxb + b.hand * b.fxb + ROUND({FEE['pg']}, 0) + {FEE['surtax']} + ROUND({FEE['service']}, 0)"
    " - b.disc * b.fxb - b.coup * b.fxb",
    "gp": f"b.hand * b.fxb + ROUND({FEE['service']}, 0) - ROUND({FEE['vendor']}, 0) - b.disc * b.fxb - b.coup * b.fxb"
    f" + {FEE['surtax']}",
    "gru": child_terms("vendor")["gru"],
    "gpu": child_terms("vendor")["gpu"],
}


def items(fx: str, vendor: str) -> dict[str, str]:
    """Itemised columns of a purchase row, decimals."""
    out = {"total_goods_price_krw": "b.g", "total_goods_price_usd": "ROUND(b.g_usd, 2)"}
    for column, name in [
        ("hand", "fee_handling_fee"),
        ("dom", "domestic_shipping_price"),
        ("disc", "discount_value"),
        ("coup", "coupon_discount_value"),
    ]:
        out[f"{name}_krw"] = f"ROUND(b.{column} * {fx}, 0)"
        out[f"{name}_usd"] = f"b.{column}"
    for fee, name in [("surtax", "surtax"), (vendor, "business_fee"), ("pg", "pg_fee"), ("service", "service_fee")]:
        out[f"{name}_krw"] = f"ROUND({FEE[fee]}, 0)"
        out[f"{name}_usd"] = f"ROUND(b.{fee}_usd, 2)"
    return out


ITEM_SUMS = f"""
    SELECT c.package_id, {', '.join(
        f"COALESCE(SUM(CASE WHEN b.gone THEN 0 ELSE {sql} END), 0) AS {name}" for name, sql in items('b.fxb', 'vendor').items())}
    FROM {{package}} c LEFT JOIN bought b ON c.reference_id = b.request_id AND c.reference_type IN ('BUY_REQUEST', 'BUYFORME')
    WHERE c.package_type = 'INNER'
    GROUP BY c.package_id"""

PARENT = {
    3: """SELECT DISTINCT p.package_id, p.package_type, p.trans_at_utc, p.ship_at_kst, p.package_merchant, p.order_type, p.customer_id,
          p.country_code, p.carrier, p.carrier_service, p.package_count, p.package_weight, p.dimension_weight, p.reference_type,
          p.track_number FROM {{package}} p WHERE p.package_type IN ('REPACK', 'CONSOLE')
          AND CAST(p.trans_at_utc AS DATE) >= {start}
          AND p.package_id NOT IN (SELECT package_id FROM {{package}}
              WHERE package_type = 'INNER' AND reference_type <> 'ASN')""",
    4: """SELECT p.* FROM {{package}} p WHERE p.package_type IN ('REPACK', 'CONSOLE')
          AND CAST(p.trans_at_utc AS DATE) >= {start} AND p.order_type NOT LIKE '%WE_SHIP%'
          AND p.package_id NOT IN (SELECT package_id FROM {{package}} WHERE package_type = 'INNER'
              AND COALESCE(reference_type, '') NOT IN ('BUY_REQUEST', 'BUYFORME'))""",
    5: """SELECT p.* FROM {{package}} p WHERE p.package_type IN ('REPACK', 'CONSOLE')
          AND CAST(p.trans_at_utc AS DATE) >= {start}
          AND p.package_id IN (SELECT package_id FROM {{package}} WHERE package_type = 'INNER'
              GROUP BY package_id
              HAVING COUNT(*) FILTER (reference_type IN ('BUY_REQUEST', 'BUYFORME')) > 0
                 AND COUNT(*) FILTER (reference_type = 'ASN') > 0
                 AND COUNT(*) = COUNT(*) FILTER (reference_type IN ('BUY_REQUEST', 'BUYFORME', 'ASN')))""",
}

DUCK_TYPES = {"STRING": "VARCHAR", "DATE": "VARCHAR"}


def finish(values: dict[str, str]) -> str:
    """Canonical column list: decimals as doubles, dates as text, absent columns NULL."""
    parts = []
    for name in CANONICAL:
        kind = column_type(name)
        sql = values.get(name, "NULL")
        if kind.startswith("DECIMAL"):
            kind = "DOUBLE"
        elif kind == "DATE":
            sql, kind = f"CAST({sql} AS DATE)", "VARCHAR"
        parts.append(f"CAST({sql} AS {DUCK_TYPES.get(kind, kind)}) AS {name}")
    return ", ".join(parts)


def measures(terms: dict[str, str], ships: bool, zero_fees: bool = False, zero_costs: bool = False, gone: str = "") -> dict[str, str]:
    fx = "COALESCE(x.usd_krw, 1450)"
    wh = "(" + " + ".join(z(f"f.{fee}") for fee in FEES) + ")"
    sh = z("f.shipping_fee")
    gr, gp, gru, gpu = (f"({terms.get(k, '0')})" for k in ("gr", "gp", "gru", "gpu"))
    if gone:
        gr, gp, gru, gpu = (f"CASE WHEN {gone} THEN 0 ELSE {e} END" for e in (gr, gp, gru, gpu))
    profit, profit_usd = f"{gp} + {wh} * {fx}", f"{gpu} + {wh}"
    if ships:
        profit += " + s.marked_up_cost"
        profit_usd += f" + {q9('s.marked_up_cost', fx)}"
    if gone:
        profit, profit_usd = f"CASE WHEN {gone} THEN 0 ELSE {profit} END", f"CASE WHEN {gone} THEN 0 ELSE {profit_usd} END"
    out = {
        "goods_revenue_krw": f"ROUND({gr}, 0)",
        "goods_revenue_usd": f"ROUND({gru}, 2)",
        "warehouse_revenue_krw": f"ROUND({wh} * {fx}, 0)",
        "warehouse_revenue_usd": wh,
        "shipping_revenue_krw": f"ROUND({sh} * {fx}, 0)",
        "shipping_revenue_usd": sh,
        "revenue_krw": f"ROUND({gr} + ({wh} + {sh}) * {fx}, 0)",
        "revenue_usd": f"ROUND({gru} + {wh} + {sh}, 2)",
        "profit_krw": f"ROUND({profit}, 0)",
        "profit_usd": f"ROUND({profit_usd}, 2)",
        "goods_profit_krw": f"ROUND({gp}, 0)",
        "goods_profit_usd": f"ROUND({gpu}, 2)",
        "warehouse_profit_krw": f"ROUND({wh} * {fx}, 0)",
        "warehouse_profit_usd": wh,
        "shipping_fee_krw": f"ROUND({sh} * {fx}, 0)",
        "shipping_fee_usd": "f.shipping_fee",
        "origin_usd_krw_package": "COALESCE(x.origin_usd_krw, 1450)",
        "usd_krw_package": fx,
    }
    for fee in FEES:
        out[f"{fee}_krw"] = f"ROUND({z('f.' + fee)} * {fx}, 0)"
        out[f"{fee}_usd"] = z(f"f.{fee}") if zero_fees else f"f.{fee}"
    if ships:
        out["shipping_profit_krw"] = "ROUND(s.marked_up_cost, 0)"
        out["shipping_profit_usd"] = f"ROUND({q9('s.marked_up_cost', fx)}, 2)"
        for cost in COSTS:
            value = z(f"s.{cost}") if zero_costs else f"s.{cost}"
            out[f"{cost}_krw"] = f"ROUND({value}, 0)"
            out[f"{cost}_usd"] = f"ROUND({q9(value, fx)}, 2)"
    return out


OWN = ["package_id", "inner_package_id", "order_type", "package_type", "package_weight", "dimension_weight", "package_count", "reference_type"]
ROUTE = ["country_code", "carrier", "carrier_service"]


def identity(case: str, own: str = "p", person: str = "p", route: str = "p") -> dict[str, str]:
    return {
        **{c: f"{own}.{c}" for c in OWN},
        **{c: f"{route}.{c}" for c in ROUTE},
        "suite_number": "u.suite_number",
        "country_name": "n.name_en",
        "country_name_kr": "n.name_kr",
        "profit_case": f"'{case}'",
        "package_merchant": f"{person}.package_merchant",
        "ship_date_kst": f"{person}.ship_at_kst",
        "trans_at_utc_package": f"{person}.trans_at_utc",
    }


def bought_columns() -> dict[str, str]:
    return {
        "market_id": "b.market_id",
        "trans_at_utc_purchase": "b.paid_on",
        "package_merchant_clean": f"CASE WHEN b.market_id IN ({STANDARD_LIST}) THEN d.parsed_domain ELSE p.package_merchant END",
        "product_name": "COALESCE(b.customs_item_description, b.item_description)",
        "product_category": "b.customs_category",
        "fee_unit_price_krw": z("b.fee_unit_price_krw"),
        "fee_unit_price_usd": z("b.fee_unit_price_usd"),
        "quotation_quantity": z("b.quotation_quantity"),
        "origin_usd_krw_purchase": "COALESCE(b.fxo, 1450)",
        "usd_krw_purchase": "COALESCE(b.fxb, 1450)",
    }


def joins(customer: str, country: str, day: str) -> str:
    return f"""LEFT JOIN {{customer}} u ON u.customer_id = {customer}
    LEFT JOIN {{country}} n ON n.country_code = {country}
    LEFT JOIN fx_daily x ON x.currency_date = CAST({day} AS DATE)"""


TRIMMED = "LEFT JOIN cost_top s ON TRIM(s.tracking_number) = TRIM(p.track_number)"
FEES_JOIN = "LEFT JOIN {package_fee} f ON f.package_id = p.package_id"

FX_STEP = ("fx_daily", FX_DAILY)
COST_STEP = ("cost_top", COST_TOP)
BOUGHT_STEPS = [("market_rates", MARKET_RATES), FX_STEP, ("paid", PAID), ("charged", CHARGED), ("bought", BOUGHT)]
# Goods terms of single purchases, once and as columns.
SINGLE_STEP = ("single_terms", f"SELECT b.*, {', '.join(f'{sql} AS {name}' for name, sql in SINGLE_TERMS.items())} FROM bought b WHERE b.paid_id IS NOT NULL")
DOMAIN = "LEFT JOIN {request_domain} d ON d.buy_request_id = b.request_id"


def _case_1() -> tuple[str, list]:
    body = f"""SELECT {finish({**identity('1'), **measures({}, True)})}
    FROM {{package}} p {TRIMMED} {FEES_JOIN} {joins('p.customer_id', 'p.country_code', 'p.trans_at_utc')}
    WHERE p.package_type = 'SINGLE' AND p.reference_type = 'ASN' AND CAST(p.trans_at_utc AS DATE) >= {START}"""
    return body, [FX_STEP, COST_STEP]


def _case_2() -> tuple[str, list]:
    values = {
        **identity("2"),
        **bought_columns(),
        **items("b.fxo", "vendor"),
        **measures({name: f"b.{name}" for name in SINGLE_TERMS}, True, zero_costs=True),
    }
    body = f"""SELECT {finish(values)}
    FROM {{package}} p JOIN single_terms b ON b.request_id = p.reference_id AND b.package_id = p.package_id
    {DOMAIN} {TRIMMED} {FEES_JOIN} {joins('b.customer_id', 'p.country_code', 'p.trans_at_utc')}
    WHERE b.last_status <> 'CANCELED' AND p.package_type = 'SINGLE'
      AND p.reference_type IN ('BUY_REQUEST', 'BUYFORME') AND CAST(p.trans_at_utc AS DATE) >= {START}"""
    return body, [*BOUGHT_STEPS, SINGLE_STEP, COST_STEP]


def _parents(case: int) -> tuple[str, str]:
    return (f"parent_{case}", PARENT[case].format(start=START))


def _case_3() -> tuple[str, list]:
    body = f"""SELECT {finish({**identity('3'), 'inner_package_id': '0', **measures({}, True)})}
    FROM parent_3 p LEFT JOIN cost_top s ON s.tracking_number = p.track_number {FEES_JOIN}
    {joins('p.customer_id', 'p.country_code', 'p.trans_at_utc')}"""
    return body, [FX_STEP, COST_STEP, _parents(3)]


def _case_3_1() -> tuple[str, list]:
    values = {**identity("3_1", own="c"), **measures({}, False)}
    body = f"""SELECT {finish(values)}
    FROM {{package}} c JOIN parent_3 p ON p.package_id = c.package_id
    JOIN {{package_fee_item}} f ON f.inner_package_id = c.inner_package_id
    {joins('p.customer_id', 'p.country_code', 'p.trans_at_utc')}
    WHERE c.package_type = 'INNER' AND c.reference_type = 'ASN' AND c.inner_package_id <> 0"""
    return body, [FX_STEP, _parents(3)]


def _goods_case(case: int) -> tuple[str, list]:
    a = lambda name: z(f"a.{name}")
    terms = {}
    for currency, suffix in [("krw", ""), ("usd", "u")]:
        plus = ["fee_handling_fee", "surtax", "service_fee"]
        minus = ["discount_value", "coupon_discount_value"]
        shared = " + ".join(a(f"{n}_{currency}") for n in plus) + "".join(f" - {a(f'{n}_{currency}')}" for n in minus)
        terms["gr" + suffix] = shared + "".join(
            f" + {a(f'{n}_{currency}')}" for n in ["total_goods_price", "domestic_shipping_price", "pg_fee"]
        )
        terms["gp" + suffix] = f"{shared} - {a(f'business_fee_{currency}')}"
    values = {
        **identity(str(case)),
        **{name: a(name) for name in items("b.fxb", "vendor")},
        **measures(terms, True, zero_fees=True),
        **{name: "0" for name in ["market_id", "inner_package_id", "fee_unit_price_krw", "fee_unit_price_usd", "quotation_quantity"]},
        **{name: "1450" for name in ["origin_usd_krw_purchase", "usd_krw_purchase"]},
        "package_merchant": "NULL",
    }
    body = f"""SELECT {finish(values)} FROM parent_{case} p LEFT JOIN item_sums a ON a.package_id = p.package_id
    {TRIMMED} {FEES_JOIN} {joins('p.customer_id', 'p.country_code', 'p.trans_at_utc')}"""
    return body, [*BOUGHT_STEPS, COST_STEP, ("item_sums", ITEM_SUMS), _parents(case)]


def _goods_children(case: int) -> tuple[str, list]:
    values = {
        **identity(f"{case}_1", route="q"),
        **bought_columns(),
        **{k: z(f"CASE WHEN b.gone THEN 0 ELSE {v} END") for k, v in items("b.fxb", "vendor_child").items()},
        **measures({k: z(v) for k, v in child_terms("vendor_child").items()}, False, zero_fees=True, gone="b.gone"),
    }
    body = f"""SELECT {finish(values)}
    FROM {{package}} p JOIN parent_{case} q ON q.package_id = p.package_id
    LEFT JOIN bought b ON b.request_id = p.reference_id AND p.reference_type IN ('BUY_REQUEST', 'BUYFORME')
    {DOMAIN}
    LEFT JOIN {{package_fee_item}} f ON f.inner_package_id = p.inner_package_id
    {joins('p.customer_id', 'q.country_code', 'p.trans_at_utc')}
    WHERE p.package_type = 'INNER'"""
    return body, [*BOUGHT_STEPS, _parents(case)]


PIECES = {
    "case_1": _case_1(),
    "case_2": _case_2(),
    "case_3_parents": _case_3(),
    "case_3_children": _case_3_1(),
    "case_4_parents": _goods_case(4),
    "case_4_children": _goods_children(4),
    "case_5_parents": _goods_case(5),
    "case_5_children": _goods_children(5),
}


def steps_of(*names: str) -> list[tuple[str, str]]:
    """The steps several pieces need, each once and in order."""
    seen: dict[str, str] = {}
    for name in names:
        for step, sql in PIECES[name][1]:
            seen.setdefault(step, sql)
    return list(seen.items())


def case_sql(*names: str) -> str:
    return with_views(" UNION ALL ".join(PIECES[n][0] for n in names), *steps_of(*names))


PARENT_PIECES = ["case_1", "case_2", "case_3_parents", "case_4_parents", "case_5_parents"]
