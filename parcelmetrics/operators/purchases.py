"""Marketplace purchases with every fee computed once per purchase."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelmetrics.functions.money import FEE_KINDS, GOODS, RATE, STANDARD_MARKETS, STANDARD_MARKETS_20, FeeSchedule, amount, cents, rate_or_fallback, to_usd, won
from parcelmetrics.operators.columns import add_columns
from parcelmetrics.operators.dedupe import keep_highest
from parcelmetrics.operators.joins import many, splittable_join, with_fx
from parcelmetrics.operators.rates import rate_table, with_rates
from parcelmetrics.sources.warehouse import Tables

# Reference types of purchases and of announced parcels; payment codes.
BUY_TYPES = ["BUY_REQUEST", "BUYFORME"]
ASN = "ASN"
PURCHASE_SERVICES = ("NewWeBuy", "BUY_REQUEST")
CONFIRMED = "CNF"
CANCELED = "CANCELED"


def daily_fx(currency: DataFrame) -> DataFrame:
    """One row per date: the one with the highest posted rate."""
    return keep_highest(currency, "currency_date", "origin_usd_krw", ["usd_krw"])


def confirmed_payments(payment: DataFrame, services: tuple[str, ...] = PURCHASE_SERVICES) -> DataFrame:
    return payment.filter(
        F.col("pay_service").isin(list(services)) & (F.col("transaction_status") == CONFIRMED)
    ).selectExpr(
        "reference_id AS paid_request_id",
        "CAST(trans_at_utc AS DATE) AS purchase_date",
        "discount_value AS discount_usd",
        "coupon_discount_value AS coupon_usd",
    )


# Columns a left join leaves empty on rows without a purchase.
_AMOUNTS = ["unit_krw", "unit_usd", "handling_usd", "domestic_usd", "discount_usd", "coupon_usd"]
_FEE_BASES = ["goods_krw", "pg_krw", "service_krw", "surtax_krw", "vendor_krw", "vendor_child_krw"]
_USD_ITEMS = ["handling", "domestic", "discount", "coupon"]


def with_payments(requests: DataFrame, paid: DataFrame) -> DataFrame:
    """Requests with each of their payments, and those without any; a request without id joins nothing and is left out.

    Payments are the side that adaptive execution can split, so that a request holding a large share of them is no single
    task; requests without a payment follow from the distinct paid ids, which are combined on the map side.
    """
    # The hash as a second key gives both joins the same exchange of the requests, one that skew handling may split.
    known = paid.filter("paid_request_id IS NOT NULL").withColumn("_paid_hash", F.xxhash64("paid_request_id"))
    hashed = requests.filter("request_id IS NOT NULL").withColumn("_hash", F.xxhash64("request_id"))
    same = F.expr("request_id = paid_request_id AND _hash = _paid_hash")
    met = known.join(many(hashed), same).withColumn("is_paid", F.lit(True)).drop("_paid_hash", "_hash", "paid_request_id")
    ids = known.select("paid_request_id", "_paid_hash").distinct()
    unpaid = hashed.join(many(ids), same, "left_anti").withColumn("is_paid", F.lit(False)).drop("_hash")
    return met.unionByName(unpaid, allowMissingColumns=True)


def with_domains(bought: DataFrame, domains: DataFrame) -> DataFrame:
    """The shop domain of each request; a request with several domains repeats."""
    domains = domains.select("buy_request_id", "parsed_domain")
    return splittable_join(bought, domains, "request_id", "buy_request_id", spread="market_package_id")


def purchases(
    t: Tables,
    rates: FeeSchedule | DataFrame,
    services: tuple[str, ...] = PURCHASE_SERVICES,
    child_vendor_22: bool = False,
    asked: DataFrame | None = None,
) -> DataFrame:
    """Requests with their confirmed payments, purchase-date rate and fees.

    Several confirmed payments give several rows, as in the source queries. ``rates`` is a table of fee rates (see
    ``operators.rates``) or the schedule to make one from. An unpaid request has no date and takes the earliest rates.
    ``vendor_child_krw`` leaves marketplace 22 out unless ``child_vendor_22`` is set. Of ``asked``, a frame of
    ``reference_id``, only the requests are kept, before anything is joined to them.
    """
    m = t["market_request"].selectExpr(
        "request_id",
        "package_id AS market_package_id",
        "customer_id AS market_customer_id",
        "market_id",
        "last_status",
        f"COALESCE(last_status = '{CANCELED}', FALSE) AS is_canceled",
        f"{amount('fee_unit_price_krw')} AS unit_krw",
        f"{amount('fee_unit_price_usd')} AS unit_usd",
        "COALESCE(quotation_quantity, 0) AS quantity",
        f"{amount('fee_handling_fee_usd')} AS handling_usd",
        f"{amount('fee_domestic_shipping_price_usd')} AS domestic_usd",
        f"CAST({amount('fee_unit_price_krw')} * COALESCE(quotation_quantity, 0) AS {GOODS}) AS goods_krw",
        "COALESCE(customs_item_description, item_description) AS product_name",
        "customs_category AS product_category",
    )
    if asked is not None:
        m = splittable_join(m, asked, "request_id", "reference_id", spread="market_package_id", how="left_semi")
    joined = with_payments(m, confirmed_payments(t["payment"], services))
    joined = with_fx(joined, daily_fx(t["currency"]), "purchase_date", "buy")
    published = isinstance(rates, FeeSchedule)
    if published:
        rates = rate_table(joined.sparkSession, rates)
    joined = with_rates(joined, rates, "market_id", "purchase_date", spread="request_id", few=published)
    child_rate = "vendor_rate" if child_vendor_22 else "IF(market_id = 22, 0, vendor_rate)"
    fees = {fee: f"{fee}_rate" for fee in FEE_KINDS} | {"vendor_child": child_rate}
    return add_columns(
        joined,
        {
            "discount_usd": amount("discount_usd"),
            "coupon_usd": amount("coupon_usd"),
            "origin_buy": rate_or_fallback("origin_buy"),
            "usd_krw_buy": rate_or_fallback("usd_krw_buy"),
            **{f"{fee}_krw": f"goods_krw * CAST({rate} AS {RATE})" for fee, rate in fees.items()},
        },
    ).drop(*[f"{fee}_rate" for fee in FEE_KINDS])


def clean_merchant(merchant: str) -> str:
    """Parsed shop domain for the standard marketplaces, the typed merchant otherwise."""
    markets = ", ".join(map(str, STANDARD_MARKETS))
    return f"CASE WHEN market_id IN ({markets}) THEN parsed_domain ELSE {merchant} END"


def without_gaps(df: DataFrame) -> DataFrame:
    """Rows without a purchase get zero amounts and the fallback rates."""
    zeros = {c: f"COALESCE({c}, 0)" for c in [*_AMOUNTS, *_FEE_BASES, "quantity"]}
    rates = {c: rate_or_fallback(c) for c in ["origin_buy", "usd_krw_buy"]}
    return add_columns(df, {**zeros, **rates, "is_canceled": "COALESCE(is_canceled, FALSE)"})


def with_both_currencies(df: DataFrame) -> DataFrame:
    """The KRW side of USD items and the USD side of KRW fees, not rounded."""
    krw_side = {f"{item}_krw": f"{item}_usd * usd_krw_buy" for item in _USD_ITEMS}
    usd_side = {base.replace("_krw", "_usd"): to_usd(base, "usd_krw_buy") for base in _FEE_BASES}
    return add_columns(df, {**krw_side, **usd_side})


def _unless_canceled(value: str) -> str:
    return f"CASE WHEN is_canceled THEN 0 ELSE {value} END"


_SHARED_USD = "handling_usd + service_usd + surtax_usd - discount_usd - coupon_usd"
_REVENUE_USD = f"{_SHARED_USD} + goods_usd + domestic_usd + pg_usd"


def exact_goods_terms() -> dict[str, str]:
    """Goods revenue and profit of a single-package purchase: only two fees are rounded."""
    shared = f"handling_krw + {won('service_krw')} + surtax_krw - discount_krw - coupon_krw"
    return {
        "goods_revenue": f"({shared} + goods_krw + domestic_krw + {won('pg_krw')})",
        "goods_revenue_usd_raw": f"({_REVENUE_USD})",
        "goods_profit": f"({shared} - {won('vendor_krw')})",
        "goods_profit_usd_raw": f"({_SHARED_USD} - vendor_usd)",
    }


def child_goods_terms() -> dict[str, str]:
    """Goods terms of a child package: KRW terms rounded one by one, zero when canceled."""
    added = " + ".join(won(c) for c in ["handling_krw", "surtax_krw", "service_krw"])
    shared = f"{added} - {won('discount_krw')} - {won('coupon_krw')}"
    terms = {
        "goods_revenue": f"{shared} + goods_krw + {won('domestic_krw')} + {won('pg_krw')}",
        "goods_revenue_usd_raw": _REVENUE_USD,
        "goods_profit": f"{shared} - {won('vendor_child_krw')}",
        "goods_profit_usd_raw": f"{_SHARED_USD} - vendor_child_usd",
    }
    return {name: f"({_unless_canceled(value)})" for name, value in terms.items()}


# Itemised columns, in result order.
DETAIL_COLUMNS = [
    f"{name}_{currency}"
    for name in (
        "total_goods_price",
        "fee_handling_fee",
        "domestic_shipping_price",
        "surtax",
        "business_fee",
        "pg_fee",
        "service_fee",
        "discount_value",
        "coupon_discount_value",
    )
    for currency in ("krw", "usd")
]

_ITEM_NAMES = {
    "handling": "fee_handling_fee",
    "domestic": "domestic_shipping_price",
    "discount": "discount_value",
    "coupon": "coupon_discount_value",
}


def purchase_details(posted_rate: bool = False, vendor: str = "vendor", canceled_as_zero: bool = True) -> dict[str, str]:
    """Itemised purchase columns; ``posted_rate`` converts USD items at the posted rate."""
    items = {"total_goods_price_krw": "goods_krw", "total_goods_price_usd": cents("goods_usd")}
    for item, name in _ITEM_NAMES.items():
        items[f"{name}_krw"] = won(f"{item}_usd * origin_buy" if posted_rate else f"{item}_krw")
        items[f"{name}_usd"] = f"{item}_usd"
    for source, name in {"surtax": "surtax", vendor: "business_fee", "pg": "pg_fee", "service": "service_fee"}.items():
        items[f"{name}_krw"] = won(f"{source}_krw")
        items[f"{name}_usd"] = cents(f"{source}_usd")
    return {k: _unless_canceled(v) for k, v in items.items()} if canceled_as_zero else items


def goods_per_package(
    children: DataFrame, bought: DataFrame, legacy_pg_usd: bool = False, every_parent: bool = False, items: Mapping[str, str] | None = None
) -> DataFrame:
    """Rounded purchase items summed per parent package, before any 1:N join.

    Only purchase children are needed: a parent that has another kind never uses these
    sums in case 4, and case 5 asks for purchase children itself. Children without a
    request add zeros, so an inner join gives the same sums; ``every_parent`` keeps the rows of
    parents without any request, with zeros. ``legacy_pg_usd`` adds
    ``sum_pg_fee_usd_legacy``, in which the standard marketplaces' fee is still in KRW, a
    known slip of one of the source queries. ``items`` names other expressions of a purchase to sum.
    """
    items = purchase_details() if items is None else dict(items)
    if legacy_pg_usd:
        markets = ", ".join(map(str, STANDARD_MARKETS_20))
        slip = f"CASE WHEN market_id IN ({markets}) THEN {cents('pg_krw')} ELSE {cents('pg_usd')} END"
        items["pg_fee_usd_legacy"] = _unless_canceled(slip)
    is_buy = F.col("reference_type").isin(BUY_TYPES)
    if every_parent:
        kids = children.select("package_id", "inner_package_id", F.when(is_buy, F.col("reference_id")).alias("reference_id"))
    else:
        kids = children.filter(is_buy).select("package_id", "inner_package_id", "reference_id")
    how = "left" if every_parent else "inner"
    # Items are made before the shuffle, which is narrower than what they are made from.
    made = with_both_currencies(bought).selectExpr("request_id", *[f"{sql} AS `{name}`" for name, sql in items.items()])
    joined = splittable_join(kids, made, "reference_id", "request_id", spread="inner_package_id", how=how)
    zero = {name: f"COALESCE({name}, 0)" if every_parent else name for name in items}
    return joined.groupBy("package_id").agg(*[F.expr(f"SUM({sql}) AS sum_{name}") for name, sql in zero.items()])
