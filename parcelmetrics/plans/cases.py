"""The five profit cases: one wide row per package, or per child package and purchase.

All cases are one chain. Rows are tagged with their kind (``1`` to ``5``, children ``3_1``, ``4_1``, ``5_1``), meet fees,
shipping costs, purchases, customers and exchange rates once, each by one join that knows which kinds it is for, and end in
one projection in which a kind may choose its own expression. Fewer kinds leave out the joins that only others need.
``CANONICAL`` is the order of the result columns.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelmetrics.functions.money import FX, KRW, USD, FeeSchedule, amount, cents, rate_or_fallback, to_usd, total, won
from parcelmetrics.operators.columns import add_columns
from parcelmetrics.operators.dedupe import keep_highest
from parcelmetrics.operators.joins import splittable_join, with_fx
from parcelmetrics.operators.packages import PARENT_COLUMNS, SINGLE, child_mix, children_of, families, parents_of
from parcelmetrics.operators.purchases import (
    ASN,
    BUY_TYPES,
    CANCELED,
    DETAIL_COLUMNS,
    PURCHASE_SERVICES,
    clean_merchant,
    child_goods_terms,
    daily_fx,
    exact_goods_terms,
    goods_per_package,
    purchase_details,
    purchases,
    with_both_currencies,
    with_domains,
    without_gaps,
)
from parcelmetrics.sources.schemas import COSTS, FEES
from parcelmetrics.sources.warehouse import Tables

GOODS_TERMS = ["goods_revenue", "goods_revenue_usd_raw", "goods_profit", "goods_profit_usd_raw"]

IDENTITY = [
    "suite_number",
    "market_id",
    "ship_date_kst",
    "trans_at_utc_purchase",
    "trans_at_utc_package",
    "package_id",
    "inner_package_id",
    "profit_case",
    "package_merchant",
    "package_merchant_clean",
    "product_name",
    "product_category",
    "order_type",
    "package_type",
    "country_code",
    "country_name",
    "country_name_kr",
    "carrier",
    "carrier_service",
    "package_weight",
    "dimension_weight",
    "package_count",
    "reference_type",
]
MEASURES = [
    f"{name}_{currency}"
    for name in (
        "goods_revenue",
        "warehouse_revenue",
        "shipping_revenue",
        "revenue",
        "profit",
        "goods_profit",
        "warehouse_profit",
        "shipping_profit",
    )
    for currency in ("krw", "usd")
]
UNIT_COLUMNS = ["fee_unit_price_krw", "fee_unit_price_usd", "quotation_quantity"]
FEE_COLUMNS = [f"{fee}_{currency}" for fee in [*FEES, "shipping_fee"] for currency in ("krw", "usd")]
COST_COLUMNS = [f"{cost}_{currency}" for cost in COSTS for currency in ("krw", "usd")]
RATE_COLUMNS = ["origin_usd_krw_purchase", "usd_krw_purchase", "origin_usd_krw_package", "usd_krw_package"]
CANONICAL = [*IDENTITY, *MEASURES, *UNIT_COLUMNS, *DETAIL_COLUMNS, *FEE_COLUMNS, *COST_COLUMNS, *RATE_COLUMNS]

TEXT_COLUMNS = {
    "suite_number", "profit_case", "package_merchant", "package_merchant_clean", "product_name", "product_category",
    "order_type", "package_type", "country_code", "country_name", "country_name_kr", "carrier", "carrier_service",
    "reference_type",
}
OTHER_TYPES = {
    "market_id": "INT",
    "ship_date_kst": "DATE",
    "trans_at_utc_purchase": "DATE",
    "trans_at_utc_package": "DATE",
    "package_id": "BIGINT",
    "inner_package_id": "BIGINT",
    "package_weight": "DOUBLE",
    "dimension_weight": "DOUBLE",
    "package_count": "INT",
    "quotation_quantity": "INT",
    # A unit price and the goods total keep the decimals they were entered with.
    "fee_unit_price_krw": USD,
    "total_goods_price_krw": USD,
}


def column_type(name: str) -> str:
    if name in TEXT_COLUMNS:
        return "STRING"
    if name in OTHER_TYPES:
        return OTHER_TYPES[name]
    if name in RATE_COLUMNS:
        return FX
    return USD if name.endswith("_usd") else KRW


@dataclass(frozen=True)
class CaseOptions:
    """Parameters of the cases. Defaults follow the source queries, except the PG slip."""

    # Fixed value: first package date.
    start_date: date = date(2025, 1, 1)
    schedule: FeeSchedule = field(default_factory=FeeSchedule)
    # A rate table of one's own, in place of the published schedule.
    rates: DataFrame | None = None
    purchase_services: tuple[str, ...] = PURCHASE_SERVICES
    require_children: bool = False
    trim_before_dedupe: bool = False
    legacy_pg_usd: bool = False
    child_vendor_22: bool = False


#: Kinds of rows: top-level packages, which ship, and children of combined parcels.
SHIPPED, CHILDREN = ("1", "2", "3", "4", "5"), ("3_1", "4_1", "5_1")
KINDS = (*SHIPPED, *CHILDREN)
#: Combined parcels with purchases and their children.
BUNDLES, BUNDLED = ("4", "5"), ("4_1", "5_1")

#: What a row brings from the package table, besides ``_kind``.
ROW_COLUMNS = [*PARENT_COLUMNS, "inner_package_id", "reference_id"]
#: Attributes that children take from their parent: all of them, or those of the route only.
INHERITED = ["trans_at_utc", "ship_at_kst", "package_merchant", "customer_id", "country_code", "carrier", "carrier_service"]
ROUTE = ["country_code", "carrier", "carrier_service"]


def _kinds(names: Iterable[str]) -> str:
    return f"_kind IN ({', '.join(map(repr, names))})"


def choose(wanted: set[str], variants: Mapping[tuple[str, ...], str], otherwise: str = "NULL") -> str:
    """The expression of a row's kind; kinds that are not ``wanted`` leave no trace."""
    used = [(kinds, sql) for own, sql in variants.items() if (kinds := [k for k in own if k in wanted])]
    if wanted - {k for kinds, _ in used for k in kinds}:
        used.append(([], otherwise))
    *branches, (_, last) = used
    branches = [(kinds, sql) for kinds, sql in branches if sql != last]
    return f"CASE {' '.join(f'WHEN {_kinds(kinds)} THEN {sql}' for kinds, sql in branches)} ELSE {last} END" if branches else last


class CaseQueries:
    """Lazily built case results over one set of warehouse tables."""

    def __init__(self, tables: Tables, options: CaseOptions | None = None) -> None:
        self.t = tables
        self.o = options or CaseOptions()
        self.start = F.lit(self.o.start_date)
        self.fx = daily_fx(tables["currency"])
        self.children = children_of(tables["package"])
        self.mix = child_mix(self.children)
        self.families = families(tables["package"], self.start)
        self.bought = self._purchases()

    def _purchases(self, asked: DataFrame | None = None) -> DataFrame:
        rates = self.o.schedule if self.o.rates is None else self.o.rates
        return purchases(self.t, rates, self.o.purchase_services, self.o.child_vendor_22, asked)

    # Rows ----------------------------------------------------------------------------

    def _singles(self, wanted: set[str]) -> DataFrame:
        types = [*([ASN] if "1" in wanted else []), *(BUY_TYPES if "2" in wanted else [])]
        df = self.t["package"].filter(
            (F.col("package_type") == SINGLE) & F.col("reference_type").isin(types) & (F.col("trans_at_utc") >= self.start)
        )
        return df.selectExpr(*ROW_COLUMNS, f"CASE WHEN reference_type = '{ASN}' THEN '1' ELSE '2' END AS _kind")

    def _parents(self, wanted: set[str], itemised: bool) -> DataFrame:
        df = parents_of(self.families, wanted, self.o.require_children).selectExpr(
            *PARENT_COLUMNS, "CAST(0 AS BIGINT) AS inner_package_id", "CAST(NULL AS BIGINT) AS reference_id", "_case AS _kind"
        )
        if not wanted & set(BUNDLES):
            return df
        # Families and sums are both grouped by package, so this join moves nothing.
        if not itemised:
            sums = goods_per_package(self.children, self.bought, items=purchase_goods_terms())
            terms = {f"_bundle_{n}": _term(f"COALESCE(sum_{n}, 0)", n) for n in GOODS_TERMS}
            return add_columns(df.join(sums, "package_id", "left"), terms).drop(*[f"sum_{n}" for n in GOODS_TERMS])
        sums = goods_per_package(self.children, self.bought, self.o.legacy_pg_usd)
        sums = sums.select("package_id", F.struct(*[c for c in sums.columns if c != "package_id"]).alias("_sums"))
        # Four terms in place of all sums travel on where the itemised columns are not asked for.
        terms = {f"_bundle_{n}": _term(sql, n) for n, sql in bundle_goods_terms().items()}
        return add_columns(df.join(sums, "package_id", "left"), terms)

    def _children(self, wanted: set[str]) -> DataFrame:
        """Children with their parent's kind: all attributes of the parent in case 3, its route in cases 4 and 5."""
        parents = parents_of(self.families, {kind[0] for kind in wanted}, self.o.require_children).selectExpr(
            "package_id", "CONCAT(_case, '_1') AS _kind", *[f"{c} AS _parent_{c}" for c in INHERITED]
        )
        # An announced child without an id of its own has no place in case 3.
        announced = f"(_kind <> '3_1' OR (inner_package_id <> 0 AND reference_type = '{ASN}'))"
        kids = self.children.select(*ROW_COLUMNS)
        df = splittable_join(kids, parents, "package_id", "package_id", spread="inner_package_id", how="inner", also=announced)
        taken = {
            c: choose(wanted, {("3_1",): f"_parent_{c}"}, f"_parent_{c}" if c in ROUTE else c) for c in INHERITED
        }
        return add_columns(df, taken).select(*ROW_COLUMNS, "_kind")

    # Joins shared by the cases -------------------------------------------------------

    def shipping_costs(self) -> DataFrame:
        """Highest original cost per tracking number.

        Numbers are told apart as written, so padded copies of one number stay separate
        rows and multiply in the trimmed join; ``trim_before_dedupe`` merges them first.
        """
        costs = self.t["shipping_cost"]
        if self.o.trim_before_dedupe:
            costs = costs.withColumn("tracking_number", F.trim("tracking_number"))
        ties = ["customer_cost", "marked_up_cost", "fuel_surcharge_cost"]
        return keep_highest(costs, "tracking_number", "original_cost", ties)

    def _with_fees(self, df: DataFrame, wanted: set[str]) -> DataFrame:
        """Fees of packages, or of items for children, and their total; a child of case 3 needs an item."""
        columns = [*FEES, "shipping_fee", f"{total(FEES)} AS _fee_total"]
        tables = []
        if wanted & set(SHIPPED):
            tables.append(self.t["package_fee"].selectExpr("named_struct('item', FALSE, 'id', package_id) AS _fees_of", *columns))
        if wanted & set(CHILDREN):
            tables.append(self.t["package_fee_item"].selectExpr("named_struct('item', TRUE, 'id', inner_package_id) AS _fees_of", *columns))
        fees = reduce(DataFrame.unionByName, tables).filter("_fees_of.id IS NOT NULL").withColumn("_has_fees", F.lit(True))
        item = _kinds(CHILDREN)
        key = f"IF({item}, named_struct('item', TRUE, 'id', inner_package_id), named_struct('item', FALSE, 'id', package_id))"
        df = df.withColumn("_fee_key", F.expr(key))
        can = f"IF({item}, inner_package_id, package_id) IS NOT NULL"
        joined = splittable_join(df, fees, "_fee_key", "_fees_of", spread="package_id", only_if=can).drop("_fee_key")
        if "3_1" in wanted:
            joined = joined.filter("_kind <> '3_1' OR _has_fees")
        return joined.drop("_has_fees")

    def _with_costs(self, df: DataFrame, wanted: set[str]) -> DataFrame:
        """Shipping costs by trimmed tracking number; case 3 wants the number as written."""
        costs = self.shipping_costs().withColumnRenamed("tracking_number", "_number").withColumn("_number_trimmed", F.trim("_number"))
        df = df.withColumn("_track", F.trim("track_number"))
        written = "(_kind <> '3' OR track_number = _number)" if "3" in wanted else None
        only_if = _kinds(SHIPPED) if wanted & set(CHILDREN) else None
        return splittable_join(df, costs, "_track", "_number_trimmed", spread="package_id", only_if=only_if, also=written).drop("_track", "_number")

    def _with_purchases(self, df: DataFrame, wanted: set[str]) -> DataFrame:
        """Purchases of single packages, which need a paid one, and of children bought; without one, amounts are zero.

        Single packages alone ask for their own requests only, and of these for paid ones.
        """
        buy = f"reference_type IN ({', '.join(map(repr, BUY_TYPES))})"
        for_kind = choose(wanted, {("2",): "TRUE", BUNDLED: buy}, "FALSE")
        own = f"(package_id = market_package_id AND is_paid AND last_status <> '{CANCELED}')"
        bought = self.bought
        if not wanted & set(BUNDLED):
            asked = df.filter("_kind = '2' AND reference_id IS NOT NULL").select("reference_id")
            bought = self._purchases(asked).filter(f"is_paid AND last_status <> '{CANCELED}'")
        df = splittable_join(
            df,
            with_domains(bought, self.t["request_domain"]).withColumn("_has_purchase", F.lit(True)),
            "reference_id",
            "request_id",
            spread="package_id",
            only_if=for_kind,
            also=f"(_kind <> '2' OR {own})" if "2" in wanted else None,
        )
        if "2" in wanted:
            df = df.filter("_kind <> '2' OR _has_purchase")
        return with_both_currencies(without_gaps(df.drop("_has_purchase")))

    def _with_dimensions(self, df: DataFrame, wanted: set[str]) -> DataFrame:
        """Suite, country names and the package-date rates.

        Spark broadcasts countries by itself; the customer join is a shuffle join in which a
        hot customer can be split.
        The customer of a single purchase is the purchaser.
        """
        suites = self.t["customer"].select(F.col("customer_id").alias("_customer_id"), "suite_number")
        names = self.t["country"].select(
            F.col("country_code").alias("_country"),
            F.col("name_en").alias("country_name"),
            F.col("name_kr").alias("country_name_kr"),
        )
        df = df.withColumn("_customer", F.expr(choose(wanted, {("2",): "market_customer_id"}, "customer_id")))
        df = splittable_join(df, suites, "_customer", "_customer_id", spread="package_id").drop("_customer")
        df = df.join(names, F.col("country_code") == F.col("_country"), "left").drop("_country")
        return with_fx(df, self.fx, "CAST(trans_at_utc AS DATE)", "package")

    # The chain -----------------------------------------------------------------------

    def rows(self, *kinds: str, itemised: bool = True) -> DataFrame:
        """Canonical rows of the given kinds, all in one pass; without the columns of ``ITEMISED`` sums of goods are four, not eighteen."""
        wanted = set(kinds) or set(KINDS)
        parts = []
        if singles := wanted & {"1", "2"}:
            parts.append(self._singles(singles))
        if children := wanted & set(CHILDREN):
            parts.append(self._children(children))
        if parts:
            # Purchases meet their rows before these meet combined parcels, which have none of their own. Goods come to
            # four terms there, and the purchase's own amounts need not pass the shuffles of all rows.
            bought = wanted & {"1", "2", *CHILDREN}
            df = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
            if wanted & {"2", *BUNDLED}:
                df = self._with_purchases(df, bought)
            parts = [with_goods_terms(df, bought)]
        if parents := wanted & {"3", *BUNDLES}:
            parts.append(with_goods_terms(self._parents(parents, itemised), parents))
        df = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
        df = self._with_fees(df, wanted)
        if wanted & set(SHIPPED):
            df = self._with_costs(df, wanted)
        return ledger(self._with_dimensions(df, wanted), wanted, self.o.legacy_pg_usd, itemised)

    def case_1(self) -> DataFrame:
        """Single announced parcels."""
        return self.rows("1")

    def case_2(self) -> DataFrame:
        """Single purchases with a confirmed payment; the customer is the purchaser."""
        return self.rows("2")

    def case_3_parents(self) -> DataFrame:
        """Combined parcels without any child that is not announced."""
        return self.rows("3")

    def case_3_children(self) -> DataFrame:
        """Announced children of case 3: dates, merchant, customer and route of the parent."""
        return self.rows("3_1")

    def case_4_parents(self) -> DataFrame:
        """Combined parcels, not forwarded, holding purchases only."""
        return self.rows("4")

    def case_5_parents(self) -> DataFrame:
        """Combined parcels holding both purchases and announced parcels, nothing else."""
        return self.rows("5")

    def case_4_children(self) -> DataFrame:
        """Children with their own dates, merchant and customer, and the parent's route."""
        return self.rows("4_1")

    def case_5_children(self) -> DataFrame:
        return self.rows("5_1")

    def case_3(self) -> DataFrame:
        return self.rows("3", "3_1")

    def case_4(self) -> DataFrame:
        return self.rows("4", "4_1")

    def case_5(self) -> DataFrame:
        return self.rows("5", "5_1")

    def parents(self) -> dict[int, DataFrame]:
        """The cases without children, as roll-ups count them: nothing that only children need is read."""
        return {int(kind): self.rows(kind) for kind in SHIPPED}

    def all(self) -> dict[int, DataFrame]:
        return {1: self.case_1(), 2: self.case_2(), 3: self.case_3(), 4: self.case_4(), 5: self.case_5()}


def case_table(cases: CaseQueries) -> DataFrame:
    """All rows of all cases in one frame and one pass."""
    return cases.rows(*KINDS)


def _summed(name: str) -> str:
    return f"COALESCE(_sums.sum_{name}, 0)"


def bundle_goods_terms(of: Callable[[str], str] = _summed) -> dict[str, str]:
    """Goods terms of a combined parcel from the sums over its purchases, or of whatever else ``of`` names items of."""
    terms = {}
    for currency, revenue, profit in [
        ("krw", "goods_revenue", "goods_profit"),
        ("usd", "goods_revenue_usd_raw", "goods_profit_usd_raw"),
    ]:
        added = " + ".join(of(f"{n}_{currency}") for n in ["fee_handling_fee", "surtax", "service_fee"])
        taken = " + ".join(of(f"{n}_{currency}") for n in ["discount_value", "coupon_discount_value"])
        more = " + ".join(of(f"{n}_{currency}") for n in ["total_goods_price", "domestic_shipping_price", "pg_fee"])
        terms[revenue] = f"({added} + {more} - ({taken}))"
        terms[profit] = f"({added} - ({taken}) - {of(f'business_fee_{currency}')})"
    return terms


def purchase_goods_terms() -> dict[str, str]:
    """The same terms of one purchase: of its rounded items, so that their sums are the terms of the sums."""
    items = purchase_details()
    return bundle_goods_terms(lambda name: f"COALESCE({items[name]}, 0)")


def _purchase_columns() -> dict[str, str]:
    return {
        "package_merchant_clean": clean_merchant("package_merchant"),
        "fee_unit_price_krw": "unit_krw",
        "fee_unit_price_usd": "unit_usd",
        "quotation_quantity": "quantity",
        "trans_at_utc_purchase": "purchase_date",
        "origin_usd_krw_purchase": "origin_buy",
        "usd_krw_purchase": "usd_krw_buy",
        "product_name": "product_name",
        "product_category": "product_category",
        "market_id": "market_id",
    }


#: Columns about the goods themselves, which nothing that adds rows up reads.
ITEMISED = {*DETAIL_COLUMNS, *_purchase_columns()}


def _details(wanted: set[str], legacy_pg_usd: bool) -> dict[str, str]:
    """Columns about goods, which only kinds with purchases have."""
    bundle = {name: _summed(name) for name in DETAIL_COLUMNS}
    if legacy_pg_usd:
        bundle["pg_fee_usd"] = f"CASE WHEN _kind = '4' THEN {_summed('pg_fee_usd_legacy')} ELSE {_summed('pg_fee_usd')} END"
    bundle |= {name: "0" for name in ["market_id", *UNIT_COLUMNS]}
    bundle |= {name: "1450" for name in ["origin_usd_krw_purchase", "usd_krw_purchase"]}
    single = {**_purchase_columns(), **purchase_details(posted_rate=True, canceled_as_zero=False)}
    child = {**_purchase_columns(), **purchase_details(vendor="vendor_child")}
    names = [*DETAIL_COLUMNS, *_purchase_columns()]
    return {n: choose(wanted, {("2",): single[n], BUNDLED: child[n], BUNDLES: bundle.get(n, "NULL")}) for n in names}


def _term(sql: str, name: str) -> str:
    """A term in the one type of all kinds: left to itself, a common type of theirs would lose decimals."""
    return f"CAST({sql} AS {'DECIMAL(36,9)' if 'usd' in name else 'DECIMAL(36,6)'})"


def with_goods_terms(df: DataFrame, wanted: set[str]) -> DataFrame:
    exact, child = exact_goods_terms(), child_goods_terms()
    terms = {}
    for n in GOODS_TERMS:
        of_kind = {("2",): _term(exact[n], n), BUNDLED: _term(child[n], n), BUNDLES: f"_bundle_{n}"}
        terms[n] = choose(wanted, of_kind, _term("0", n))
    return add_columns(df, terms)


def ledger(df: DataFrame, wanted: set[str], legacy_pg_usd: bool = False, itemised: bool = True) -> DataFrame:
    """Measures from warehouse fees, shipping costs and goods terms.

    Children have no shipping cost and no shipping profit. A missing markup leaves shipping and total profit NULL.
    Canceled children have zero total profit but keep warehouse profit. Kinds with several purchases show missing option
    fees as zero, single purchases do so for the itemised shipping costs.
    """
    df = add_columns(
        df,
        {
            "_fx": rate_or_fallback("usd_krw_package"),
            "_warehouse": "COALESCE(_fee_total, 0)",
            "_shipping": amount("shipping_fee"),
        },
    )
    profit, profit_usd = "goods_profit + _warehouse * _fx", "goods_profit_usd_raw + _warehouse"
    shipped, shipped_usd = f"{profit} + marked_up_cost", f"{profit_usd} + {to_usd('marked_up_cost', '_fx')}"
    profit, profit_usd = (
        choose(wanted, {SHIPPED: _term(ships, n), BUNDLED: f"(CASE WHEN is_canceled THEN {_term('0', n)} ELSE {_term(own, n)} END)"}, _term(own, n))
        for n, ships, own in (("goods_profit", shipped, profit), ("goods_profit_usd_raw", shipped_usd, profit_usd))
    )

    out = {
        "ship_date_kst": "CAST(ship_at_kst AS DATE)",
        "trans_at_utc_package": "CAST(trans_at_utc AS DATE)",
        "profit_case": "_kind",
        "package_merchant": choose(wanted, {BUNDLES: "NULL"}, "package_merchant"),
        "goods_revenue_krw": won("goods_revenue"),
        "goods_revenue_usd": cents("goods_revenue_usd_raw"),
        "warehouse_revenue_krw": won("_warehouse * _fx"),
        "warehouse_revenue_usd": cents("_warehouse"),
        "shipping_revenue_krw": won("_shipping * _fx"),
        "shipping_revenue_usd": "_shipping",
        "revenue_krw": won("goods_revenue + (_warehouse + _shipping) * _fx"),
        "revenue_usd": cents("goods_revenue_usd_raw + _warehouse + _shipping"),
        "profit_krw": won(profit),
        "profit_usd": cents(profit_usd),
        "goods_profit_krw": won("goods_profit"),
        "goods_profit_usd": cents("goods_profit_usd_raw"),
        "warehouse_profit_krw": won("_warehouse * _fx"),
        "warehouse_profit_usd": cents("_warehouse"),
        "origin_usd_krw_package": rate_or_fallback("origin_package"),
        "usd_krw_package": "_fx",
        "shipping_fee_krw": won("_shipping * _fx"),
        "shipping_fee_usd": "shipping_fee",
        **(_details(wanted, legacy_pg_usd) if itemised else {}),
    }
    for fee in FEES:
        out[f"{fee}_krw"] = won(f"{amount(fee)} * _fx")
        out[f"{fee}_usd"] = choose(wanted, {(*BUNDLES, *BUNDLED): amount(fee)}, fee)
    # Children meet no shipping cost, so its columns are empty for them.
    if wanted & set(SHIPPED):
        out["shipping_profit_krw"] = won("marked_up_cost")
        out["shipping_profit_usd"] = cents(to_usd("marked_up_cost", "_fx"))
        for cost in COSTS:
            value = choose(wanted, {("2",): amount(cost)}, cost)
            out[f"{cost}_krw"] = won(value)
            out[f"{cost}_usd"] = cents(to_usd(value, "_fx"))

    present = set(df.columns)
    names = CANONICAL if itemised else [name for name in CANONICAL if name not in ITEMISED]
    source = {name: out.get(name, f"`{name}`" if name in present else "NULL") for name in names}
    return df.selectExpr(*[f"CAST({sql} AS {column_type(name)}) AS `{name}`" for name, sql in source.items()])
