"""Quirks of the case queries on hand-built tables."""

from __future__ import annotations

from dataclasses import replace
from datetime import date

import pytest

from parcelmetrics.functions.money import FeeSchedule
from parcelmetrics.operators.dedupe import keep_highest
from parcelmetrics.operators.purchases import daily_fx, purchases
from parcelmetrics.plans.cases import CaseOptions, CaseQueries
from tests.builders import DAY, child, cost, frame, paid, parent, request, tables

DEFAULT = CaseOptions()


def single(package_id=1, **more):
    return {"package_id": package_id, "package_type": "SINGLE", "reference_type": "ASN", "customer_id": 1,
            "trans_at_utc": DAY, "ship_at_kst": DAY, "track_number": f"T{package_id}", **more}


def rows(df, *names):
    return sorted(tuple(r) for r in df.select(*names).collect())


def test_missing_markup_leaves_profit_null(spark):
    t = tables(spark, package=[single(1), single(2)], package_fee=[{"package_id": 1, "storage_fee": 2}],
               shipping_cost=[cost("T2", markup=500)])
    got = rows(CaseQueries(t).case_1(), "package_id", "profit_krw", "warehouse_profit_krw", "shipping_profit_krw")
    assert got == [(1, None, 2900, None), (2, 500, 0, 500)]


def test_case_2_shows_zero_costs_but_null_profit(spark):
    t = tables(spark, package=[single(1, reference_type="BUYFORME", reference_id=9)],
               market_request=[request(9, 2, package_id=1)], payment=[paid(9)])
    assert rows(CaseQueries(t).case_2(), "marked_up_cost_krw", "profit_krw", "goods_profit_krw") == [(0, None, -718)]


def test_case_2_drops_null_status_and_unpaid(spark):
    t = tables(spark, package=[single(i, reference_type="BUY_REQUEST", reference_id=i) for i in (1, 2, 3, 4)],
               market_request=[request(1, 1, package_id=1), request(2, 1, package_id=2, last_status=None),
                               request(3, 1, package_id=3), request(4, 1, package_id=5)],
               payment=[paid(1), paid(2), paid(4), {**paid(3), "transaction_status": "PENDING"}])
    assert rows(CaseQueries(t).case_2(), "package_id") == [(1,)]


@pytest.mark.parametrize(
    "market,day,pg,service,surtax,vendor",
    [
        (1, date(2025, 1, 1), 800, 500, 1000, 0),
        (19, date(2025, 1, 1), 800, 500, 1000, 500),
        (20, date(2025, 1, 1), 800, 700, 1000, 0),
        (2, date(2025, 12, 7), 778, 0, 0, 718),
        (2, date(2025, 12, 8), 778, 0, 0, 218),
        (21, date(2025, 12, 9), 1164, 0, 0, 218),
        (22, date(2026, 1, 31), 778, 718, 0, 500),
        (22, date(2026, 2, 1), 778, 718, 0, 400),
        (33, date(2026, 2, 1), 0, 800, 0, 0),
        (34, date(2026, 2, 1), 0, 700, 0, 0),
        (15, date(2026, 2, 1), 0, 0, 0, 0),
    ],
)
def test_fee_rates_either_side_of_each_change(spark, market, day, pg, service, surtax, vendor):
    t = tables(spark, market_request=[request(1, market)], payment=[paid(1, day)])
    row = purchases(t, FeeSchedule()).collect()[0]
    assert [int(row[c]) for c in ("pg_krw", "service_krw", "surtax_krw", "vendor_krw")] == [pg, service, surtax, vendor]
    assert int(row["vendor_child_krw"]) == (0 if market == 22 else vendor)


def test_unpaid_purchase_uses_the_undated_rate(spark):
    t = tables(spark, market_request=[request(1, 2)])
    row = purchases(t, FeeSchedule()).collect()[0]
    assert (int(row["pg_krw"]), int(row["vendor_krw"]), row["is_paid"]) == (778, 718, False)


def mixed_parents(spark):
    kinds = {10: ["ASN", "ASN"], 20: ["BUY_REQUEST", "BUYFORME"], 30: ["ASN", "BUY_REQUEST"], 40: ["ASN", None],
             50: ["BUY_REQUEST", None], 60: ["ASN", "OTHER"], 70: [], 80: [None]}
    packages = [parent(p) for p in kinds]
    packages += [child(p, p + i + 1, k) for p, ks in kinds.items() for i, k in enumerate(ks)]
    return tables(spark, package=[*packages, parent(90, order_type="WE_SHIP"), parent(100, order_type=None)])


def test_parent_populations(spark):
    q = CaseQueries(mixed_parents(spark))
    ids = lambda df: sorted(r.package_id for r in df.collect())
    # A missing type counts for case 3 and against cases 4 and 5; childless parents pass 3 and 4.
    assert ids(q.case_3_parents()) == [10, 40, 70, 80, 90, 100]
    assert ids(q.case_4_parents()) == [20, 70]
    assert ids(q.case_5_parents()) == [30]


def test_require_children_makes_parents_disjoint(spark):
    q = CaseQueries(mixed_parents(spark), replace(DEFAULT, require_children=True))
    assert sorted(r.package_id for r in q.case_3_parents().collect()) == [10, 40, 80]
    assert sorted(r.package_id for r in q.case_4_parents().collect()) == [20]


def test_padded_tracking_numbers(spark):
    t = tables(spark, package=[single(1), parent(2, track_number="T2")],
               shipping_cost=[cost("T1", 10), cost(" T1", 20), cost("T1", 5), cost("T2 ", 7)])
    q = CaseQueries(t)
    # Padded copies survive the dedupe and multiply in the trimmed join; case 3 does not trim.
    assert rows(q.case_1(), "original_cost_krw") == [(10,), (20,)]
    assert rows(q.case_3_parents(), "original_cost_krw") == [(None,)]
    trimmed = CaseQueries(t, replace(DEFAULT, trim_before_dedupe=True))
    assert rows(trimmed.case_1(), "original_cost_krw") == [(20,)]


def test_case_3_child_sources(spark):
    t = tables(
        spark,
        package=[parent(1, carrier="DHL", package_merchant="shop"), child(1, 11, "ASN", carrier="EMS", package_weight=5.0),
                 child(1, 12, "ASN"), child(1, 0, "ASN"), child(1, 13, None)],
        package_fee_item=[{"inner_package_id": i, "repack_fee": 1} for i in (11, 0, 13)],
    )
    got = rows(CaseQueries(t).case_3_children(), "inner_package_id", "carrier", "package_merchant", "package_weight", "profit_krw")
    # Id 0, missing types and children without an item are left out; route and merchant are the parent's.
    assert got == [(11, "DHL", "shop", 5.0, 1450)]


def test_canceled_child_keeps_warehouse_profit(spark):
    t = tables(spark, package=[parent(1), child(1, 11, "BUY_REQUEST"), child(1, 12, "BUYFORME")],
               market_request=[request(11, 1, last_status="CANCELED"), request(12, 1)], payment=[paid(11), paid(12)],
               package_fee_item=[{"inner_package_id": 11, "storage_fee": 1}])
    q = CaseQueries(t)
    got = rows(q.case_4_children(), "inner_package_id", "goods_revenue_krw", "profit_krw", "warehouse_profit_krw", "revenue_krw")
    assert got == [(11, 0, 0, 1450, 1450), (12, 12300, 1500, 0, 12300)]
    assert rows(q.case_4_parents(), "total_goods_price_krw", "goods_profit_krw") == [(10000, 1500)]


def test_two_payments_double_the_sums(spark):
    t = tables(spark, package=[parent(1), child(1, 11, "BUY_REQUEST")], market_request=[request(11, 1)],
               payment=[paid(11), paid(11)])
    q = CaseQueries(t)
    assert rows(q.case_4_parents(), "total_goods_price_krw") == [(20000,)]
    assert q.case_4_children().count() == 2


def test_vendor_fee_of_market_22(spark):
    t = tables(spark, package=[parent(1), child(1, 11, "BUY_REQUEST")], market_request=[request(11, 22)], payment=[paid(11)])
    q = CaseQueries(t)
    assert rows(q.case_4_parents(), "business_fee_krw", "goods_profit_krw") == [(500, 218)]
    assert rows(q.case_4_children(), "business_fee_krw", "goods_profit_krw") == [(0, 718)]
    with_22 = CaseQueries(t, replace(DEFAULT, child_vendor_22=True))
    assert rows(with_22.case_4_children(), "business_fee_krw", "goods_profit_krw") == [(500, 218)]


def test_legacy_pg_fee_stays_in_krw(spark):
    t = tables(spark, package=[parent(1), child(1, 11, "BUY_REQUEST")], market_request=[request(11, 1, price=14500)],
               payment=[paid(11)])
    assert [float(r[0]) for r in rows(CaseQueries(t).case_4_parents(), "pg_fee_usd")] == [0.8]
    legacy = CaseQueries(t, replace(DEFAULT, legacy_pg_usd=True))
    assert [float(r[0]) for r in rows(legacy.case_4_parents(), "pg_fee_usd")] == [1160.0]


def test_case_5_announced_child_has_no_purchase(spark):
    t = tables(spark, package=[parent(1), child(1, 11, "BUY_REQUEST"), child(1, 12, "ASN")],
               market_request=[request(11, 1), request(12, 1)], payment=[paid(11), paid(12)])
    got = rows(CaseQueries(t).case_5_children(), "inner_package_id", "market_id", "goods_revenue_krw", "profit_krw")
    assert got == [(11, 1, 12300, 1500), (12, None, 0, 0)]


def test_exchange_rate_ties_and_fallback(spark):
    fx = [{"currency_date": date(2025, 6, 1), "origin_usd_krw": 1400, "usd_krw": r} for r in (1380, 1390)]
    fx += [{"currency_date": date(2025, 6, 2), "origin_usd_krw": r, "usd_krw": 1} for r in (1, 2)]
    got = rows(daily_fx(frame(spark, "currency", fx)), "currency_date", "origin_usd_krw", "usd_krw")
    assert [(str(d), float(a), float(b)) for d, a, b in got] == [("2025-06-01", 1400, 1390), ("2025-06-02", 2, 1)]


def test_parts_of_profit_add_up(spark):
    t = tables(spark, package=[single(1, reference_type="BUY_REQUEST", reference_id=9)], package_fee=[{"package_id": 1, "repack_fee": 3}],
               market_request=[request(9, 3, package_id=1, fee_handling_fee_usd=2)], payment=[paid(9)], shipping_cost=[cost("T1")])
    r = CaseQueries(t).case_2().collect()[0]
    assert r.profit_krw == r.goods_profit_krw + r.warehouse_profit_krw + r.shipping_profit_krw
    assert r.revenue_krw == r.goods_revenue_krw + r.warehouse_revenue_krw + r.shipping_revenue_krw


def test_keep_highest_puts_null_values_last(spark):
    df = spark.createDataFrame([("a", None, 1), ("a", 3, 2), ("b", None, 3), (None, 9, 4)], "k string, v int, t int")
    assert rows(keep_highest(df, "k", "v", ["t"]), "k", "t") == [("a", 2), ("b", 3)]
