"""The rate table: lookups by day, and what a table should not hold."""

from __future__ import annotations

from datetime import date
from decimal import Decimal

from dataclasses import replace

from parcelmetrics.functions.money import FeeSchedule
from parcelmetrics.operators.purchases import purchases
from parcelmetrics.operators.rates import RATES, elementary_periods, rate_problems, rate_table, with_rates
from parcelmetrics.plans.cases import CaseOptions, CaseQueries
from tests.builders import child, paid, parent, request, tables


def table(spark, rows):
    return spark.createDataFrame([(f, m, a, b, Decimal(r)) for f, m, a, b, r in rows], RATES)


def day(text):
    return date.fromisoformat(text)


def test_a_day_finds_its_period(spark):
    rates = table(
        spark,
        [
            ("pg", 1, None, day("2025-01-10"), "0.01"),
            ("pg", 1, day("2025-01-10"), day("2025-02-01"), "0.02"),
            ("pg", 1, day("2025-03-01"), None, "0.03"),
            ("vendor", 1, day("2025-01-20"), None, "0.5"),
        ],
    )
    days = ["2025-01-09", "2025-01-10", "2025-01-20", "2025-02-01", "2025-03-01", None]
    df = spark.createDataFrame([(k, 1, d and day(d)) for k, d in enumerate(days)] + [(9, 2, day("2025-01-10")), (10, None, None)], "id long, m int, d date")
    got = {r.id: (float(r.pg_rate), float(r.vendor_rate)) for r in with_rates(df, rates, "m", "d", spread="id", fees=("pg", "vendor")).collect()}
    # In the gap and for other markets there is no rate; without a day the earliest counts.
    assert got == {0: (0.01, 0), 1: (0.02, 0), 2: (0.02, 0.5), 3: (0, 0.5), 4: (0.03, 0.5), 5: (0.01, 0), 9: (0, 0), 10: (0, 0)}


def test_problems_are_found(spark):
    rates = table(
        spark,
        [
            ("pg", 1, None, day("2025-01-10"), "0.01"),
            ("pg", 1, day("2025-01-05"), day("2025-02-01"), "0.02"),
            ("pg", 1, day("2025-03-01"), None, "0.03"),
            ("pg", 2, day("2025-01-01"), day("2025-12-31"), "0.01"),
            ("pg", 2, day("2025-02-01"), day("2025-03-01"), "0.02"),
            ("pg", 3, day("2025-02-01"), day("2025-01-01"), "0.02"),
        ],
    )
    got = {(r.market_id, r.problem, str(r.since), str(r.until)) for r in rate_problems(rates).collect()}
    assert got == {
        (1, "overlap", "2025-01-05", "2025-01-10"),
        (1, "gap", "2025-02-01", "2025-03-01"),
        (2, "overlap", "2025-02-01", "2025-03-01"),
        (3, "empty", "2025-02-01", "2025-01-01"),
    }
    # Where periods overlap, the one that began last counts.
    pieces = {(r.market_id, str(r.since)): float(r.pg_rate) for r in elementary_periods(rates, ("pg",)).collect()}
    assert pieces[(1, "2025-01-05")] == 0.02 and pieces[(2, "2025-02-01")] == 0.02 and pieces[(2, "2025-03-01")] == 0.01


def test_the_published_schedule_has_no_problems(spark):
    assert rate_problems(rate_table(spark, FeeSchedule())).count() == 0


def test_a_changed_rate_is_a_changed_row(spark):
    t = tables(spark, package=[parent(1), child(1, 11, "BUY_REQUEST")], market_request=[request(11, 1)], payment=[paid(11)])
    published = rate_table(spark, FeeSchedule())
    changed = published.selectExpr("fee", "market_id", "valid_from", "valid_to", "IF(fee = 'service' AND market_id = 1, CAST(0.06 AS DECIMAL(5,4)), rate) AS rate")
    assert [int(r.service_krw) for r in purchases(t, changed).collect()] == [600]
    fees = [r.service_fee_krw for r in CaseQueries(t, replace(CaseOptions(), rates=changed)).case_4_parents().collect()]
    assert [int(f) for f in fees] == [600]


def test_a_shop_in_two_domains_does_not_double_the_sums(spark):
    t = tables(spark, package=[parent(1), child(1, 11, "BUY_REQUEST")], market_request=[request(11, 1)], payment=[paid(11)],
               request_domain=[{"buy_request_id": 11, "parsed_domain": d} for d in ("a.example", "b.example")])
    q = CaseQueries(t)
    assert [int(r.total_goods_price_krw) for r in q.case_4_parents().collect()] == [10000]
    assert sorted(r.package_merchant_clean for r in q.case_4_children().collect()) == ["a.example", "b.example"]


def test_parents_without_a_request_keep_zero_sums(spark):
    from parcelmetrics.operators.purchases import goods_per_package

    t = tables(spark, package=[child(1, 11, "BUY_REQUEST"), child(2, 21, "BUY_REQUEST"), child(3, 31, "ASN")], market_request=[request(11, 1)], payment=[paid(11)])
    q = CaseQueries(t)
    got = {r.package_id: int(r.sum_total_goods_price_krw) for r in goods_per_package(q.children, q.bought, every_parent=True).collect()}
    assert got == {1: 10000, 2: 0, 3: 0}
