"""Roll-up rules that the generated tables do not reach."""

from __future__ import annotations

from decimal import Decimal

import pytest

from parcelmetrics.functions import labels
from parcelmetrics.plans import rollups
from parcelmetrics.plans.cases import CaseQueries
from tests.test_cases import mixed_parents


@pytest.mark.parametrize(
    "weight,label",
    [(0, 0), (1000, 0), (1000.1, 1), (3000, 1), (20000, 4), (20000.5, 5), (-1, None), (None, None), ("heavy", None), ("2500", 1)],
)
def test_weight_bins(spark, weight, label):
    kind = "string" if isinstance(weight, str) else "double"
    value = weight if isinstance(weight, str) or weight is None else float(weight)
    df = spark.createDataFrame([(value,)], f"w {kind}")
    assert df.selectExpr(labels.weight_bin("w")).collect()[0][0] == label


@pytest.mark.parametrize("grams,group", [(0, 0.5), (-5, 0.5), (500, 0.5), (501, 1.0), (10000, 10.0), (None, 0.5)])
def test_weight_groups(spark, grams, group):
    df = spark.createDataFrame([(None if grams is None else float(grams),)], "w double")
    assert df.selectExpr(labels.weight_group("w")).collect()[0][0] == group


@pytest.mark.parametrize(
    "carrier,service,key",
    [("DHL_EXPRESS", None, "DHL"), ("fedex", "x", "FEDEX"), ("DHL", "kpacket", "kpacket"), ("UPS", "ems", "EMS"), ("SEA", None, "other"), (None, None, "other")],
)
def test_carrier_keys(spark, carrier, service, key):
    df = spark.createDataFrame([(carrier, service)], "carrier string, carrier_service string")
    assert df.selectExpr(labels.carrier_key()).collect()[0][0] == key


@pytest.mark.parametrize("code,valid", [("KR", True), ("kr", False), ("KOR", False), ("K1", False), (None, False), ("KR\n", False)])
def test_country_codes(spark, code, valid):
    df = spark.createDataFrame([(code,)], "country_code string")
    assert df.selectExpr(labels.is_country_code()).collect()[0][0] is valid


def test_scalar_helpers(spark):
    one = spark.sql("SELECT 1")
    value = lambda sql: one.selectExpr(f"{sql} AS v").collect()[0].v
    assert value(labels.in_currency("2900", "CAST(NULL AS DOUBLE)", "1450")) == 2.0
    assert value(labels.in_currency("2900", "3D", "1450")) == 3.0
    assert value(labels.kilograms("2500")) == 2.5
    assert value(labels.kst_minute("TIMESTAMP '2026-03-20 01:30:00'")) == "2026-03-20 10:30 KST"
    assert str(value(labels.reporting_week("'2026-03-20'"))) == "2026-03-09"
    assert str(value(labels.reporting_week("'2026-03-23'"))) == "2026-03-16"


def test_standardize_fallbacks(spark):
    old = spark.createDataFrame([(1, 5, 7, 11.0, None)], "package_id int, storage_fee_krw int, receiving_fee_krw int, shipping_fee double, usd_krw_package double")
    row = rollups.standardize(old, 4).collect()[0]
    # Receiving fees are not among the nine summed; a missing rate is 1450.
    assert (row.warehouse_revenue_krw, row.warehouse_revenue_usd) == (5, 0)
    assert (row.shipping_revenue_krw, row.shipping_revenue_usd) == (15950, 11)
    assert (row.goods_revenue_krw, row.marked_up_cost_krw) == (0, 0)
    older = spark.createDataFrame([(None, 2)], "revenue_sto_krw int, revenue_sto_usd int")
    assert rollups.standardize(older, 1).collect()[0].warehouse_revenue_krw == 0


def test_combined_rows_and_profiles(spark):
    q = CaseQueries(mixed_parents(spark))
    combined = rollups.combine(q.all())
    assert sorted({r.source_case for r in combined.collect()}) == ["Case 3", "Case 4", "Case 5"]
    assert {r.suite_number for r in combined.collect()} == {"Unknown"}
    profile = rollups.suite_profiles(combined).collect()[0]
    # No package has a markup: profit is empty, never guessed.
    assert profile.profit_pkg_count == 0 and profile.total_profit == 0
    assert profile.total_packages == 8 and profile.avg_package_weight is None
    assert profile.case_stats["Case 3"]["count"] == 6 and profile.country_counts == {"US": 8}
    parts = combined.select("goods_profit_krw", "warehouse_profit_krw").distinct().collect()
    assert [tuple(r) for r in parts] == [(None, None)]


def test_one_decimal_ties_go_to_even(spark):
    one = spark.sql("SELECT 1")
    for total, count, expected in [(49, 4, 12.2), (51, 4, 12.8), (1, 3, 0.3), (5, 0, 5.0)]:
        assert one.selectExpr(f"{rollups.one_decimal(f'{total}D', count)} AS v").collect()[0].v == expected


def test_search_needs_two_characters(spark):
    totals = spark.createDataFrame([("AB1", 1, 1), ("Z9996", 2, 2)], "suite_number string, total_profit int, total_profit_usd int")
    find = lambda text, **k: [r.suite_number for r in rollups.search_suites(totals, text, **k).collect()]
    assert find("ab") == ["AB1"] and find("a") == []
    assert find("z99") == ["Z9996"] and find("z99", exclude_admins=True) == []


def test_top_share_takes_at_least_one_suite(spark):
    rows = [("a", Decimal(100)), ("b", Decimal(60)), ("c", Decimal(40))]
    totals = spark.createDataFrame(rows, "suite_number string, total_revenue decimal(18,0)")
    row = rollups.concentration(totals).collect()[0]
    assert (row.top_1_percent_count, row.top_10_percent_contribution) == (1, 50.0)
