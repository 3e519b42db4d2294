"""Competitor rates, weekly reports and tiers: quirks and published figures."""

from __future__ import annotations

from datetime import date, timedelta
from decimal import Decimal

import pytest

from parcelmetrics.sources.sample import SampleViews
from parcelmetrics.plans import competitors, tiers, weekly

PLATFORMS = competitors.Platforms(own=["own"], competitors=["rival"])
CARD = "country string, weight double, carrier string, platform string, fee long"


def card(spark, rows):
    return spark.createDataFrame(rows, CARD)


def test_gaps_ties_zero_fees_and_missing_sides(spark):
    df = card(
        spark,
        [
            ("JP", 0.5, "EMS", "own", 900), ("JP", 0.5, "DHL", "own", 900), ("JP", 0.5, "UPS", "rival", 800),
            ("JP", 0.5, "FEDEX", "rival", 0), ("JP", 0.5, "Sea Parcel", "rival", 1),
            ("JP", 0.5, "k-packet", "own", 500), ("JP", 1.0, "k-packet", "rival", 400), ("JP", 1.0, "EMS", "other", 10),
        ],
    )
    got = {r.weight: r for r in competitors.rate_gaps(df, PLATFORMS).collect()}
    assert (got[0.5].gap_express_pct, got[0.5].express_cheapest_fee, got[0.5].express_cheapest_carrier, got[0.5].competitor_express_min) == (12.5, 900, "DHL", 800)
    assert got[0.5].gap_standard_pct is None and got[1.0].gap_standard_pct is None


def test_gap_rounds_ties_to_even(spark):
    one = spark.sql("SELECT 1")
    for own, other, expected in [(2245, 2000, 12.2), (2255, 2000, 12.8), (1755, 2000, -12.2)]:
        assert one.selectExpr(f"{competitors.gap_percent(str(own), str(other))} AS v").collect()[0].v == expected


def test_refresh_keeps_earlier_gaps(spark):
    rows = spark.createDataFrame([("JP", 0.5, 1.0), ("JP", 1.0, 2.0)], "country string, weight double, gap_express_pct double")
    gaps = spark.createDataFrame([("JP", 0.5, 9.0), ("JP", 1.0, None)], "country string, weight double, gap_express_pct double")
    got = {r.weight: r.gap_express_pct for r in competitors.refresh_gaps(rows, gaps).collect()}
    assert got == {0.5: 9.0, 1.0: 2.0}


def test_tariff_merge_replaces_and_adds(spark):
    base = card(spark, [("JP", 0.5, "EMS", "own", 1), ("JP", 0.5, "EMS", "new", 2), ("KR", 0.5, "EMS", "new", 3)])
    tariff = card(spark, [("JP", 0.5, "EMS", "new", 20), ("JP", 0.5, "DHL", "new", 30), ("JP", 9.0, "DHL", "new", 40), ("FR", 0.5, "DHL", "new", 50)])
    got = sorted(tuple(r) for r in competitors.merge_tariff(base, tariff).collect())
    assert got == [("JP", 0.5, "DHL", "new", 30), ("JP", 0.5, "EMS", "new", 20), ("JP", 0.5, "EMS", "own", 1), ("KR", 0.5, "EMS", "new", 3)]


def test_tariff_merge_rounds_the_card_once(spark):
    base = card(spark, [("JP", 0.30000000000000004, "EMS", "own", 1), ("JP", 0.5, "EMS", "own", 2)])
    got = sorted(tuple(r) for r in competitors.merge_tariff(base, card(spark, [("JP", 0.3, "EMS", "own", 9)])).collect())
    assert got == [("JP", 0.3, "EMS", "own", 9), ("JP", 0.5, "EMS", "own", 2)]


def test_weekly_trend_goes_by_the_calendar(spark):
    weeks = [(date(2024, 1, 1), 10), (date(2024, 1, 8), 20), (date(2024, 1, 29), 30), (date(2024, 2, 5), 40)]
    series = spark.createDataFrame([("s", w, n, n) for w, n in weeks], "service string, week_start date, n long, revenue long")
    got = {r.week_start: r for r in weekly.weekly_trend(series, ["service"]).collect()}
    assert [got[w].prior_n for w, _ in weeks] == [None, 10, None, 30]
    # Of the four weeks before, those without payments count as zero.
    assert [got[w].n_avg4 for w, _ in weeks] == [None, 10, 7.5, 12.5]


def test_tier_views_count_every_order(spark):
    views = SampleViews(spark, "/root/testdata/sf0.001")
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet").selectExpr("SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS s", "COUNT(*) AS n").first()
    assert views["customer_year"].selectExpr("SUM(total_amount)").first()[0] == orders.s
    assert views["weekly_orders"].count() == orders.n


def test_volumes_zero_and_untouched(spark):
    rows = spark.createDataFrame(
        [(1, "JP", 700.0, "DHL", None, date(2025, 1, 1)), (1, "JP", 700.0, "EMS", None, date(2025, 12, 31)),
         (2, "JP", None, "SEA", None, date(2025, 5, 5)), (3, "KR", 1.0, "DHL", None, date(2025, 5, 5)), (4, "US", 1.0, "UPS", None, date(2026, 1, 1))],
        "package_id long, country_code string, dimension_weight double, carrier string, carrier_service string, trans_at_utc_package date",
    )
    volume = competitors.volumes(rows, [("2025", "2025-01-01", "2025-12-31")])
    got = sorted(tuple(r) for r in volume.select("country", "weight", "total", "DHL", "EMS", "UPS").collect())
    assert got == [("JP", 0.5, 1, 0, 0, 0), ("JP", 1.0, 1, 1, 1, 0)]
    grid = spark.createDataFrame([("JP", 1.04), ("JP", 2.0), ("US", 0.5), ("JP", None)], "country string, weight double")
    placed = sorted(tuple(r) for r in competitors.rate_volumes(grid, volume).select("country", "weight", "total").collect())
    assert placed == [("JP", 1.04, 1), ("JP", 2.0, 0)]
    assert competitors.volumes(rows, []).count() == 0
    # A day between two periods belongs to neither, and the countries can be chosen.
    apart = competitors.volumes(rows, [("early", "2025-01-01", "2025-04-30"), ("late", "2025-06-01", "2026-12-31")])
    assert sorted(map(tuple, apart.select("period", "country", "total").collect())) == [("early", "JP", 1), ("late", "JP", 1), ("late", "US", 1)]
    korea = competitors.volumes(rows, [("2025", "2025-01-01", "2025-12-31")], ["KR"])
    assert [tuple(r) for r in korea.select("country", "total").collect()] == [("KR", 1)]


# Published weekly figures: count and revenue of both categories, newest week first.
PUBLISHED = [
    ("2026-03-09", 2538, 201712647, 1558, 172026896),
    ("2026-03-02", 2393, 192162486, 1361, 135077247),
    ("2026-02-23", 2667, 217145897, 1588, 143586464),
    ("2026-02-16", 1913, 181888947, 910, 88451530),
    ("2026-02-09", 2224, 193194866, 1480, 146161172),
    ("2026-02-02", 2324, 226533885, 1529, 170221938),
]


@pytest.fixture(scope="module")
def series(spark):
    rows = [("purchase", "p", date.fromisoformat(d), n, Decimal(r)) for d, n, r, _, _ in PUBLISHED]
    rows += [("forwarding", "f", date.fromisoformat(d), n, Decimal(r)) for d, _, _, n, r in PUBLISHED]
    return spark.createDataFrame(rows, "category string, service string, week_start date, n long, revenue decimal(18,2)")


def test_published_averages_and_changes(series):
    trend = weekly.weekly_trend(weekly.total_series(series), ["scope"])
    r = trend.filter("week_start = '2026-03-09'").collect()[0]
    # The published average order value is cut off, not rounded.
    assert (r.n, r.n_avg4, int(r.revenue_avg4), int(r.aov_avg4)) == (4096, 3634, 324417152, 89272)
    assert (r.n_wow_pct, r.n_vs_avg4_pct, r.revenue_wow_pct, r.revenue_vs_avg4_pct) == (9.1, 12.7, 14.2, 15.2)
    assert (r.n_verdict, r.revenue_verdict) == ("good", "good")
    first = trend.filter("week_start = '2026-02-02'").collect()[0]
    assert first.n_wow_pct is None and first.n_avg4 is None and first.n_verdict is None


def test_published_category_changes(series):
    trend = weekly.weekly_trend(series, ["category", "service"])
    got = {r.category: r for r in trend.filter("week_start = '2026-03-09'").collect()}
    assert (got["purchase"].n_wow_pct, got["forwarding"].n_wow_pct) == (6.1, 14.5)
    assert (got["forwarding"].revenue_wow_pct, got["forwarding"].revenue_vs_avg4_pct, got["forwarding"].revenue_verdict) == (27.4, 34.1, "surge")
    assert round(got["purchase"].revenue_avg4) == 196098049


def test_published_contribution(spark):
    # One service rose by 23,729,693 of a total change of 46,499,810.
    rows = [("a", date(2026, 3, 2), Decimal(72013913)), ("a", date(2026, 3, 9), Decimal(95743606)),
            ("b", date(2026, 3, 2), Decimal(255225820)), ("b", date(2026, 3, 9), Decimal(277995937))]
    df = spark.createDataFrame(rows, "service string, week_start date, revenue decimal(18,2)")
    got = {r.service: r.contribution_pct for r in weekly.contributions(df, ["service"]).collect()}
    assert got == {"a": 51.0, "b": 49.0}


@pytest.mark.parametrize("wow,average,label", [(25, 0, "surge"), (5, 12, "good"), (-16.3, 0, "caution"), (-30.5, 0, "crisis"), (1, 1, "normal")])
def test_verdicts(spark, wow, average, label):
    sql = weekly.Verdicts().label(f"CAST({wow} AS DOUBLE)", f"CAST({average} AS DOUBLE)")
    assert spark.sql("SELECT 1").selectExpr(f"{sql} AS v").collect()[0].v == label


def test_new_and_missing_services(spark):
    monday = date(2026, 3, 2)
    rows = [("a", monday), ("b", monday), ("a", monday + timedelta(7)), ("c", monday + timedelta(7))]
    got = {(r.service, r.status) for r in weekly.service_changes(spark.createDataFrame(rows, "service string, week_start date")).collect()}
    assert got == {("b", "missing"), ("c", "new")}


# Published transitions 2023 to 2024: counts by from-state and to-state.
TRANSITIONS = {
    "Basic": [1099, 79, 13, 2, 0, 5],
    "Bronze": [126, 63, 27, 7, 0, 0],
    "Silver": [20, 14, 10, 9, 0, 0],
    "Gold": [7, 1, 11, 12, 1, 0],
    "VIP": [0, 0, 0, 2, 1, 0],
    "Not available": [105011, 116, 32, 10, 0, 0],
}


def test_published_tier_summary(spark):
    rows = [(2023, 2024, a, b, n) for a, ns in TRANSITIONS.items() for b, n in zip(tiers.TO_STATES, ns) if n]
    counts = spark.createDataFrame(rows, "from_period int, to_period int, from_state string, to_state string, customers long")
    r = tiers.summary(counts).collect()[0]
    assert (r["new"], r.lost, r.upgrade, r.downgrade, r.maintain) == (105169, 5, 138, 181, 1185)
    pct = {(x.from_state, x.to_state): x.row_pct for x in tiers.full_grid(counts).collect()}
    assert len(pct) == 36
    assert (pct["Basic", "Basic"], pct["Gold", "VIP"], pct["VIP", "Gold"], pct["Not available", "VIP"]) == (91.74, 3.12, 66.67, 0.0)
    matrix = {x.from_state: [x[s] for s in tiers.TO_STATES] for x in tiers.matrix(tiers.full_grid(counts)).collect()}
    assert matrix == TRANSITIONS


def test_transitions_from_customer_tiers(spark):
    rows = [(1, 2023, 10), (1, 2024, 60), (2, 2023, 70), (3, 2024, 5), (4, 2025, 5)]
    assigned = tiers.assign_tiers(spark.createDataFrame(rows, "customer_id long, period int, total_amount long"),
                                  {"Bronze": 20, "Silver": 30, "Gold": 40, "VIP": 50})
    got = {(r.from_period, r.to_period, r.from_state, r.to_state): r.customers
           for r in tiers.transitions(assigned, [(2023, 2024), (2024, 2025)]).collect()}
    assert got == {
        (2023, 2024, "Basic", "VIP"): 1, (2023, 2024, "VIP", "No activity"): 1, (2023, 2024, "Not available", "Basic"): 1,
        (2024, 2025, "VIP", "No activity"): 1, (2024, 2025, "Basic", "No activity"): 1, (2024, 2025, "Not available", "Basic"): 1,
    }
