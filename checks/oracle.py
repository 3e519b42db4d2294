"""Checking SQL by query name."""

from __future__ import annotations

from checks import rollups as r
from checks.cases import case_sql
from checks.markets import market_checks


def oracle_sql() -> dict[str, str]:
    return {
        "single_package_profit": case_sql("case_1"),
        "single_purchase_profit": case_sql("case_2"),
        "combined_forwarding_parents": case_sql("case_3_parents"),
        "combined_forwarding_children": case_sql("case_3_children"),
        "combined_purchase_parents": case_sql("case_4_parents"),
        "combined_purchase_children": case_sql("case_4_children"),
        "mixed_package_parents": case_sql("case_5_parents"),
        "mixed_package_children": case_sql("case_5_children"),
        "combined_cases": r.combined_rows(),
        "kpi_block": r.kpi_block("2026-03-20 10:30 KST"),
        "package_statistics": r.package_statistics(True),
        "package_statistics_no_admin": r.package_statistics(False),
        "case_summary": r.case_summary(True),
        "case_summary_no_admin": r.case_summary(False),
        "suite_totals": r.suite_totals(),
        "suite_case_detail": r.suite_case_detail(),
        "suite_countries": r.suite_countries(),
        "weight_histogram": r.weight_histogram(),
        "suite_percentiles": r.suite_percentiles(),
        "suite_profiles": r.suite_profiles(False),
        "suite_profiles_by_year": r.suite_profiles(True),
        "available_years": r.available_years(),
        "suite_statistics": r.suite_statistics(),
        "suite_distribution": r.suite_distribution(),
        "page_kpis": r.page_kpis(True),
        "page_kpis_no_admin": r.page_kpis(False),
        "revenue_split": r.revenue_split(False),
        "case_revenue_split": r.revenue_split(True),
        "case_revenue_split_no_admin": r.revenue_split(True, False),
        "revenue_shares": r.split_shares(),
        "top_suites": r.top_suites(),
        "revenue_concentration": r.concentration(),
        "suite_search": r.suite_search("S11"),
        "page_amounts": r.page_amounts(),
        "older_results": r.older_results(),
        "exported_cases": r.exported_cases(),
        "dashboard_file": r.dashboard_file(),
        **market_checks(),
    }
