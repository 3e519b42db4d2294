"""The dashboard refresh: case table, CSV export, the fourteen sections, volumes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelmetrics.operators.columns import add_columns
from parcelmetrics.plans import competitors, ratecard, rollups
from parcelmetrics.plans.cases import CaseOptions, CaseQueries, case_table
from parcelmetrics.sources.files import export_cases_csv, write_sections
from parcelmetrics.sources.warehouse import Tables

# Years in which own volumes are put on the rate card.
VOLUME_PERIODS = [("2025", "2025-01-01", "2025-12-31"), ("2026", "2026-01-01", "2026-12-31")]


def sections(combined: DataFrame, suites: DataFrame, by_year: DataFrame, updated_at_utc: str | None = None) -> dict[str, DataFrame]:
    """Every section of the dashboard document as its own small frame.

    ``suites`` and ``by_year`` are the suite rows, which several sections and passes read.
    """
    no_admin = rollups.without_admins(combined)
    totals = suites.drop(*rollups.NESTED)
    profiles = rollups.with_percentiles(suites, [])
    return {
        "kpis": rollups.kpis(combined, updated_at_utc),
        "pkg_stats": rollups.package_statistics(combined),
        "pkg_stats_no_admin": rollups.package_statistics(no_admin),
        "case_summary": rollups.case_summary(combined),
        "case_summary_no_admin": rollups.case_summary(no_admin),
        "suite_stats": rollups.suite_statistics(totals),
        "revenue_split": rollups.revenue_split(combined),
        "case_revenue_splits": rollups.revenue_split(combined, by_case=True),
        "case_revenue_splits_no_admin": rollups.revenue_split(no_admin, by_case=True),
        "vvip_list": rollups.top_suites(profiles),
        "all_suites": profiles,
        "all_suites_by_year": rollups.with_percentiles(by_year, ["ship_year"]),
        "available_years": rollups.available_years(combined),
        "summary": rollups.concentration(totals),
    }


def refresh(
    spark: SparkSession,
    tables: Tables,
    folder: str,
    options: CaseOptions | None = None,
    rate_card: DataFrame | None = None,
    periods: list[tuple[str, str, str]] | None = None,
    updated_at_utc: str | None = None,
) -> None:
    """Write everything under ``folder``.

    The case table is written first, partitioned by case, then the suite rows; every later stage scans these. A
    lost executor costs a re-read of some files and never the joins. ``rate_card`` is a document (see ``plans.ratecard``),
    written back with the volumes on its rows.
    """
    folder = folder.rstrip("/")
    case_table(CaseQueries(tables, options)).write.partitionBy("profit_case").parquet(f"{folder}/case_rows")
    rows = spark.read.parquet(f"{folder}/case_rows")
    rows = add_columns(rows, {"profit_case": "CAST(profit_case AS STRING)"})
    by_case = {n: rows.filter(F.col("profit_case").isin(str(n), f"{n}_1")) for n in range(1, 6)}
    export_cases_csv(by_case, f"{folder}/csv")
    combined = rollups.combine_table(rows)
    suites = _written(rollups.suite_rows(combined), f"{folder}/suite_rows")
    by_year = _written(rollups.suite_rows(rollups.with_ship_year(combined), ["ship_year", *rollups.SUITE]), f"{folder}/suite_rows_by_year")
    write_sections(sections(combined, suites, by_year, updated_at_utc), f"{folder}/dashboard")
    if rate_card is not None:
        volume = competitors.volumes(competitors.shipments(rows), periods or VOLUME_PERIODS)
        ratecard.write_card(ratecard.with_volumes(rate_card, volume), f"{folder}/rate_card")


def _written(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
