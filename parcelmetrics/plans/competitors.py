"""Competitor rate cards: tariff merge, price gaps and own shipping volumes.

A rate card is kept in long form, one row per country, weight, carrier and platform. Which
platforms are one's own and which compete is for the caller to say.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelmetrics.functions.labels import CARRIER_KEYS, VOLUME_COUNTRIES, carrier_key, quoted, weight_group

# Carriers of the two classes compared. Sea and minimum rows have no class.
STANDARD_CARRIERS = ["k-packet"]
EXPRESS_CARRIERS = ["DHL", "EMS", "FEDEX", "UPS"]
CLASSES = ["standard", "express"]

# Tariffs leave this country out and stop at this weight in kilograms.
EXCLUDED_COUNTRY = "US"
MAX_TARIFF_KG = 10

GRID = ["country", "weight"]
RATE_KEY = [*GRID, "carrier", "platform"]


@dataclass(frozen=True)
class Platforms:
    own: Sequence[str]
    competitors: Sequence[str]


def carrier_class(carrier: str = "carrier") -> str:
    return (
        f"CASE WHEN {carrier} IN ({quoted(STANDARD_CARRIERS)}) THEN 'standard'"
        f" WHEN {carrier} IN ({quoted(EXPRESS_CARRIERS)}) THEN 'express' END"
    )


def gap_percent(own: str, other: str) -> str:
    """Price difference in percent of the other price, one decimal, ties to even."""
    exact = f"CAST({own} - {other} AS DECIMAL(18,0)) * 100 / CAST({other} AS DECIMAL(18,0))"
    return f"CAST(BROUND({exact}, 1) AS DOUBLE)"


def rate_gaps(card: DataFrame, platforms: Platforms) -> DataFrame:
    """Cheapest own fee against the cheapest competitor, per country, weight and class.

    One conditional aggregate per side; the carrier name breaks a tie between own fees.
    Fields are set only where both sides have a fee.
    """
    priced = card.filter("fee > 0").withColumn("class", F.expr(carrier_class())).filter("class IS NOT NULL")
    own, others = f"platform IN ({quoted(list(platforms.own))})", f"platform IN ({quoted(list(platforms.competitors))})"
    aggregates = []
    for c in CLASSES:
        here = f"class = '{c}'"
        aggregates += [
            F.expr(f"MIN(CASE WHEN {here} AND {own} THEN struct(fee, carrier) END) AS _own_{c}"),
            F.expr(f"MIN(CASE WHEN {here} AND {others} THEN fee END) AS _other_{c}"),
        ]
    mins = priced.groupBy(*GRID).agg(*aggregates)
    out = [*GRID]
    for c in CLASSES:
        both = f"_own_{c} IS NOT NULL AND _other_{c} IS NOT NULL"
        fields = {
            f"gap_{c}_pct": gap_percent(f"_own_{c}.fee", f"_other_{c}"),
            f"{c}_cheapest_fee": f"_own_{c}.fee",
            f"{c}_cheapest_carrier": f"_own_{c}.carrier",
            f"competitor_{c}_min": f"_other_{c}",
        }
        out += [f"CASE WHEN {both} THEN {sql} END AS {name}" for name, sql in fields.items()]
    return mins.selectExpr(*out)


def refresh_gaps(rows: DataFrame, gaps: DataFrame, countries: DataFrame | None = None) -> DataFrame:
    """Gap fields of the card rows: recomputed where possible, else what was there before.

    With ``countries`` (a column country), as those of a tariff, rows of other countries stay as they are.
    """
    names = [c for c in gaps.columns if c not in GRID]
    if countries is not None:
        gaps = gaps.join(countries.select("country").distinct(), "country", "left_semi")
    new = gaps.select(*GRID, *[F.col(c).alias(f"_new_{c}") for c in names])
    joined = rows.join(new, GRID, "left")
    kept = [c for c in rows.columns if c not in names]
    return joined.select(*kept, *[F.coalesce(f"_new_{c}", c if c in rows.columns else F.lit(None)).alias(c) for c in names])


# Tariffs -------------------------------------------------------------------------------


def parse_tariff(
    text: DataFrame,
    label: str,
    platform: str,
    row_order: str = "row_order",
    max_kg: float = MAX_TARIFF_KG,
    excluded: Sequence[str] = (EXCLUDED_COUNTRY,),
) -> DataFrame:
    """One platform's tariff as long rate rows from the text columns of a tariff file.

    Thousands separators go and the fraction is cut off. Of several rows for one country,
    carrier and weight the last in file order counts.
    """
    clean = text.selectExpr(
        "TRIM(Platform) AS _platform",
        "TRIM(Country) AS country",
        "TRIM(Carrier) AS carrier",
        "try_cast(TRIM(`Weight (kg)`) AS DOUBLE) AS weight",
        "CAST(try_cast(TRIM(REPLACE(Fee, ',', '')) AS DOUBLE) AS BIGINT) AS fee",
        f"`{row_order}` AS _order",
    )
    wanted = (F.col("_platform") == label) & ~F.col("country").isin(list(excluded)) & (F.col("weight") <= max_kg)
    return (
        clean.filter(wanted)
        .groupBy("country", "weight", "carrier")
        .agg(F.max_by("fee", "_order").alias("fee"))
        .select("country", "weight", "carrier", F.lit(platform).alias("platform"), "fee")
    )


def merge_tariff(card: DataFrame, tariff: DataFrame) -> DataFrame:
    """Insert or replace the tariff's fees on grid points the card already has."""
    card = card.withColumn("weight", F.bround("weight", 1))
    grid = card.select("country", "weight").distinct()
    new = tariff.join(grid, GRID, "left_semi").select(*RATE_KEY, "fee")
    kept = card.join(new.select(*RATE_KEY), RATE_KEY, "left_anti").select(*RATE_KEY, "fee")
    return kept.unionByName(new)


def merge_platforms(columns: DataFrame, tariff: DataFrame) -> DataFrame:
    """Platform list per country and carrier, with the tariff's platform where it delivers.

    ``columns`` has country, carrier and a platforms array; carriers it lacks are not added.
    """
    added = tariff.groupBy("country", "carrier").agg(F.array_sort(F.collect_set("platform")).alias("_added"))
    merged = F.array_union("platforms", F.coalesce("_added", F.array().cast("array<string>")))
    return columns.join(added, ["country", "carrier"], "left").select("country", "carrier", merged.alias("platforms"))


def platform_columns(card: DataFrame) -> DataFrame:
    """Platforms with a fee per country and carrier, sorted."""
    return card.groupBy("country", "carrier").agg(F.array_sort(F.collect_set("platform")).alias("platforms"))


# Volumes -------------------------------------------------------------------------------


def shipments(cases: Mapping[int, DataFrame] | DataFrame) -> DataFrame:
    """Columns the volumes need, from all case rows: child rows count here as well."""
    columns = ["package_id", "country_code", "dimension_weight", "carrier", "carrier_service", "trans_at_utc_package"]
    frames = [cases] if isinstance(cases, DataFrame) else list(cases.values())
    rows = frames[0].select(*columns)
    for frame in frames[1:]:
        rows = rows.unionByName(frame.select(*columns))
    return rows


def _in_countries(rows: DataFrame, countries: Sequence[str]) -> DataFrame:
    return rows.filter(F.col("country_code").isin(list(countries)))


def volumes(
    rows: DataFrame, periods: Sequence[tuple[str, str, str]], countries: Sequence[str] = VOLUME_COUNTRIES
) -> DataFrame:
    """Distinct packages per period, country and weight group: in total and per carrier.

    ``periods`` are (label, first day, last day), both days included; rows outside all of
    them are left out before the periods are dealt out. Packages are first
    reduced to one row of carrier flags each, so the distinct counts are plain sums and a
    busy weight group is spread over its packages. Carriers without a column count in the
    total only.
    """
    labels = ", ".join(
        f"CASE WHEN trans_at_utc_package BETWEEN DATE '{a}' AND DATE '{b}' THEN '{label}' END" for label, a, b in periods
    )
    rows = _in_countries(rows, countries)
    if periods:
        first, last = min(a for _, a, _ in periods), max(b for _, _, b in periods)
        rows = rows.filter(f"trans_at_utc_package BETWEEN DATE '{first}' AND DATE '{last}'")
    tagged = rows.selectExpr(
        "package_id",
        "country_code AS country",
        f"{weight_group('dimension_weight')} AS weight",
        f"{carrier_key()} AS carrier_key",
        f"explode(array_compact(array({labels}))) AS period",
    )
    keys = ["period", "country", "weight"]
    per_package = tagged.groupBy(*keys, "package_id").agg(
        *[F.expr(f"MAX(CASE WHEN carrier_key = '{k}' THEN 1 ELSE 0 END) AS `{k}`") for k in CARRIER_KEYS]
    )
    return per_package.groupBy(*keys).agg(
        F.count("package_id").alias("total"), *[F.sum(f"`{k}`").alias(k) for k in CARRIER_KEYS]
    )


def carrier_diagnostics(rows: DataFrame, countries: Sequence[str] = VOLUME_COUNTRIES) -> DataFrame:
    """Carrier names seen, and whether a name occurs on rows without a carrier column."""
    return (
        _in_countries(rows, countries)
        .filter("carrier IS NOT NULL")
        .groupBy("carrier")
        .agg(F.expr(f"BOOL_OR({carrier_key()} = 'other') AS unmatched"))
    )


def rate_volumes(grid: DataFrame, volume: DataFrame) -> DataFrame:
    """Volumes on the grid points of a rate card (country, weight), per period.

    A weight without shipments gets zeros where the country has any in the period; a country
    without any is left out, its earlier figures stay as they are.
    """
    points = grid.filter("weight IS NOT NULL").select("country", "weight").distinct()
    active = volume.select("period", "country").distinct()
    figures = ["total", *CARRIER_KEYS]
    v = volume.select("period", "country", F.col("weight").alias("_group"), *figures)
    on = ["period", "country", "_group"]
    return (
        points.join(active, "country")
        .withColumn("_group", F.bround("weight", 1))
        .join(v, on, "left")
        .select("period", "country", "weight", *[F.coalesce(f, F.lit(0)).alias(f) for f in figures])
    )
