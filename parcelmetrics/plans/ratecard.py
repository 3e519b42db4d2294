"""The competitor rate card as the nested document it is published as.

A document is a frame of countries: (country, card), the card a map from field name to VARIANT, so that fields which this
library does not know, in the country, a row, a column or a volume, come through every update as they were. An update is
an upsert: known fields are set in place, new ones are added at the end. Lists hold the carriers, weights and platforms of
one country, so their length is that of the printed card; figures are joined by country only after they are cut to it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelmetrics.functions.labels import CARRIER_KEYS, quoted
from parcelmetrics.operators.columns import add_columns
from parcelmetrics.plans.competitors import CLASSES, EXCLUDED_COUNTRY, EXPRESS_CARRIERS, STANDARD_CARRIERS, Platforms, gap_percent

FIELDS = "MAP<STRING, VARIANT>"
FEES = "MAP<STRING, MAP<STRING, VARIANT>>"
WEIGHT = "DECIMAL(6,1)"
FIGURES = ["total", *CARRIER_KEYS]
#: Name of a volume field, before its period.
VOLUME_PREFIX = "dk_volume_"


def read_card(spark: SparkSession, path: str) -> DataFrame:
    """Countries of a published document, ``{"data": {country: {...}}}``."""
    text = spark.read.text(path, wholetext=True)
    countries = text.selectExpr(f"EXPLODE(CAST(variant_get(parse_json(value), '$.data') AS {FIELDS})) AS (country, card)")
    return countries.selectExpr("country", f"CAST(card AS {FIELDS}) AS card")


def from_long(card: DataFrame, row_fields: dict[str, str] | None = None) -> DataFrame:
    """A document of long rate rows (country, weight, carrier, platform, fee); ``row_fields`` are further fields of a row.

    Its columns name the platforms that have a fee of a carrier anywhere in the country.
    """
    by_carrier = card.groupBy("country", "weight", "carrier").agg(F.array_sort(F.collect_list(F.struct("platform", "fee"))).alias("fees"))
    fees = "map_from_entries(transform(_fees, x -> named_struct('k', x.carrier, 'v', map_from_entries(transform(x.fees, f -> named_struct('k', f.platform, 'v', CAST(f.fee AS VARIANT)))))))"
    rows = by_carrier.groupBy("country", "weight").agg(F.array_sort(F.collect_list(F.struct("carrier", "fees"))).alias("_fees"))
    fields = {"weight": "CAST(weight AS VARIANT)", "fees": f"to_variant_object({fees})", **(row_fields or {})}
    made = ", ".join(f"'{name}', {sql}" for name, sql in fields.items())
    rows = rows.selectExpr("country", "weight", f"map_filter(map({made}), (k, v) -> v IS NOT NULL) AS row")
    # The weight is only the order of the list; a VARIANT has none.
    listed = rows.groupBy("country").agg(F.collect_list(F.struct("weight", "row")).alias("rows"))
    by_weight = "CASE WHEN a.weight < b.weight THEN -1 WHEN a.weight > b.weight THEN 1 ELSE 0 END"
    listed = listed.selectExpr("country", f"transform(array_sort(rows, (a, b) -> {by_weight}), x -> x.row) AS rows")
    platforms = card.groupBy("country", "carrier").agg(F.array_sort(F.collect_set("platform")).alias("platforms"))
    columns = platforms.groupBy("country").agg(F.array_sort(F.collect_list(F.struct("carrier", "platforms"))).alias("columns"))
    return listed.join(columns, "country").selectExpr("country", "map('columns', to_variant_object(columns), 'rows', to_variant_object(rows)) AS card")


def as_document(countries: DataFrame) -> DataFrame:
    """The published document, one row of text: a card is as long as it is printed."""
    entries = F.map_from_entries(F.sort_array(F.collect_list(F.struct("country", F.to_json("card").alias("card")))))
    one = countries.agg(entries.alias("entries"))
    return one.select(F.to_json(F.struct(F.transform_values("entries", lambda _, card: F.parse_json(card)).alias("data"))).alias("value"))


def write_card(countries: DataFrame, path: str) -> None:
    as_document(countries).write.text(path)


def upserted(old: str, new: str) -> str:
    """Fields of ``old`` with those of ``new`` in their place or at the end."""
    kept = f"transform_values({old}, (k, v) -> COALESCE({new}[k], v))"
    return f"map_concat({kept}, map_filter({new}, (k, v) -> NOT map_contains_key({old}, k)))"


def _opened(countries: DataFrame) -> DataFrame:
    """Rows and columns as lists of fields, the weights of the rows beside them."""
    return add_columns(
        countries,
        {
            "_rows": f"COALESCE(CAST(card['rows'] AS ARRAY<{FIELDS}>), ARRAY())",
            "_columns": f"CAST(card['columns'] AS ARRAY<{FIELDS}>)",
        },
    ).withColumn("_weights", F.expr(f"transform(_rows, r -> CAST(BROUND(try_variant_get(r['weight'], '$', 'double'), 1) AS {WEIGHT}))"))


def _closed(opened: DataFrame) -> DataFrame:
    """Rows and columns put back on the card, where it had them."""
    back = {"rows": "_rows", "columns": "_columns"}
    fields = [f"IF(map_contains_key(card, '{name}'), map('{name}', to_variant_object({c})), map())" for name, c in back.items()]
    return opened.selectExpr("country", f"{upserted('card', f'map_concat({', '.join(fields)})')} AS card")


def card_points(countries: DataFrame) -> DataFrame:
    """(country, weight) of the printed rows, weights to 0.1 kg."""
    points = _opened(countries).selectExpr("country", "EXPLODE(_weights) AS weight")
    return points.filter("weight IS NOT NULL").distinct()


def with_volumes(countries: DataFrame, volume: DataFrame, prefix: str = VOLUME_PREFIX) -> DataFrame:
    """Put own volumes (period, country, weight, total, one per carrier) on the rows, a field for each period.

    A country with shipments in a period gets figures on every row that has a weight, zeros where it shipped none of that
    weight; a country or period without any stays as it is. Fields of a volume that are not figures stay.
    """
    figures = "map(" + ", ".join(f"'{c}', CAST(CAST(`{c}` AS BIGINT) AS VARIANT)" for c in FIGURES) + ")"
    zeros = "map(" + ", ".join(f"'{c}', CAST(CAST(0 AS BIGINT) AS VARIANT)" for c in FIGURES) + ")"
    active = volume.groupBy("country").agg(F.array_sort(F.collect_set("period")).alias("_periods"))
    points = card_points(countries)
    printed = volume.withColumn("weight", F.expr(f"CAST(weight AS {WEIGHT})")).join(points, ["country", "weight"], "left_semi")
    entry = F.expr(f"STRUCT(STRUCT(period, weight) AS point, {figures} AS figures)")
    shipped = printed.groupBy("country").agg(F.map_from_entries(F.collect_list(entry)).alias("_shipped"))
    joined = _opened(countries).join(active.join(shipped, "country", "left"), "country", "left")
    old = f"r[CONCAT('{prefix}', p)]"
    old = f"IF(COALESCE(schema_of_variant({old}), '') LIKE 'OBJECT%', try_cast({old} AS {FIELDS}), map())"
    new = f"COALESCE(_shipped[named_struct('period', p, 'weight', w)], {zeros})"
    fields = f"map_from_arrays(transform(_periods, p -> CONCAT('{prefix}', p)), transform(_periods, p -> to_variant_object({upserted(old, new)})))"
    rows = f"zip_with(_rows, _weights, (r, w) -> IF(w IS NULL OR _periods IS NULL, r, {upserted('r', fields)}))"
    return _closed(add_columns(joined, {"_rows": rows}))


def _priced(fees: str) -> str:
    """Positive fees of a row as (fee, carrier, platform)."""
    of = "transform(map_entries(c.value), p -> named_struct('fee', try_variant_get(p.value, '$', 'bigint'), 'carrier', c.key, 'platform', p.key))"
    return f"filter(flatten(transform(map_entries({fees}), c -> {of})), e -> e.fee > 0)"


def _gap_fields(priced: str, platforms: Platforms) -> str:
    """Gap fields of the classes in which both sides have a fee."""
    maps = []
    for name, carriers in zip(CLASSES, (STANDARD_CARRIERS, EXPRESS_CARRIERS)):
        here = f"e.carrier IN ({quoted(carriers)})"
        own = f"array_min(transform(filter({priced}, e -> {here} AND e.platform IN ({quoted(list(platforms.own))})), e -> named_struct('fee', e.fee, 'carrier', e.carrier)))"
        other = f"array_min(transform(filter({priced}, e -> {here} AND e.platform IN ({quoted(list(platforms.competitors))})), e -> e.fee))"
        fields = {
            f"gap_{name}_pct": gap_percent("s.own.fee", "s.other"),
            f"{name}_cheapest_fee": "s.own.fee",
            f"{name}_cheapest_carrier": "s.own.carrier",
            f"competitor_{name}_min": "s.other",
        }
        made = ", ".join(f"'{field}', CAST({sql} AS VARIANT)" for field, sql in fields.items())
        sides = f"filter(ARRAY(named_struct('own', {own}, 'other', {other})), s -> s.own IS NOT NULL AND s.other IS NOT NULL)"
        maps.append(f"COALESCE(get(transform({sides}, s -> map({made})), 0), map())")
    return f"map_concat({', '.join(maps)})"


def with_tariff(countries: DataFrame, tariff: DataFrame, platforms: Platforms, excluded: Sequence[str] = (EXCLUDED_COUNTRY,)) -> DataFrame:
    """Put a tariff (country, weight, carrier, platform, fee) on the card and refresh the gaps of its countries.

    A fee goes to the printed row of its weight, whether or not the row has the carrier; a carrier's printed column gets the
    platform. Gap fields are set where both sides have a fee and stay as they were elsewhere. Countries without a
    tariff, and ``excluded`` ones, stay as they are.
    """
    tariff = tariff.filter(~F.col("country").isin(list(excluded))).withColumn("weight", F.expr(f"CAST(weight AS {WEIGHT})"))
    by_carrier = tariff.groupBy("country", "weight", "carrier").agg(
        F.expr("map_from_entries(array_sort(collect_list(STRUCT(platform, fee)))) AS fees")
    )
    by_weight = by_carrier.groupBy("country", "weight").agg(
        F.expr("map_from_entries(array_sort(collect_list(STRUCT(carrier, map_entries(fees) AS fees)))) AS fees")
    )
    # Only printed weights have a place; the others are left out before anything is collected by country.
    printed = by_weight.join(card_points(countries), ["country", "weight"], "left_semi")
    fees = printed.groupBy("country").agg(F.expr("map_from_entries(collect_list(STRUCT(weight, fees))) AS _tariff"))
    columns = tariff.select("country", "carrier", "platform").distinct().groupBy("country", "carrier")
    columns = columns.agg(F.array_sort(F.collect_list("platform")).alias("platforms"))
    columns = columns.groupBy("country").agg(F.expr("map_from_entries(collect_list(STRUCT(carrier, platforms))) AS _delivers"))
    joined = _opened(countries).join(columns.join(fees, "country", "left"), "country", "left")

    listed = "CAST(c['platforms'] AS ARRAY<STRING>)"
    delivered = "_delivers[try_variant_get(c['carrier'], '$', 'string')]"
    column = upserted("c", f"map('platforms', CAST(array_union(COALESCE({listed}, ARRAY()), {delivered}) AS VARIANT))")
    opened = add_columns(
        joined,
        {
            "_columns": f"IF(_delivers IS NULL, _columns, transform(_columns, c -> IF({delivered} IS NULL, c, {column})))",
            "_fees": f"transform(_rows, r -> COALESCE(CAST(r['fees'] AS {FEES}), map()))",
            "_new": "transform(_weights, w -> transform_values(COALESCE(_tariff[w], map()), (k, v) -> transform_values(map_from_entries(v), (p, f) -> CAST(f AS VARIANT))))",
        },
    )
    merged = f"zip_with(_fees, _new, (a, b) -> {_merged_fees('a', 'b')})"
    opened = add_columns(opened, {"_fees": merged})
    opened = add_columns(opened, {"_priced": f"transform(_fees, f -> {_priced('f')})"})
    opened = add_columns(opened, {"_gaps": f"transform(_priced, x -> {_gap_fields('x', platforms)})"})
    fields = "zip_with(_fees, _gaps, (f, g) -> map_concat(map('fees', to_variant_object(f)), g))"
    opened = add_columns(opened, {"_fields": fields})
    rows = f"IF(_delivers IS NULL, _rows, zip_with(_rows, _fields, (r, n) -> {upserted('r', 'n')}))"
    return _closed(add_columns(opened, {"_rows": rows}))


def _merged_fees(old: str, new: str) -> str:
    """Fees by carrier and platform with new ones set or added; carriers and platforms keep their order."""
    inner = f"map_concat(transform_values(v, (p, f) -> COALESCE({new}[k][p], f)), map_filter({new}[k], (p, f) -> NOT map_contains_key(v, p)))"
    kept = f"transform_values({old}, (k, v) -> IF({new}[k] IS NULL, v, {inner}))"
    return f"map_concat({kept}, map_filter({new}, (k, v) -> NOT map_contains_key({old}, k)))"


def card_rows(countries: DataFrame) -> DataFrame:
    """(country, columns, row): a row of the document each, its fields a map, the columns as text ``carrier=platforms;...``."""
    opened = _opened(countries)
    column = "CONCAT(try_variant_get(c['carrier'], '$', 'string'), '=', array_join(CAST(c['platforms'] AS ARRAY<STRING>), ','))"
    return opened.selectExpr("country", f"array_join(transform(_columns, c -> {column}), ';') AS columns", "EXPLODE(_rows) AS row")
