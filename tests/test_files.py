"""Sources and sinks on temporary files."""

from __future__ import annotations

import json
from pathlib import Path

from parcelmetrics.plans import competitors, dashboard, ratecard
from parcelmetrics.sources.files import card_columns, csv_layout, long_card, nest_card, read_rate_card, read_tariff_csv, write_json
from parcelmetrics.sources.sample import SAMPLE_OPTIONS, SampleViews, sample_tables
from parcelmetrics.sources.schemas import SCHEMAS
from parcelmetrics.sources.warehouse import decimals_to_double, read_tables


def lines(path: Path) -> list[dict]:
    return [json.loads(x) for f in sorted(path.glob("part-*")) for x in f.read_text().splitlines()]


def test_tariff_csv(spark, tmp_path):
    file = tmp_path / "tariff.csv"
    file.write_text(
        'Platform,Country,Carrier,Weight (kg),Fee\n Rival C ,JP,EMS ,0.5,"12,345.9"\nRival C,US,EMS,0.5,1\n'
        'Rival C,JP,EMS,10.5,1\nRival C,JP,DHL,1,n/a\nOther,JP,EMS,0.5,7\nRival C,JP,EMS,1,5\nRival C,JP,EMS,1,6\n'
    )
    got = competitors.parse_tariff(read_tariff_csv(spark, str(file)), "Rival C", "rival_c")
    # The last row of a repeated key counts, fractions are cut off, bad fees are NULL.
    assert sorted(tuple(r) for r in got.collect()) == [
        ("JP", 0.5, "EMS", "rival_c", 12345), ("JP", 1.0, "DHL", "rival_c", None), ("JP", 1.0, "EMS", "rival_c", 6)
    ]


def test_tariff_csv_encoding(spark, tmp_path):
    file = tmp_path / "tariff.csv"
    file.write_bytes("Platform,Country,Carrier,Weight (kg),Fee\n배송,JP,EMS,0.5,1\n".encode("euc-kr"))
    # Charsets beyond Spark's short list need its switch for Java charsets.
    spark.conf.set("spark.sql.legacy.javaCharsets", "true")
    try:
        got = competitors.parse_tariff(read_tariff_csv(spark, str(file), encoding="EUC-KR"), "배송", "p")
        assert got.count() == 1
    finally:
        spark.conf.unset("spark.sql.legacy.javaCharsets")


DOCUMENT = {
    "data": {
        "JP": {
            "columns": [{"carrier": "DHL", "platforms": ["own"]}, {"carrier": "EMS", "platforms": ["own", "rival"]}],
            "rows": [
                {"weight": 0.5, "fees": {"DHL": {"own": 10}, "EMS": {"own": 20, "rival": 15}}},
                {"weight": 1.0, "fees": {"EMS": {"own": 30}}},
            ],
        },
        "FR": {"columns": [{"carrier": "EMS", "platforms": ["own"]}], "rows": [{"weight": 0.5, "fees": {"EMS": {"own": 40}}}]},
    }
}


def test_rate_card_round_trip(spark, tmp_path):
    file = tmp_path / "card.json"
    file.write_text(json.dumps(DOCUMENT, indent=1))
    countries = read_rate_card(spark, str(file))
    card = long_card(countries)
    assert card.count() == 5
    extras = competitors.rate_gaps(card, competitors.Platforms(["own"], ["rival"]))
    write_json(nest_card(card, card_columns(countries), extras), str(tmp_path / "out"))
    back = {r["country"]: r for r in lines(tmp_path / "out")}
    assert back["JP"]["columns"] == DOCUMENT["data"]["JP"]["columns"]
    first = back["JP"]["rows"][0]
    assert first["fees"] == DOCUMENT["data"]["JP"]["rows"][0]["fees"]
    # The cheapest own express fee is 10, the competitor's 15.
    assert (first["gap_express_pct"], first["express_cheapest_carrier"]) == (-33.3, "DHL")
    assert [r["weight"] for r in back["JP"]["rows"]] == [0.5, 1.0]


def test_merge_platforms(spark):
    columns = spark.createDataFrame([("JP", "EMS", ["own"]), ("JP", "DHL", ["own", "new"])], "country string, carrier string, platforms array<string>")
    tariff = spark.createDataFrame([("JP", 0.5, "EMS", "new", 1), ("JP", 0.5, "DHL", "new", 1), ("JP", 0.5, "UPS", "new", 1)],
                                   "country string, weight double, carrier string, platform string, fee long")
    got = {r.carrier: r.platforms for r in competitors.merge_platforms(columns, tariff).collect()}
    assert got == {"EMS": ["own", "new"], "DHL": ["own", "new"]}


def test_csv_layout_moves_revenue():
    assert csv_layout(["a", "revenue_krw", "reference_type", "b", "revenue_usd"]) == ["a", "reference_type", "revenue_krw", "revenue_usd", "b"]
    assert csv_layout(["a", "revenue_krw"]) == ["a", "revenue_krw"]


def test_tables_round_trip_with_declared_schemas(spark, tmp_path):
    views = SampleViews(spark, "/root/testdata/sf0.001")
    for name, schema in SCHEMAS.items():
        assert [(f.name, f.dataType) for f in views[name].schema] == [(f.name, f.dataType) for f in schema]
        views[name].write.parquet(str(tmp_path / f"{name}.parquet"))
    assert read_tables(spark, str(tmp_path))["package"].count() == views["package"].count()


def test_refresh_writes_every_section(spark, tmp_path):
    tables = sample_tables(spark, "/root/testdata/sf0.001")
    card = ratecard.from_long(SampleViews(spark, "/root/testdata/sf0.001")["rate_card"], {"note": "CAST('kept' AS VARIANT)"})
    dashboard.refresh(spark, tables, str(tmp_path), SAMPLE_OPTIONS, card, [("1998", "1998-01-01", "1998-12-31")], "2026-03-20 01:30:00")
    sections = {p.name for p in (tmp_path / "dashboard").iterdir()}
    assert len(sections) == 14
    kpis = lines(tmp_path / "dashboard" / "kpis")[0]
    assert kpis["last_updated"] == "2026-03-20 10:30 KST" and isinstance(kpis["total_revenue"], int)
    assert len(lines(tmp_path / "dashboard" / "vvip_list")) == 50
    suite = lines(tmp_path / "dashboard" / "all_suites")[0]
    assert {"case_stats", "country_counts", "weight_bins_actual", "percentile"} <= set(suite)
    assert sum(r["total_revenue"] for r in lines(tmp_path / "dashboard" / "all_suites")) == kpis["total_revenue"]
    assert {p.name for p in (tmp_path / "csv").iterdir()} == {f"case_{i}_raw" for i in range(1, 6)}
    header = next((tmp_path / "csv" / "case_4_raw").glob("part-00000*")).read_text().splitlines()[0].split(",")
    assert header[header.index("reference_type") + 1 :][:2] == ["revenue_krw", "revenue_usd"]
    (document,) = lines(tmp_path / "rate_card")
    row = next(iter(document["data"].values()))["rows"][0]
    assert {"weight", "fees", "note", "dk_volume_1998"} <= set(row) and set(row["dk_volume_1998"]) == set(ratecard.FIGURES)


def test_decimals_become_doubles(spark):
    df = spark.sql("SELECT CAST(1.5 AS DECIMAL(5,2)) AS a, 'x' AS b, CAST(NULL AS DECIMAL(5,2)) AS c")
    assert [t for _, t in decimals_to_double(df).dtypes] == ["double", "string", "double"]
