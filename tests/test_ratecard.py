"""The nested rate card: what an update sets, and what it must leave alone."""

from __future__ import annotations

import json
from pathlib import Path

import pytest

from parcelmetrics.plans import ratecard
from parcelmetrics.plans.competitors import Platforms

DOCUMENT = {
    "data": {
        "JP": {
            "memo": {"by": "hand", "n": [1, 2]},
            "columns": [{"carrier": "DHL", "platforms": ["own"], "logo": "d.svg"}, {"carrier": "EMS", "platforms": ["own", "new"]}],
            "rows": [
                {"weight": 0.52, "fees": {"DHL": {"own": 100}, "EMS": {"own": 200, "rival": 150}}, "note": "a\"b", "dk_volume_2025": {"total": 9, "seen": True}},
                {"weight": 1.0, "fees": {"EMS": {"own": 300}}, "gap_express_pct": 77.7, "dk_volume_2025": 3},
                {"weight": None, "fees": {"EMS": {"own": 1}}, "tail": None},
            ],
        },
        "FR": {"rows": [{"weight": 0.5, "fees": {"k-packet": {"own": 50, "rival": 40}}, "gap_standard_pct": 1.25}], "columns": [{"carrier": "k-packet", "platforms": ["own"]}]},
        "US": {"columns": [{"carrier": "DHL", "platforms": []}], "rows": [{"weight": 0.5, "fees": {"DHL": {"own": 10, "rival": 5}}}]},
        "XX": {"only": "text"},
    }
}
PLATFORMS = Platforms(own=["own"], competitors=["rival", "new"])


@pytest.fixture
def card(spark, tmp_path):
    file = tmp_path / "card.json"
    file.write_text(json.dumps(DOCUMENT, indent=1))
    return ratecard.read_card(spark, str(file))


def written(df, tmp_path) -> dict:
    path = tmp_path / "out"
    ratecard.write_card(df, str(path))
    (part,) = [f for f in Path(path).glob("part-*") if f.stat().st_size]
    return json.loads(part.read_text())["data"]


def test_a_document_comes_back_as_it_was(card, tmp_path):
    assert written(card, tmp_path) == DOCUMENT["data"]


def test_volumes_go_to_the_rows_of_active_countries(spark, card, tmp_path):
    figures = "total long, DHL long, EMS long, FEDEX long, UPS long, kpacket long"
    volume = spark.createDataFrame(
        [("2025", "JP", 0.5, 4, 1, 2, 0, 0, 0), ("2025", "JP", 7.0, 8, 8, 0, 0, 0, 0), ("2026", "FR", 3.0, 1, 0, 0, 0, 0, 1)], f"period string, country string, weight double, {figures}"
    )
    got = written(ratecard.with_volumes(card, volume), tmp_path)
    first, second, third = got["JP"]["rows"]
    # 0.52 kg is the row of 0.5 kg; fields of a volume that are no figures stay.
    assert first["dk_volume_2025"] == {"total": 4, "seen": True, "DHL": 1, "EMS": 2, "FEDEX": 0, "UPS": 0, "kpacket": 0}
    assert list(first) == sorted(first) and first["note"] == 'a"b' and first["weight"] == 0.52
    # No shipments of that weight: zeros, and a value that is no object is replaced. No weight: untouched.
    assert second["dk_volume_2025"] == dict.fromkeys(["total", "DHL", "EMS", "FEDEX", "UPS", "kpacket"], 0)
    assert third == DOCUMENT["data"]["JP"]["rows"][2] and "dk_volume_2026" not in first
    # The country is active though none of its weights is printed.
    assert got["FR"]["rows"][0]["dk_volume_2026"]["total"] == 0 and "dk_volume_2025" not in got["FR"]["rows"][0]
    assert got["US"] == DOCUMENT["data"]["US"] and got["XX"] == DOCUMENT["data"]["XX"] and got["JP"]["memo"] == DOCUMENT["data"]["JP"]["memo"]


def test_a_tariff_sets_fees_platforms_and_gaps_of_its_countries_only(spark, card, tmp_path):
    tariff = spark.createDataFrame(
        [("JP", 0.5, "DHL", "new", 80), ("JP", 0.5, "UPS", "new", 70), ("JP", 2.0, "EMS", "new", 1), ("US", 0.5, "DHL", "new", 1), ("ZZ", 0.5, "DHL", "new", 1)],
        "country string, weight double, carrier string, platform string, fee long",
    )
    got = written(ratecard.with_tariff(card, tariff, PLATFORMS), tmp_path)
    first, second, third = got["JP"]["rows"]
    # A carrier that the row lacks is added, though no printed column names it.
    assert first["fees"] == {"DHL": {"own": 100, "new": 80}, "EMS": {"own": 200, "rival": 150}, "UPS": {"new": 70}}
    assert (first["express_cheapest_fee"], first["express_cheapest_carrier"], first["competitor_express_min"], first["gap_express_pct"]) == (100, "DHL", 70, 42.9)
    assert "gap_standard_pct" not in first and first["note"] == 'a"b' and first["dk_volume_2025"] == {"total": 9, "seen": True}
    # Without both sides an earlier gap stays.
    assert second["gap_express_pct"] == 77.7 and second["fees"] == {"EMS": {"own": 300}} and third["tail"] is None
    assert got["JP"]["columns"] == [{"carrier": "DHL", "platforms": ["own", "new"], "logo": "d.svg"}, {"carrier": "EMS", "platforms": ["own", "new"]}]
    # France has both fees, but no tariff: its gap is not refreshed. The excluded country stays.
    assert got["FR"] == DOCUMENT["data"]["FR"] and got["US"] == DOCUMENT["data"]["US"] and "ZZ" not in got
    all_in = written_again = ratecard.with_tariff(card, tariff, PLATFORMS, excluded=[])
    us = {r.country: json.loads(r.card) for r in written_again.selectExpr("country", "to_json(card) AS card").collect()}["US"]
    assert us["rows"][0]["fees"]["DHL"]["new"] == 1 and us["rows"][0]["gap_express_pct"] == 900.0 and all_in.count() == 4
