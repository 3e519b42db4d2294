"""Ranks and quantiles against brute force."""

from __future__ import annotations

import math
import random

import numpy as np
import pandas as pd
import pytest

from parcelmetrics.operators import ranking
from parcelmetrics.operators.ranking import describe, order_values, top_share, with_percentile_ranks

DICE = random.Random(2)
SAMPLES = {
    "ties": [0] * 50 + [1, 1, 2, 5],
    "one": [7],
    "money": [DICE.randrange(-(10**6), 10**7) for _ in range(301)],
    "half": [0] * 4000 + [DICE.randrange(1, 10**9) for _ in range(4000)],
    "levels": [k * 2**21 + d for k in (-3, -1, 0, 1, 7) for d in (-1, 0, 1)] + [2**42, 2**42 - 1, -(2**42), 2**50],
}


def wide(spark, samples):
    """A column for each sample, filled up with NULLs."""
    size = max(map(len, samples.values()))
    rows = [tuple(vs[k] if k < len(vs) else None for vs in samples.values()) for k in range(size)]
    DICE.shuffle(rows)
    return spark.createDataFrame(rows, ", ".join(f"{name} long" for name in samples)).repartition(5)


@pytest.fixture(params=[None, 500], ids=["wide brackets", "narrow brackets"])
def accuracy(request, monkeypatch):
    """Small tables fall back to the whole range; a coarse sketch makes brackets that hold, and some that don't."""
    if request.param:
        monkeypatch.setattr(ranking, "ACCURACY", request.param)
        monkeypatch.setattr(ranking, "MARGIN", 4 / request.param)


def test_describe_matches_pandas(spark, accuracy):
    got = {r.metric: r for r in describe(wide(spark, SAMPLES), {name: name for name in SAMPLES}).collect()}
    for name, vs in SAMPLES.items():
        d = pd.Series(vs).describe()
        assert got[name]["count"] == len(vs) and got[name]["sum"] == sum(vs)
        for ours, theirs in [("mean", "mean"), ("min", "min"), ("p25", "25%"), ("p50", "50%"), ("p75", "75%"), ("max", "max")]:
            assert got[name][ours] == pytest.approx(d[theirs], rel=1e-12)
        assert got[name]["std"] == pytest.approx(0 if math.isnan(d["std"]) else d["std"], rel=1e-6)


def test_describe_of_nothing_is_zero(spark):
    df = spark.createDataFrame([(None, 4), (None, None)], "empty long, some long")
    got = {r.metric: r.asDict() for r in describe(df, {"empty": "empty", "some": "some"}).collect()}
    assert {k: v for k, v in got["empty"].items() if k != "metric"} == dict.fromkeys(["count", "mean", "std", "min", "p25", "p50", "p75", "max", "sum"], 0)
    assert got["some"]["mean"] == 4 and got["some"]["p25"] == 4
    assert {r["count"] for r in describe(df.limit(0), {"some": "some"}).collect()} == {0}


def test_only_values_in_brackets_are_counted(spark, monkeypatch):
    monkeypatch.setattr(ranking, "ACCURACY", 1000)
    monkeypatch.setattr(ranking, "MARGIN", 4 / 1000)
    df = spark.range(0, 200_000, 1, 4).selectExpr("id * 7919 % 200003 AS v")
    got = order_values(df, {"v": "v"}, ranking.quantile_picks({"p50": 0.5}))
    ordered = sorted(k * 7919 % 200003 for k in range(200_000))
    assert tuple(got.collect()[0]) == ("v", ordered[99_999], ordered[100_000])
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "stack" not in plan and "Expand" not in plan
    # A hundredth of the distinct values goes through the shuffle of the counts.
    counted = df.where(f"v BETWEEN {ordered[98_000]} AND {ordered[102_000]}").count()
    assert counted < 5_000


def test_percentile_ranks_match_pandas(spark):
    rng = random.Random(3)
    rows = [(y, i, rng.choice([0, 0, 0, rng.randrange(-50, 50)])) for y in (1, 2) for i in range(137)] + [(3, 0, 5), (3, 1, None)]
    df = spark.createDataFrame(rows, "y int, i int, v long").repartition(3)
    got = {(r.y, r.i): r.p for r in with_percentile_ranks(df, ["y", "i"], ["y"], {"p": "v"}).collect()}
    frame = pd.DataFrame(rows[:-1], columns=["y", "i", "v"])
    for y, part in frame.groupby("y"):
        expected = np.ceil(part["v"].rank() / len(part) * 100).astype(int)
        assert [got[(y, i)] for i in part["i"]] == list(expected)
    assert got[(3, 1)] is None


def test_half_of_all_suites_at_zero(spark):
    rng = random.Random(4)
    values = [0] * 5000 + [rng.randrange(1, 10**6) for _ in range(5000)]
    rows = [(f"S{k}", v) for k, v in enumerate(values)]
    df = spark.createDataFrame(rows, "s string, v long").repartition(4)
    ranked = with_percentile_ranks(df, ["s"], [], {"p": "v"})
    got = {r.s: r.p for r in ranked.collect()}
    expected = np.ceil(pd.Series(values).rank() / len(values) * 100).astype(int)
    assert [got[f"S{k}"] for k in range(len(values))] == list(expected)
    # No window without a partition.
    plan = ranked._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert windows and all("_bucket" in line for line in windows)


def test_top_share_counts_ties_that_fit(spark):
    for values in ([100, 60, 40], [5] * 30, list(range(1000)) + [999] * 200, [0] * 500 + [1]):
        df = spark.createDataFrame([(v,) for v in values], "v long").repartition(3)
        k = max(1, int(len(values) * 0.1))
        assert tuple(map(int, top_share(df, "v").collect()[0])) == (sum(sorted(values)[-k:]), sum(values))
