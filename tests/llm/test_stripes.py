"""Collocations against brute force."""

import collections
import random
import re

import numpy as np
import pytest

from parcelmetrics.llm import collocations, stripes
from parcelmetrics.llm.checks import COLLOCATIONS


def brute(rows, least, longest, top):
    f, n = collections.defaultdict(collections.Counter), collections.Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            words = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(words)
            for m in range(1, longest + 1):
                f[lang].update(tuple(words[i : i + m]) for i in range(len(words) - m + 1))
    out = []
    for lang, counts in f.items():
        found = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        inside = {p[i : i + m] for p, a in found.items() for m in range(2, len(p)) for i in range(len(p) - m + 1) if a >= counts[p[i : i + m]]}
        ranked = []
        for p, a in found.items():
            if p not in inside:
                score, k = min((1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p)))
                ranked.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        out += [(lang, k, p.decode(), -a, l, r, n[lang], -s) for k, (s, a, p, l, r) in enumerate(sorted(ranked)[:top], 1)]
    return sorted(out)


def texts():
    dice = random.Random(4)
    words = ["a", "B", "c", "Ünd", "ÜND", "a\x00", "x y", "\u0085", "日本", "e"]
    rows = [(dice.choice(["en", "en gb", "", None, "und"]), "".join(dice.choice(words) + dice.choice([" ", " ", "\t ", ". ", "\x0b", "!?"]) for _ in range(dice.randint(0, 60)))) for _ in range(150)]
    return rows + [("en", None), (None, None), ("en", ""), ("en", "a b " * 3000), ("zz", "one two one two")] + [("en", "hot copy of it")] * 80


@pytest.mark.parametrize("least, longest, top", [(5, 5, 2000), (2, 3, 7), (100, 5, 2000)])
def test_collocations(spark, monkeypatch, least, longest, top):
    from pyspark.sql import functions as F

    rows = texts()
    docs = spark.createDataFrame(rows, "lang string, text string").withColumn("phrase", F.lit("clash")).withColumn("N", F.lit(1)).repartition(5)
    got = collocations.collocations(docs, least, longest, top)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == brute(rows, least, longest, top)
    assert got.schema["score"].dataType.simpleString() == "bigint"


def test_collocations_of_nothing(spark):
    docs = spark.createDataFrame([], "lang string, text string")
    assert collocations.collocations(docs).count() == 0
    assert collocations.collocations(spark.createDataFrame([("en", None)], "lang string, text string")).count() == 0


def test_collocations_agree_with_sql(spark):
    import duckdb

    from parcelmetrics.llm.queries import op11_collocations

    con = duckdb.connect()
    con.execute("CREATE VIEW documents AS SELECT * FROM '/root/testdata/sf0.001/documents.parquet'")
    want = con.execute(COLLOCATIONS)
    names = [d[0] for d in want.description]
    got = op11_collocations(spark, "/root/testdata/sf0.001")
    assert sorted(map(tuple, got.select(names).collect())) == sorted(want.fetchall())


def test_scores_beyond_64_bits(spark):
    expr = "(cast(1000 as decimal(4,0)) * cast(a as decimal(16,0)) * cast(n as decimal(16,0))) div (cast(l as decimal(16,0)) * cast(r as decimal(16,0)))"
    dice = random.Random(5)
    rows = [(dice.randint(100, 10**12), dice.randint(10**12, 10**13), dice.randint(10**5, 10**12), dice.randint(10**6, 10**12)) for _ in range(300)]
    got = spark.createDataFrame(rows, "a long, n long, l long, r long").selectExpr("a", "n", "l", "r", f"{expr} AS s").collect()
    assert all(x.s == 1000 * x.a * x.n // (x.l * x.r) for x in got if 1000 * x.a * x.n // (x.l * x.r) < 2**63)


def test_packing_of_integers():
    values = np.array([-1, 0, 65534, 65535, 65536, 2**40, 2**62])
    assert stripes.unpacked(stripes.packed(values)).tolist() == values.tolist()
    assert stripes.unpacked(stripes.packed(np.zeros(0))).tolist() == []


def model(rows, prior):
    """Scores by dictionaries over the whole training part."""
    import math

    from parcelmetrics.llm.backoff import END, held_out

    def words(text):
        return (text or "").encode().lower().split()

    train = [words(t) + [END] for i, t in rows if not held_out(i)]
    c = collections.Counter(w for doc in train for w in doc)
    pairs = collections.Counter(p for doc in train for p in zip([END, *doc], doc))
    total, distinct = sum(c.values()), len(c)
    share = lambda w: (c[w] + 0.1) / (total + 0.1 * (distinct + 1))
    out = []
    for i, text in rows:
        doc = words(text) + [END]
        base = sum(math.log10(share(w)) for w in doc)
        own = sum(math.log10((pairs[h, w] + prior * share(w)) / (c[h] + prior)) for h, w in zip([END, *doc], doc))
        out.append((i, held_out(i), len(doc), sum(c[w] > 0 for w in doc), total, base, own))
    return out


def near(got, want):
    order = lambda r: (r[0] is None, r[0] or 0, r[-1])
    assert len(got) == len(want)
    for a, b in zip(sorted(map(tuple, got), key=order), sorted(want, key=order)):
        assert a[:5] == b[:5] and a[5:] == pytest.approx(b[5:], rel=1e-9)


def test_scores_of_the_automaton(spark):
    from pyspark.sql import functions as F

    from parcelmetrics.llm import backoff

    rows = [(k, text) for k, (_, text) in enumerate(texts())] + [(None, "a b"), (7, "again, 7"), (7, "again, 7"), (10**12, "x" * 100_000), (-3, "unseen\x1cword \x85")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("N", F.lit(1)).withColumn("score", F.lit("clash")).repartition(5)
    for prior in (backoff.PRIOR, 2.0):
        near(backoff.score(docs, prior).collect(), model(rows, prior))
    assert backoff.score(docs.limit(0)).count() == 0


def test_scores_without_training(spark):
    from parcelmetrics.llm import backoff

    held = [k for k in range(200) if backoff.held_out(k)][:5]
    rows = [(k, "some words") for k in held]
    got = backoff.score(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    near(got, model(rows, backoff.PRIOR))


def test_arcs_and_failure_sum_to_one():
    from parcelmetrics.llm import backoff

    counts = np.array([3, 5, 2, 0])
    before, after, pairs = np.array([0, 1, 1]), np.array([1, 1, 2]), np.array([3, 2, 2])
    a = backoff.Automaton(counts, 10, 3, before, after, pairs, 4.0)
    unknown = 0.1 / (10 + 0.4)
    for state in range(3):
        own = {w: 10 ** a.arcs[(state + 1) * 4 + w] for w in range(4) if (state + 1) * 4 + w in a.arcs}
        rest = sum(10 ** a.unigram[w] for w in range(3) if w not in own) + unknown
        assert state or len(own) == 1
        # What no arc takes goes down the failure arc.
        missing = counts[state] - pairs[before == state].sum()
        assert sum(own.values()) + 10 ** a.failure[state + 1] * rest == pytest.approx(1 - missing / (counts[state] + 4.0))


def test_scores_predict_held_out_texts_better(spark):
    from pyspark.sql import functions as F

    from parcelmetrics.llm.queries import op12_lm_scores

    scored = op12_lm_scores(spark, "/root/testdata/sf0.01").where("held_out")
    base, own = scored.agg(F.sum("base_score"), F.sum("score")).first()
    assert own > base
