"""Joins, near duplicates, passages, fingerprints against brute force."""

import collections
import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from parcelmetrics.llm import fingerprints, jaccard, neardup, paragraphs
from parcelmetrics.llm.common import components


def union(links, ids):
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def shingle_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[k : k + 5]) for k in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} - {()}


def alike(sets):
    where = collections.defaultdict(list)
    for i, own in sets.items():
        for j, n in collections.Counter(j for s in own for j in where[s]).items():
            if 100 * n >= 80 * (len(own) + len(sets[j]) - n):
                yield i, j
        for s in own:
            where[s].append(i)


def copies(seed, count, words=60):
    dice = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)]
    base = [[dice.choice(vocabulary) for _ in range(dice.randint(3, words))] for _ in range(25)]
    for i in range(count):
        own = list(dice.choice(base))
        for _ in range(dice.choice([0, 0, 1, 1, 2, 4])):
            own[dice.randrange(len(own))] = dice.choice(vocabulary)
        yield i, " ".join(own)


def test_components(spark):
    dice = random.Random(4)
    links = [(dice.randrange(400), dice.randrange(400)) for _ in range(300)] + [(k, k + 1) for k in range(500, 560)] + [(7, 7), (None, 3)]
    want = union([(a, b) for a, b in links if a is not None], range(600))
    got = {r.id: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert all(got.get(i, i) == want[i] for i in range(600))
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("small, large", [(256, 4096), (4, 40)])
def test_jaccard_join(spark, monkeypatch, small, large):
    monkeypatch.setattr(jaccard, "SMALL", small)
    monkeypatch.setattr(jaccard, "LARGE", large)
    rows = [*copies(5, 900), (2000, None), (2001, ""), (2002, " \n"), (2003, "A b"), (2004, "a  B\n"), (2005, "x"), (2006, "long word " * 9000), (2005, "x"), (None, "x")]
    sets = {i: shingle_set(t) for i, t in rows if i is not None}
    want = union(alike(sets), sets)
    docs = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, n int")
    got = jaccard.jaccard_components(docs).collect()
    assert len(got) == len(rows)
    assert all((r.n_shingles, r.component_id) == (len(sets[r.doc_id]), want[r.doc_id]) for r in got if r.doc_id is not None)
    assert jaccard.jaccard_components(docs.limit(0)).count() == 0


def test_passages(spark):
    rows = []
    for i, text in copies(6, 150, 90):
        rows.append((i, f"short line\n{text}\n" + " ".join(f"own{i}x{k}" for k in range(55))))
    rows += [(900, None), (901, "same\n" * 50), (902, rows[0][1]), (None, rows[0][1])]
    sets = {(i, k): shingle_set(line) for i, t in rows if i is not None for k, line in enumerate((t or "").split("\n")) if len(line.split()) >= 50}
    want = {k for k, root in union(alike(sets), sets).items() if k != root}
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = paragraphs.repeated_passages(docs).collect()
    assert {(r.doc_id, r.place) for r in got} == want and len(want) > 20
    texts = dict(rows)
    assert all(texts[r.doc_id][r.start : r.end] == texts[r.doc_id].split("\n")[r.place] for r in got)
    left = {r.doc_id: r.text for r in paragraphs.without_repeats(docs).collect()}
    assert left[901] == texts[901] and all((i, 1) in want or left[i] == texts[i] for i in range(150))
    assert paragraphs.repeated_passages(docs.limit(0)).count() == 0


@pytest.mark.parametrize("block", [1024, 32])
def test_near_duplicate_vectors(spark, monkeypatch, block):
    monkeypatch.setattr(neardup.links, "__defaults__", (0.9, 0.97, block))
    dice, rng = random.Random(2), np.random.default_rng(0)
    base = [rng.standard_normal(8) for _ in range(40)]
    rows = [(i, [float(x) for x in (dice.choice(base) + rng.standard_normal(8) * dice.choice([0, 0.1, 0.2])) * dice.choice([1, 3])]) for i in range(400)]
    rows += [(1000, None), (1001, [0.0] * 8), (1002, [float("nan")] * 8), (1003, [1.0, None] + [0.0] * 6), (1004, [1.0]), (1005, [2.0]), (1006, []), (1007, [1.0])]
    unit = {i: np.array(v) / np.linalg.norm(v) for i, v in rows if v and None not in v and np.isfinite(v).all() and any(v)}
    links = [(a, b) for a in unit for b in unit if a < b and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= 0.9]
    degree = collections.Counter(x for pair in links for x in pair)
    got = {r.vec_id: r for r in neardup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert set(got) == {i for i, _ in rows} and all(r.n_links <= degree[i] for i, r in got.items())
    assert sum(r.n_links for r in got.values()) >= 0.95 * sum(degree.values())
    want = union(links, [i for i, _ in rows])
    assert sum(r.component_id == want[i] and r.kept == (i == want[i]) for i, r in got.items()) >= 0.98 * len(rows)
    assert all(got[i].n_links == 0 and got[i].kept for i in (1000, 1001, 1002, 1003, 1006))


def test_fingerprints(spark):
    rows = [(i * 7, t) for i, t in copies(8, 120, 120)] + [(5000, None), (5001, "é🙂x y z w v u"), (5002, "one"), (900000000000, "q " * 3000), (5003, "two"), (5003, "two")]
    order = sorted(rows, key=lambda r: r[0])
    want = collections.defaultdict(list)
    for k, (i, t) in enumerate(order):
        t, after = t or "", order[(k + 1) % len(order)][1] or ""
        edited = t[: len(t) - len(t) // 4] + after[: len(t) // 4]
        sets = [set(zip(*[w[k:] for k in range(5)])) if len(w) >= 5 else {tuple(w)} for w in (re.findall(r"[^ \t-\r]+", x) for x in (t, edited, after))]
        want[i].append((len(t), hashlib.sha256(edited.encode()).hexdigest(), *[len(sets[0] & s) / len(sets[0] | s) for s in sets[1:]]))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = fingerprints.fingerprints(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        assert any((r.n_chars, r.edited_sha256) == w[:2] and abs(r.near_edited - w[2]) < 0.16 and abs(r.near_next - w[3]) < 0.16 for w in want[r.doc_id]), (r, want[r.doc_id])
    assert len({r.fingerprint for r in got}) == len({t or "" for _, t in rows})
    assert fingerprints.fingerprints(docs.limit(0)).count() == 0


def test_parities_bound_the_difference_of_sets():
    dice = np.random.default_rng(3)
    for n, m, common in ((1, 1, 0), (5, 40, 3), (300, 290, 250), (4000, 900, 800)):
        drawn = np.unique(dice.integers(0, 1 << 63, n + m, dtype=np.uint64))
        dice.shuffle(drawn)
        x, y = drawn[:n], np.append(drawn[:common], drawn[n : n + m - common])
        assert jaccard.least_difference(jaccard.parities(x), jaccard.parities(x)) == 0
        assert jaccard.least_difference(jaccard.parities(x), jaccard.parities(y)) <= n + m - 2 * common


def covered_words(rows):
    """By brute force (document, word) of all runs of 51 words that occur before, in the same text without overlap."""
    first, out = {}, set()
    for i, text in sorted(rows):
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
        for p in range(len(words) - 50):
            j, q = first.setdefault(tuple(words[p : p + 51]), (i, p))
            if (i, p) != (j, q) and not (i == j and p < q + 51):
                out |= {(i, p + k) for k in range(51)}
    return out


def test_runs_inside_lines_and_over_lines(spark):
    dice = random.Random(8)
    vocabulary = [f"w{i}" for i in range(3000)]
    some = lambda n: [dice.choice(vocabulary) for _ in range(n)]
    passages = [some(n) for n in (50, 51, 52, 54, 59, 80, 200)]

    def broken(words, n):
        return "".join(w + (" \n" if k % n == n - 1 else dice.choice([" ", "  ", "\t"])) for k, w in enumerate(words))

    rows = []
    for i in range(60):
        parts = [broken(some(dice.randrange(90)), 1000)]
        for _ in range(dice.randrange(3)):  # inside a longer line, or over short lines
            parts += [broken(dice.choice(passages), dice.choice([7, 20, 38, 1000])), broken(some(dice.randrange(90)), 1000)]
        rows.append((i, "é" * (i % 3) + " ".join(parts).replace("w1", "W1")))
    rows += [(70, "same\n" * 300), (71, "same " * 120), (72, "a b c " * 60 + broken(passages[5][:70], 9)), (73, " ".join(vocabulary[:45] * 9)), (74, "x " + " ".join(vocabulary[:45] * 4)), (75, "")]
    want = covered_words(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    spans = paragraphs.repeated_spans(docs).collect()
    texts, got = dict(rows), set()
    for r in spans:
        at = [m.span() for m in re.finditer(r"[^\x20\x09-\x0D]+", texts[r.doc_id])]
        got |= {(r.doc_id, k) for k, (a, b) in enumerate(at) if r.start <= a and b <= r.end}
    lines = set()
    for r in paragraphs.repeated_passages(docs).collect():
        at = [m.span() for m in re.finditer(r"[^\x20\x09-\x0D]+", texts[r.doc_id])]
        lines |= {(r.doc_id, k) for k, (a, b) in enumerate(at) if r.start <= a and b <= r.end}
    assert got == want | lines and len(want - lines) > 1000
    ordered = sorted((r.doc_id, r.start, r.end) for r in spans)
    assert all(a[0] < b[0] or a[2] < b[1] for a, b in zip(ordered, ordered[1:]))
    left = {r.doc_id: r.text for r in paragraphs.without_passages(docs).collect()}
    for i, text in rows:
        assert left[i].split() == [w for k, w in enumerate(text.split()) if (i, k) not in got]
    assert paragraphs.repeated_spans(docs.limit(0)).count() == 0


def test_one_id_with_different_texts(spark):
    import corpus_pipeline

    line = lambda name, n=40: " ".join(f"{name}{k}" for k in range(n))
    rows = [(1, line("a")), (2, line("b")), (2, line("c")), (3, line("b") + " more"), (4, line("c") + " more"), (5, line("a")), (5, line("z")), (2, line("b")), (6, None), (6, ""), (6, line("y")), (None, line("a"))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, r.text or "") for r in corpus_pipeline.one_of_each_group(spark, docs, "").collect()}
    assert got == {(1, line("a")), (2, line("b")), (2, line("c")), (5, line("z")), (6, ""), (6, line("y")), (None, line("a"))}
    found = sorted((r.doc_id, r.component_id) for r in jaccard.jaccard_components(docs).collect() if r.doc_id in (3, 4, 5))
    assert found == [(3, 2), (4, 2), (5, 1), (5, 5)]


def test_vectors_of_extreme_magnitudes(spark):
    from parcelmetrics.llm import neardup

    rows = [(1, [1e200, 1e200]), (2, [2e200, 2e200]), (3, [1e-200, 1e-201]), (4, [1e-201, 1e-200]), (5, [5e-324, 5e-325 * 0])]
    got = {r.vec_id: (r.n_links, r.component_id) for r in neardup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    # 3 and 5 point almost the same way, 3 and 4 do not.
    assert got[1] == (1, 1) and got[2] == (1, 1) and got[4] == (0, 4) and got[3] == (1, 3) and got[5] == (1, 3)


def test_next_documents_with_one_far_id(spark):
    from pyspark.sql import functions as F

    from parcelmetrics.llm import fingerprints

    ids = [*range(5000), 2**62, None]
    docs = spark.createDataFrame([(i, f"text {i}") for i in ids], "doc_id long, text string").withColumn("tie", F.xxhash64("text"))
    chained = fingerprints.with_next(docs, ["text"])
    got = {r.doc_id: r.next_text for r in chained.collect()}
    order = [None, *range(5000), 2**62]
    assert got == {i: f"text {order[(k + 1) % len(order)]}" for k, i in enumerate(order)}
    # The far id does not put all others into one window.
    parts = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    borders = docs.select(F.percentile_approx("doc_id", [k / parts for k in range(1, parts)], 10 * parts)).first()[0]
    assert max(sum(a < i <= b for i in range(5000)) for a, b in zip([-1, *borders], borders)) < 2 * 5000 / parts


def test_words_of_a_text_are_looked_up_once(monkeypatch):
    """Long lines and runs share the words of their text; lines keep the place, set and bands they have by themselves."""
    looked_up = []

    class Counted(jaccard.WordHashes):
        def __getitem__(self, word):
            looked_up.append(word)
            return super().__getitem__(word)

    class Rows:
        def where(self, _):
            return self

        def mapInArrow(self, find, _):  # noqa: N802
            return find

    lines = [" ".join(f"W{i}é" for i in range(70)), "", "\tshort \x0b", " ".join(f"x{i % 9}" for i in range(55)) + " \r"]
    texts = ["\n".join(lines), "", "few words"]
    batch = pa.RecordBatch.from_arrays([pa.array([4, 5, 6]), pa.array([0, 0, 0]), pa.array(texts)], ["doc_id", "tie", "text"])
    monkeypatch.setattr(paragraphs, "WordHashes", Counted)
    got = pa.Table.from_batches(list(paragraphs.paragraphs_of(Rows())(iter([batch])))).to_pylist()
    assert len(looked_up) == sum(len(t.split()) for t in texts)
    signer = paragraphs.Signer(*paragraphs.tuned_bands())
    own = [r for r in got if r["least"] is None]
    assert [(r["doc_id"], r["place"], r["start"], r["end"]) for r in own] == [(4, 0, 0, len(lines[0])), (4, 3, len(texts[0]) - len(lines[3]), len(texts[0]))]
    for r, line in zip(own, [lines[0], lines[3]]):
        alone = jaccard.shingles(line, jaccard.WordHashes())
        assert r["n"] == len(alone) and r["bands"] == signer.keys([signer.least(alone)])[0].tolist()


def test_members_of_a_region_that_reach_no_other_label_are_left_out():
    dice = np.random.default_rng(9)
    base = [np.unique(dice.integers(0, 1 << 63, n, dtype=np.uint64)) for n in (40, 300, 310, 700)]
    sets = [np.unique(np.append(dice.permutation(b)[: len(b) - cut], dice.integers(0, 1 << 63, cut, dtype=np.uint64))) for b in base for cut in (0, 0, 3, 20, 60)[: 4 if len(b) < 50 else 5]]
    n, bits = np.array([len(s) for s in sets]), [jaccard.parities(s) for s in sets]
    label = dice.integers(0, 6, len(sets))
    keep = jaccard._reach(n, label, bits)
    near = lambda i, j: label[i] != label[j] and jaccard.linked(len(np.intersect1d(sets[i], sets[j])), n[i], n[j])
    linked = [any(near(i, j) for j in range(len(sets))) for i in range(len(sets))]
    assert all(k for k, x in zip(keep, linked) if x) and any(linked)
    apart = [np.unique(dice.integers(0, 1 << 63, 300, dtype=np.uint64)) for _ in range(50)]
    assert not jaccard._reach(np.array([len(s) for s in apart]), np.arange(50), [jaccard.parities(s) for s in apart]).any()
    assert not jaccard._reach(n, np.zeros(len(n), np.int64), bits).any()


def test_marks_keep_every_row_with_a_partner(spark, monkeypatch):
    from parcelmetrics.llm import common

    rows = spark.createDataFrame([(i, i % 7) for i in range(5000)] + [(None, 1)], "a long, b long")
    few = spark.createDataFrame([(i, i % 7) for i in range(0, 5000, 100)] + [(9999, 0)], "a long, b long")
    for bits, most in ((common.MARKS, 60), (128, 5001)):
        monkeypatch.setattr(common, "MARKS", bits)
        got = common.with_mark(rows, few, ["a", "b"], "met").collect()
        met = {r.a for r in got if r.met}
        assert len(got) == 5001 and set(range(0, 5000, 100)) <= met and len(met) <= most
    assert common.with_mark(rows, few.limit(0), ["a", "b"], "met").where("met").count() == 0


def test_texts_without_a_partner_are_not_shuffled(spark, monkeypatch):
    """Only texts and profiles that may meet another are moved, also where no table is small enough to be broadcast."""
    monkeypatch.setattr(jaccard, "SMALL", 4)
    plans, write = [], jaccard.staged
    monkeypatch.setattr(jaccard, "staged", lambda df, name: (plans.append((name, df._jdf.queryExecution().optimizedPlan().toString())), write(df, name))[1])
    docs = spark.createDataFrame([*copies(5, 200), *[(1000 + i, f"alone {i} " * 9) for i in range(50)]], "doc_id long, text string")
    assert jaccard.jaccard_components(docs).count() == 250
    of = dict(plans)
    assert "marks" in of["classes"] and "marks" in of["sets"] and "members" in of


def test_spans_that_meet_are_one():
    import tracemalloc

    dice = random.Random(3)
    spans = [[{"start": (a := dice.randrange(20_000)), "end": a + dice.randrange(1, 400), "kept_doc_id": dice.randrange(9)} for _ in range(dice.choice([0, 1, 2, 40, 100]))] for _ in range(1500)]
    want = []
    for k, own in enumerate(spans):
        last = None
        for start, end, kept in sorted((s["start"], s["end"], s["kept_doc_id"]) for s in own):
            if last is not None and start <= last[3]:
                last[3] = max(last[3], end)
            else:
                want.append(last := [k, -k, start, end, kept])
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kept_doc_id", pa.int64())]))
    batch = pa.RecordBatch.from_arrays([pa.array(range(1500)), pa.array([-k for k in range(1500)]), pa.array(spans, kind)], ["doc_id", "tie", "spans"])
    tracemalloc.start()
    got = list(paragraphs.merged_spans(iter([batch, batch[:0], batch[700:]])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [list(r.values()) for b in got for r in b.to_pylist()] == want + [w for w in want if w[0] >= 700]
    # No object for each span: dictionaries of three numbers take some 300 bytes each.
    assert peak < 150 * sum(map(len, spans))


def test_regions_too_large_for_a_task(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "LARGE", 24)
    merged = "spark.sql.adaptive.coalescePartitions.enabled"
    old = spark.conf.get(merged)
    spark.conf.set(merged, "false")
    dice = random.Random(8)
    base = [[dice.randrange(1 << 62) for _ in range(40)] for _ in range(3)]
    sets = {}
    for k in range(200):
        own = list(base[k % 3])
        for _ in range(dice.randint(0, 12)):
            own[dice.randrange(40)] = dice.randrange(1 << 62)
        sets[k] = np.unique(np.array(own, np.uint64))
    try:
        rows = spark.createDataFrame([(k, v.tobytes()) for k, v in sets.items()], "rep long, shingles binary")
        # Regions of all, of a third, and of so few that a task joins them.
        regions = spark.createDataFrame([(r, k, k) for r, some in [(1, range(200)), (2, range(0, 200, 3)), (3, range(20))] for k in some], "region long, rep long, label long")
        edges = jaccard.verified_edges(spark.createDataFrame([], "a long, b long"), regions, rows)
        found = {r.id: r.component for r in components(edges).collect()}
    finally:
        spark.conf.set(merged, old)
    want = union(alike({k: set(v.tolist()) for k, v in sets.items()}), sets)
    assert len(set(want.values())) > 3
    assert all(found.get(k, k) == want[k] for k in sets)
