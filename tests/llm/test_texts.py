"""Personal data, pages, toxicity and the pipeline."""

import random
import re

from pyspark.sql import functions as F

from parcelmetrics.llm import pii, queries, toxicity, wrappers

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    doubled = [int(c) * (1 + k % 2) for k, c in enumerate(reversed(digits))]
    return sum(x - 9 * (x > 9) for x in doubled) % 10 == 0


def base_spans(text):
    for kind, pattern in BASE.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            holds = {"email": True, "ip": kind != "ip" or all(int(x) <= 255 for x in m[0].split(".")), "card": 16 <= len(digits) <= 19 and luhn(digits), "phone": 8 <= len(digits) <= 15}
            if holds[kind]:
                yield f"{kind}:{m.start()}:{m.end()}"


def test_base_spans(spark):
    dice = random.Random(3)
    parts = ["a@b.c", "1.2.3.4", "300.1.1.1", "+1 (555) 123-4567", "4111 1111 1111 1111", "4111-1111-1111-1112", "x", "é", "🙂", " ", "\n", ".", "@", "+", "12", "a.b", "_d@e.f", "00000000001.2.3.4", "1.2.3.4.5.6.7.8", "a@b..c"]
    rows = [(i, "".join(dice.choice(parts) for _ in range(dice.randint(0, 14)))) for i in range(800)]
    rows += [(None, None), (5001, ""), (5002, "a@" + "b." * 9000 + "c"), (5005, "1 " * 9000), (5007, "a@b.c " * 1500), (3, "a@b.c"), (3, "a@b.c")]
    found = pii.personal_data(spark.createDataFrame(rows, "doc_id long, text string"))
    got = sorted((str(r.doc_id), r.b) for r in found.select("doc_id", pii.as_list("spans").alias("b")).collect())
    assert got == sorted((str(i), ",".join(base_spans(t or ""))) for i, t in rows)


def test_contexts_discover(spark):
    numbers = ["+1 (555) 123-4567", "+1 (555) 123-4568", "+1 555 123-4569", "+1 555-123-4570"]
    rows = [(i, f"so word{i} please call {n} now thanks") for i, n in enumerate(numbers * 3)] + [(100, "hey you please call 555-0199 now or never"), (101, "section 12 of law")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in pii.personal_data(docs).withColumn("all", pii.as_list("all_spans")).collect()}
    assert got[100]["all"] == "phone:20:28" and got[101]["all"] == ""
    spans = F.expr("array(struct(6 start, 11 end, 'email' kind), struct(15 start, 22 end, 'ip' kind), struct(16 start, 18 end, 'x' kind))")
    line = spark.createDataFrame([("héllo a@b.c, x 1.2.3.4!",)], "text string").select(pii.redacted(F.col("text"), spans)).first()[0]
    assert line == "héllo [EMAIL], x [IP]!"
    assert pii.personal_data(docs.limit(0)).count() == 0


def test_secrets_are_seeds_of_their_own(spark):
    import hashlib

    rows = [(i, f'text{i} of it api_key = "{hashlib.sha1(str(i).encode()).hexdigest()}" and more') for i in range(6)]
    rows += [(50, 'other words api_key = "k3y-of-a-few" and more'), (51, "a" * 60 + " " + "1" * 60 + " year 2024"), (52, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in pii.personal_data(docs).withColumn("all", pii.as_list("all_spans")).withColumn("base", pii.as_list("spans")).collect()}
    at = rows[0][1].index('"') + 1
    assert got[0]["all"] == f"secret:{at}:{at + 40}" and got[0]["base"] == ""
    # A short one is known by its context, long words of one kind are not.
    assert got[50]["all"] == "secret:23:35" and got[51]["all"] == "" and got[52]["all"] == ""


def test_pages(spark):
    page = "<html><head><title>t</title></head><body><nav>m</nav><div class='ad'>buy</div><article><h1>H &amp; h</h1><p><b>one<br><p>two  <i>x</i>\n y<script>if(a<b)</script></article><div class=comments><p>nice</div><footer>f</footer>"
    rows = [(1, "http://a.example/1", page), (2, None, None), (3, "http://b.example/1", "<div><p>Same<p>One</div>"), (4, "http://b.example/2", "<div><p>Same<p>Two <b>b</b></div>"), (5, "http://b.example/2", ""), (None, "x", "a<!-- c --> b" + "<p>z" * 3000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    got = {r.page_id: r.text for r in wrappers.main_text(pages).collect()}
    assert got[1] == "H & h\none\ntwo x y" and got[2] == "" and got[5] == "" and got[None] == "a b" + "\nz" * 3000
    assert {got[3], got[4]} == {"One", "Two b"}
    assert wrappers.main_text(pages.limit(0)).count() == 0


def test_simple_tree_matching():
    a, b = wrappers.tree("<div><ul><li>1<li>2</ul><p>x</div>"), wrappers.tree("<div><p>y</p><ul><li>1</ul><p>x</div>")
    assert wrappers.matched(a, b)[0] == 5


def test_toxicity_held_out(spark):
    dice = random.Random(9)
    words = [f"w{i}" for i in range(400)]
    rows, labels = [], []
    for i in range(1500):
        own = [dice.choice(words) for _ in range(dice.randint(5, 80))]
        bad = i % 6 == 0
        if bad:
            own.insert(dice.randrange(len(own)), dice.choice(["insult", "scoundrel" + dice.choice("abcdef")]))
        rows.append((i, " ".join(own)))
        if i < 1000:
            labels.append((i, int(i % 2), int(bad)))
    docs = spark.createDataFrame([*rows, (5000, None), (5001, ""), (None, "insult")], "doc_id long, text string").withColumn("toxic", F.lit("clash"))
    labelled = spark.createDataFrame([*labels, (1, None, 0), (None, 1, 1)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in toxicity.toxic_documents(docs, labelled).collect()}
    assert sum(got[i].toxic == (i % 6 == 0) for i in range(1000, 1500)) >= 490
    assert not got[5000].toxic and not got[5001].toxic and got[None].toxic
    none = toxicity.toxic_documents(docs, labelled.limit(0)).collect()
    assert len(none) == len(got) and not any(r.toxic for r in none)


def test_pipeline(spark):
    import corpus_pipeline

    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "ngram_jaccard", "substring_dedup", "personal_data", "packing"]
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    # A row twice, a row without anything, and an extra column.
    docs = docs.union(docs.limit(1)).union(spark.createDataFrame([(None, None, None, None, None)], docs.schema))
    kept, before = docs, docs.count()
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, folder)
        assert kept.columns == docs.columns
    kept = kept.cache()
    assert 0 < kept.count() <= before and kept.where("doc_id is not null").count() == kept.where("doc_id is not null").select("doc_id").distinct().count()
    assert kept.where("text rlike '[a-z0-9]@[a-z0-9-]+[.][a-z]'").count() == 0
    packed = corpus_pipeline.STAGES[-1][1](spark, kept, folder)
    assert packed.select("doc_id").distinct().count() == kept.select("doc_id").distinct().count()
    assert set(queries.QUERIES) >= {"pipeline", *[q for q in queries.QUERIES if q.startswith("op")]} and len(queries.QUERIES) == 14


def test_template_inside_the_article(spark):
    note = "<p>Read us every day for one coin.</p>"
    made = lambda k, tag, n: f"<div>Site</div><{tag}><h2>Title {k}</h2>{note}" + "".join(f"<p>story {k} part {j} of {k * 7 + j}</p>" for j in range(n)) + f"<div><b>Always here</b></div></{tag}>"
    rows = [(k, f"http://{tag}.example/{k}", made(k, tag, 2 + k % 3)) for tag in ("article", "section") for k in range(6)]
    rows = [(100 * i, *r[1:]) for i, r in enumerate(rows)]
    # Near copies of one text, which makes none of it template.
    long = "".join(f"<p>Paragraph {k} is about thing number {k * k}.</p>" for k in range(9))
    rows += [(5000 + k, f"http://copies.example/{k}", f"<article>{long}<p>Seen {k}</p></article>") for k in range(2)]
    got = {r.page_id: r.text for r in wrappers.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i in range(12):
        k = i % 6
        assert got[100 * i].split("\n") == [f"Title {k}"] + [f"story {k} part {j} of {k * 7 + j}" for j in range(2 + k % 3)]
    assert all(got[5000 + k].count("Paragraph") == 9 for k in range(2))


def test_reference_page_of_each_layout():
    a = [f"<div><table><tr><td>Menu<td>More</table><p>a{k} text {k}</div>" for k in range(3)]
    b = [f"<ul><li>Shop<li>Help</ul><section><h2>b{k}</h2><p>word {k}</section>" for k in range(3)]
    got = wrappers.main_texts(["", a[0], b[0], b[1], a[1], b[2], a[2]])
    assert got == ["", "a0 text 0", "b0\nword 0", "b1\nword 1", "a1 text 1", "b2\nword 2", "a2 text 2"]
    # One of 65 pages is not left without the others; a rare text in one place of many pages is no template.
    pages = [f"<div><p>Menu</p><p>{'Again' if k < 2 else f'own {k}'} </p><p>x{k} y{k} z{k} u{k} v{k}</p></div>" for k in range(65)]
    got = wrappers.main_texts(pages)
    assert got[0] == "Again\nx0 y0 z0 u0 v0" and got[64] == "own 64\nx64 y64 z64 u64 v64"


def test_pages_of_any_depth_and_markup():
    deep = "<div>" * 3000 + "<p>deep text</p>" + "</div>" * 3000
    assert wrappers.main_texts([deep, deep.replace("deep", "other")]) == ["deep text", "other text"]
    for open_tag in ('<main class="has-sidebar">', '<article class="post comments-open">', '<div class="content with-sidebar">', '<div class="sidebar-layout"><article>'):
        assert wrappers.main_texts([f"<body>{open_tag}<p>kept</p><div class='sidebar'>gone</div><div class='site-footer'>gone</div></body>"]) == ["kept"]
    assert wrappers.main_texts(["<article><div class=x data-a=it's>a &lt; b</div><p title='1 > 0' b=\"it's\">c</p></article>"]) == ["a < b\nc"]


def test_articles_that_share_a_heading_keep_it():
    page = "<article><h1>One title</h1><p><b>A lead that two pages have.</b></p><p>{}</p></article><footer>f</footer>"
    texts = ["first text of its own", "second words, quite others", "third one"]
    pages = [page.format(t) for t in texts[:2]] + [page.format(texts[2]).replace("One title", "Another").replace("two pages have", "only this one has")]
    got = wrappers.main_texts(pages)
    assert got[0] == "One title\nA lead that two pages have.\nfirst text of its own"
    # A notice in all of five different articles is template, the heading that they share is not.
    many = [f"<article><h1>Same</h1><p>{w * 9}</p><div>Subscribe now</div></article>" for w in ("alpha ", "beta ", "gamma ", "delta ", "eps ")]
    assert wrappers.main_texts(many)[0] == "Same\n" + ("alpha " * 9).strip()
