"""Personal data: base patterns, and contextual extraction bootstrapped from what they find.

The base patterns find e-mail and IP addresses, card and phone numbers. They are the seeds, and so are secrets: words of 32
letters and digits or more, with several of both. Every other word with a digit or ``@`` is a candidate. Words before and
after a span, within 80 characters, are its lexical patterns. Patterns and spans form a graph: a pattern's
confidence is the (smoothed) mean score of its spans, a candidate's score the noisy-or of its confident patterns; both are
computed anew until no confidence moves. Candidates with a high score are added as spans of the kind of their patterns, secrets in
any case. Built-in functions only.

Rows: null text counts as empty; repeated rows each get their spans; rows are told apart by id and text, so other rows with
the same id (or none) do not mix; an empty table gives no rows; only the named columns are used. Texts are searched whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelmetrics.llm.common import staged, whole_text

KINDS = ("email", "ip", "card", "phone")
#: A fifth kind, of no base pattern.
SECRET = "secret"
#: The contract's patterns in forms that never try a place twice: possessive, and only from the start of a run of fitting
#: characters or from where the last match ended.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: What a text must hold for its pattern to be tried at all.
HINTS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9](?:[ -]?[0-9]){15}", "phone": r"\+[0-9]"}
CANDIDATE = r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+"
CONTEXT = 80
#: A pattern needs so many different seeds and such a confidence, a candidate such a score.
SUPPORT, CONFIDENCE, SCORE = 3, 0.5, 0.8
#: Rounds in which confidences must settle, to so many digits; they hardly ever take more than four.
ROUNDS, DIGITS = 20, 6

#: Offsets are summed in runs of so many matches, so that a text with very many does not cost their square.
RUN = 128
SPAN = "struct<start:int,end:int,value:string,left:string,right:string>"


def _empty() -> Column:
    return F.from_json(F.lit("[]"), f"array<{SPAN}>")


def with_matches(df: DataFrame, text: str, pattern: str, hint: Column, out: str) -> DataFrame:
    """``df`` with ``out``: all matches of ``pattern`` with code point offsets and the text left and right of them.

    The pieces between the matches and the matches take turns, so offsets are sums of lengths. Texts for which ``hint``
    is false are not searched.
    """
    both, sizes = f"{out}__both", f"{out}__sizes"
    pieces = F.split(text, pattern)
    turns = F.arrays_zip(pieces.alias("piece"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("value"), F.slice(pieces, 2, 1 << 30).alias("after"))
    df = df.withColumn(both, F.when(hint, F.filter(turns, lambda x: x["value"].isNotNull())))
    total = lambda xs: F.aggregate(xs, F.lit(0), lambda a, x: a + x)
    runs = F.sequence(F.lit(0), F.floor((F.size(both) - 1) / RUN).cast("int"))
    own = lambda r: F.slice(both, r * RUN + 1, RUN)
    length = lambda x: F.char_length(x["piece"]) + F.char_length(x["value"])
    df = df.withColumn(sizes, F.when(F.size(both) > 0, F.transform(runs, lambda r: total(F.transform(own(r), length)))))

    def step(a: Column, x: Column) -> Column:
        start = a["at"] + F.char_length(x["piece"])
        end = start + F.char_length(x["value"])
        left = F.when(F.char_length(x["piece"]) > CONTEXT, F.right(x["piece"], F.lit(CONTEXT))).otherwise(x["piece"])
        span = F.struct(start.alias("start"), end.alias("end"), x["value"].alias("value"), left.alias("left"), x["after"].substr(1, CONTEXT).alias("right"))
        return F.struct(end.alias("at"), F.concat(a["spans"], F.array(span)).alias("spans"))

    def spans(r: Column) -> Column:
        begin = F.struct(total(F.slice(sizes, F.lit(1), r)).alias("at"), _empty().alias("spans"))
        return F.aggregate(own(r), begin, step, lambda a: a["spans"])

    found = F.when(F.size(sizes) > 0, F.flatten(F.transform(runs, spans))).otherwise(_empty())
    return df.withColumn(out, found).drop(both, sizes)


def _holds(kind: str, value: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(value, r"\."), lambda p: F.coalesce(p.try_cast("int") <= 255, F.lit(False)))
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "card":
        return F.length(digits).between(16, 19) & F.call_function("luhn_check", digits)
    if kind == "phone":
        return F.length(digits).between(8, 15)
    return F.lit(True)


def _as_span(s: Column, kind: Column, start: Column | None = None, value: Column | None = None) -> Column:
    """A span with its lexical patterns: one word before, two words before, one on either side."""
    start, value = s["start"] if start is None else start, s["value"] if value is None else value
    left, right = F.lower(s["left"]), F.lower(s["right"])
    one = F.regexp_extract(left, r"(\S+)\s*$", 1)
    two = F.regexp_extract(left, r"(\S+\s+\S+)\s*$", 1)
    after = F.regexp_extract(right, r"^\s*(\S+)", 1)
    patterns = F.array(
        F.when(one != "", F.concat(F.lit("1:"), one)),
        F.when(two != "", F.concat(F.lit("2:"), F.regexp_replace(two, r"\s+", " "))),
        F.when((one != "") & (after != ""), F.concat(F.lit("b:"), one, F.lit(" _ "), after)),
    )
    return F.struct(kind.alias("kind"), start.alias("start"), (start + F.char_length(value)).alias("end"), value.alias("value"), F.array_compact(patterns).alias("patterns"))


def _is_secret(word: Column) -> Column:
    return word.rlike(r"^[A-Za-z0-9_+/=-]{32,}$") & word.rlike(r"(?:[A-Za-z][^A-Za-z]*){6}") & word.rlike(r"(?:[0-9][^0-9]*){6}")


def found_in(rows: DataFrame) -> DataFrame:
    """``rows`` (with a ``text`` that isn't null) with ``base``, spans by kind and start, and ``others``, the candidates.

    Both are arrays of (kind, start, end, value, patterns); candidates have no kind, but for secrets, and overlap no base span.
    """
    for kind in KINDS:
        hint = F.col("text").contains("@") if kind == "email" else F.col("text").rlike(HINTS[kind])
        rows = with_matches(rows, "text", PATTERNS[kind], hint, f"base_{kind}")

    def kept(kind: str) -> Column:
        return F.transform(F.filter(f"base_{kind}", lambda s: _holds(kind, s["value"])), lambda s: _as_span(s, F.lit(kind)))

    rows = rows.withColumn("base", F.concat(*map(kept, KINDS))).drop(*[f"base_{kind}" for kind in KINDS])
    rows = with_matches(rows, "text", CANDIDATE, F.col("text").rlike("[0-9@]"), "words")

    def trimmed(s: Column) -> Column:
        front = F.length(F.regexp_extract(s["value"], r"""^["'(\[<{]+""", 0))
        core = F.regexp_replace(s["value"], r"""^["'(\[<{]+|["')\]>}.,;:!?]++$""", "")
        return _as_span(s, F.when(_is_secret(core), F.lit(SECRET)), s["start"] + front, core)

    free = F.filter(F.transform("words", trimmed), lambda s: s["value"].rlike("[0-9@]") & ~F.exists("base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))
    return rows.withColumn("others", free).drop("words")


def discovered(found: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """Spans that only their contexts give away: (doc_id, tie, added: array of kind, start, end, value).

    Pattern counts are aggregated map-side, so a pattern with a third of all spans is one row for each task. Only patterns
    with enough seeds take part in the joins; copies of a span in copied documents count once.
    """
    instances = found.select("doc_id", "tie", F.explode(F.concat("base", "others")).alias("i")).select("doc_id", "tie", "i.*")
    pairs = staged(instances.select("doc_id", "tie", "kind", "start", "end", "value", F.explode("patterns").alias("pattern")), "contexts")
    # A pattern and a value make one node pair, however many copies of the document there are.
    edges = pairs.groupBy("pattern", "value", "kind").agg(F.lit(1).alias("one"))
    kinds = (
        edges.where("kind is not null").groupBy("pattern", "kind").agg(F.count("*").alias("seeds")).where(F.col("seeds") >= SUPPORT)
    )
    supported = kinds.withColumnRenamed("kind", "of")
    graph = staged(edges.join(supported.select("pattern", "of"), "pattern").select("pattern", "of", "value", "kind"), "graph")
    scores = graph.select("of", "value", "kind").distinct().withColumn("score", (F.col("kind").eqNullSafe(F.col("of"))).cast("double"))
    confident, before = None, None
    for _ in range(rounds):
        scored = graph.alias("g").join(scores.alias("s"), F.expr("g.of = s.of and g.value = s.value and g.kind <=> s.kind")).select("g.pattern", "g.of", "s.score")
        confident = staged(
            scored.groupBy("pattern", "of").agg((F.sum("score") / (F.count("*") + 1)).alias("confidence")).where(F.col("confidence") >= CONFIDENCE),
            "patterns",
        )
        # A pattern's confidence moves one way only, so equal sums mean that none has moved.
        now = confident.agg(F.count("*"), F.sum(F.round("confidence", DIGITS).cast("decimal(38,6)"))).first()
        if now == before:
            break
        before = now
        joined = graph.where("kind is null").join(confident, ["pattern", "of"])
        unseen = joined.groupBy("of", "value").agg((1 - F.exp(F.sum(F.log(1 - F.least(F.col("confidence"), F.lit(0.999)))))).alias("score"))
        seeds = graph.where("kind is not null").select("of", "value", "kind", (F.col("kind") == F.col("of")).cast("double").alias("score")).distinct()
        others = graph.where("kind is null").select("of", "value", "kind").distinct().join(unseen, ["of", "value"], "left").select("of", "value", "kind", F.coalesce("score", F.lit(0.0)).alias("score"))
        scores = staged(seeds.unionByName(others), "scores")
    best = pairs.where("kind is null").drop("kind").join(confident, "pattern").groupBy("doc_id", "tie", "start", "end", "value", "of")
    strong = best.agg((1 - F.exp(F.sum(F.log(1 - F.least(F.col("confidence"), F.lit(0.999)))))).alias("score")).where(F.col("score") >= SCORE)
    one = strong.groupBy("doc_id", "tie", "start", "end", "value").agg(F.max_by("of", F.struct("score", "of")).alias("kind"))
    return one.groupBy("doc_id", "tie").agg(F.collect_set(F.struct("kind", "start", "end", "value")).alias("added"))


def personal_data(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, tie: hash of the text, spans, all_spans): base spans, and those with the discovered ones, both by kind as
    listed, then start. Only the spans and their contexts are staged."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), whole_text(text).alias("text"))
    found = staged(found_in(rows).select("doc_id", F.xxhash64("text").alias("tie"), "base", "others"), "spans")
    added = discovered(found).withColumnRenamed("doc_id", "d").withColumnRenamed("tie", "t")
    plain = lambda s: F.struct(*[s[k].alias(k) for k in ("kind", "start", "end", "value")])
    secrets = F.transform(F.filter("others", lambda s: s["kind"] == SECRET), plain)
    slim = found.select("doc_id", "tie", F.transform("base", plain).alias("spans"), secrets.alias("secrets"))
    joined = slim.join(added, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("tie") == F.col("t")), "left").drop("d", "t")
    place = F.array(*map(F.lit, (*KINDS, SECRET)))
    both = F.concat("spans", "secrets", F.coalesce("added", F.array().cast(joined.schema["spans"].dataType)))
    keyed = F.array_sort(F.transform(both, lambda s: F.struct(F.array_position(place, s["kind"]).alias("place"), s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"), s["value"].alias("value"))))
    ordered = F.transform(keyed, lambda s: F.struct(*[s[k].alias(k) for k in ("kind", "start", "end", "value")]))
    more = F.col("added").isNotNull() | (F.size("secrets") > 0)
    return joined.select("doc_id", "tie", "spans", F.when(more, ordered).otherwise(F.col("spans")).alias("all_spans"))


def as_list(spans: str) -> Column:
    """``kind:start:end`` joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redacted(text: Column, spans: Column) -> Column:
    """``text`` with every span replaced by its kind in brackets; spans that overlap give one replacement."""
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    begin = F.struct(F.lit("").alias("text"), F.lit(0).alias("at"))

    def step(a: Column, s: Column) -> Column:
        gap = text.substr(a["at"] + 1, s["start"] - a["at"])
        new = F.concat(a["text"], gap, F.lit("["), F.upper(s["kind"]), F.lit("]"))
        return F.struct(F.when(s["start"] >= a["at"], new).otherwise(a["text"]).alias("text"), F.greatest(a["at"], s["end"]).alias("at"))

    return F.aggregate(ordered, begin, step, lambda a: F.concat(a["text"], text.substr(a["at"] + 1, F.char_length(text))))
