"""Phrase collocations by stripes: every prefix keys a counter of its next words (see ``stripes``).

Lengths follow one another: a phrase of m + 1 words is counted only where its first and its last m words are frequent, which
each of its occurrences must be. Merged stripes give the extensions of a prefix with their totals, their sum its
occurrences inside pieces, their greatest entry the test whether a longer phrase subsumes it. As a phrase inside a longer
one with the same total has that total at every length between, extensions by one word suffice.

Everything is per language: word numbers are those of (language, word). Rows: null texts count as empty, a null language as
``und``; repeated rows count again; an empty table gives no rows; ties are broken by the phrase; a text of any length is
counted whole; only the named columns are used.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcelmetrics.llm.common import drop_staged, staged, whole_text
from parcelmetrics.llm.stripes import (
    BUCKET_BYTES,
    WORDS,
    Numbers,
    apart,
    bucket_numbers,
    by_frequency,
    count_pairs,
    count_words,
    packed,
    shards_for,
    told_pairs,
    told_words,
    unpacked,
    with_answers,
    word_columns,
)
from parcelmetrics.llm.tokens import small_batches

LONGEST, LEAST, TOP = 5, 100, 2000

#: Upper to lower case, and all that ends a piece to a full stop.
_FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ,;:!?\n\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz.........")

STATE = "bucket long, n long, size long, codes binary, grams binary, word_ids binary, gram_ids binary"


def pieces(text: bytes) -> list[bytes]:
    """Words in order, with ``.`` between pieces."""
    return text.translate(_FOLD).replace(b".", b" . ").split()


def word_buckets(docs: DataFrame) -> DataFrame:
    """(bucket, n, WORDS as ``<language> <word>``, counts, codes, langs, lang_counts) of (lang, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = bucket_numbers()
        for batch in small_batches(batches, "text", BUCKET_BYTES):
            found: dict[bytes, Numbers] = {}
            places: list[tuple[bytes, bytes]] = []
            codes, langs = [], []
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                own = found.setdefault(lang, Numbers({b".": 0}))
                words = pieces(text)
                codes.append(np.fromiter(map(own.__getitem__, words), np.int64, len(words)))
                langs.append(lang)
            size = 0
            first = {}
            for lang, own in found.items():
                first[lang] = size
                places += [(lang, w) for w in list(own)[1:]]
                size += len(own) - 1
            # Code 0 of a language is the end of a piece; others move to the numbers of the bucket.
            gap = np.full(1, -1, np.int64)
            flat = np.concatenate([x for lang, c in zip(langs, codes) for x in (np.where(c == 0, -1, c - 1 + first[lang]), gap)])
            flat, order = by_frequency(flat, size)
            counts = np.bincount(flat[flat >= 0], minlength=size)
            lang_counts = {lang: 0 for lang in found}
            for lang, c in zip(langs, codes):
                lang_counts[lang] += int((c > 0).sum())
            words = [b" ".join(places[k]) for k in order.tolist()]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([next(numbers)]),
                    pa.array([len(flat)]),
                    *[pa.array([c], pa.binary()) for c in word_columns(words)],
                    pa.array([packed(counts)], pa.binary()),
                    pa.array([packed(flat)], pa.binary()),
                    pa.array([list(lang_counts)], pa.list_(pa.binary())),
                    pa.array([list(lang_counts.values())], pa.list_(pa.int64())),
                ],
                ["bucket", "n", "words", "word_lengths", "places", "counts", "codes", "langs", "lang_counts"],
            )

    schema = f"bucket long, n long, {WORDS}, counts binary, codes binary, langs array<binary>, lang_counts array<long>"
    return docs.mapInArrow(run, schema)


def _stripes(codes: np.ndarray, grams: np.ndarray, length: int, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Places where a phrase of ``length`` + 1 words may begin, their entry, and the entries' local prefixes and words."""
    at = np.flatnonzero((grams[:-1] >= 0) & (grams[1:] >= 0))
    keys, entry = np.unique(grams[at] * size + codes[at + length], return_inverse=True)
    return at, entry, keys // max(size, 1), keys % max(size, 1)


def _state(bucket: int, codes: np.ndarray, grams: np.ndarray | None, word_ids: np.ndarray, gram_ids: np.ndarray | None) -> pa.Table | None:
    """A row of STATE, without repeated gaps; None where no phrase is left. Phrases of one word are the words themselves."""
    if not len(word_ids if gram_ids is None else gram_ids):
        return None
    kept = np.flatnonzero((codes >= 0) | np.append(True, codes[:-1] >= 0))
    values = [bucket, len(kept), len(word_ids), packed(codes[kept]), None if grams is None else packed(grams[kept]), packed(word_ids), None if gram_ids is None else packed(gram_ids)]
    return pa.table({name.split()[0]: pa.array([v], pa.int64() if isinstance(v, int) else pa.binary()) for name, v in zip(STATE.split(", "), values)})


def _opened(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words and phrases in place, and their numbers."""
    codes, word_ids = unpacked(row["codes"]), unpacked(row["word_ids"])
    return (codes, codes, word_ids, word_ids) if row["grams"] is None else (codes, unpacked(row["grams"]), word_ids, unpacked(row["gram_ids"]))


def _from_words(row: dict, answers: pa.Table) -> pa.Table | None:
    ids, _ = told_words(row["places"], answers)
    new = np.append(np.where(ids >= 0, np.cumsum(ids >= 0) - 1, -1), -1)
    codes = new[unpacked(row["codes"])]
    ids = ids[ids >= 0]
    return _state(row["bucket"], codes, None, ids, None)


def _longer(length: int, shards: int):
    def take(row: dict, answers: pa.Table) -> pa.Table | None:
        codes, grams, word_ids, gram_ids = _opened(row)
        at, entry, prefix, word = _stripes(codes, grams, length, row["size"])
        ids, _ = told_pairs(gram_ids[prefix], word_ids[word], answers, shards)
        new = np.where(ids >= 0, np.cumsum(ids >= 0) - 1, -1)[entry]
        at, new = at[new >= 0], new[new >= 0]
        grams = np.full(len(codes), -1, np.int64)
        grams[at] = new
        alive = np.zeros(len(codes) + 1, np.int64)
        np.add.at(alive, at, 1)
        np.add.at(alive, at + length + 1, -1)
        return _state(row["bucket"], np.where(np.cumsum(alive)[:-1] > 0, codes, -1), grams, word_ids, ids[ids >= 0])

    return take


def _ask(length: int):
    def stripes(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        codes, grams, word_ids, gram_ids = _opened(row)
        at, entry, prefix, word = _stripes(codes, grams, length, row["size"])
        return gram_ids[prefix], word_ids[word], np.bincount(entry, minlength=len(prefix))

    return stripes


def _kept(answers: DataFrame, columns: list[str]) -> DataFrame:
    """The rows (id, f, ...) of the entries that shards keep; ``word`` comes of its two columns."""
    read = [c for name in columns for c in (["words", "word_lengths"] if name == "word" else [name])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                values = [apart(row["words"], row["word_lengths"]) if c == "word" else pa.array(unpacked(row[c])) for c in columns]
                yield pa.RecordBatch.from_arrays(values, columns)

    kinds = ", ".join(f"{c} {'binary' if c == 'word' else 'long'}" for c in columns)
    return answers.where("bucket is null").select(read).mapInArrow(run, kinds).withColumnRenamed("ids", "id").withColumnRenamed("totals", "f")


def frequent_phrases(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, lang: str = "lang", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(lang, words: array, f) of all phrases of up to ``longest`` words with f >= ``least``, and (lang, n) of all words."""
    rows = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).cast("binary").alias("lang"), whole_text(text).cast("binary").alias("text"))
    buckets = staged(word_buckets(rows), "word-buckets")
    totals = staged(buckets.select(F.explode(F.arrays_zip("langs", "lang_counts")).alias("x")).groupBy(F.col("x.langs").cast("string").alias("lang")).agg(F.sum("x.lang_counts").alias("n")), "words")
    shards = shards_for(buckets)
    answers = count_words(buckets, shards, least)
    known = _kept(answers, ["ids", "totals", "word"]).withColumn("word", F.col("word").cast("string"))
    # A language may hold spaces, a word may not.
    known = known.select("id", "f", F.regexp_replace("word", r"(?s) [^ ]*\z", "").alias("lang"), F.substring_index("word", " ", -1).alias("word"))
    known = staged(known, "frequent-words")
    level = known.select("id", "f", "lang", F.array("word").alias("words"))
    found = [level]
    state = staged(with_answers(buckets.select("bucket", "places", "codes"), answers, _from_words, STATE), "phrases-in-place")
    drop_staged(answers)
    drop_staged(buckets)
    for length in range(1, longest):
        shards = shards_for(state)
        answers = count_pairs(state, _ask(length), shards, least)
        pairs = _kept(answers, ["ids", "totals", "prefixes", "following"])
        words = known.select(F.col("id").alias("following"), "word")
        head = level.select(F.col("id").alias("prefixes"), "lang", "words")
        level = pairs.join(words, "following").join(head, "prefixes").select("id", "f", "lang", F.concat("words", F.array("word")).alias("words"))
        level = staged(level, "frequent-phrases")
        found.append(level)
        if length + 1 < longest:
            after = staged(with_answers(state, answers, _longer(length, shards), STATE), "phrases-in-place")
            drop_staged(answers)
            drop_staged(state)
            state = after
    all_levels = found[0]
    for level in found[1:]:
        all_levels = all_levels.unionByName(level)
    return all_levels.select("lang", "words", "f"), totals


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``top`` phrases by the score of their weakest cut."""
    phrases, totals = frequent_phrases(docs, least, longest)
    phrases = phrases.withColumn("phrase", F.array_join("words", " "))
    candidates = phrases.where(F.size("words") > 1).withColumnRenamed("f", "a")
    inner = candidates.where(F.size("words") > 2)
    size = F.size("words")
    parts = F.explode(F.array(F.slice("words", F.lit(1), size - 1), F.slice("words", F.lit(2), size - 1)))
    extended = inner.select("lang", parts.alias("part"), "a").groupBy("lang", F.array_join("part", " ").alias("phrase")).agg(F.max("a").alias("most"))
    own = candidates.join(extended, ["lang", "phrase"], "left").where("most is null or most < a").drop("most")
    cuts = own.withColumn("k", F.explode(F.sequence(F.lit(1), size - 1)))
    cuts = cuts.withColumn("first", F.array_join(F.slice("words", F.lit(1), F.col("k")), " ")).withColumn("rest", F.array_join(F.slice("words", F.col("k") + 1, size - F.col("k")), " "))
    counted = phrases.select("lang", "phrase", "f")
    cuts = cuts.join(counted.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l")), ["lang", "first"])
    cuts = cuts.join(counted.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"]).join(totals, "lang")
    scored = cuts.withColumn("score", F.expr("(cast(1000 as decimal(4,0)) * cast(a as decimal(16,0)) * cast(n as decimal(16,0))) div (cast(l as decimal(16,0)) * cast(r as decimal(16,0)))"))
    weakest = scored.groupBy("lang", "phrase").agg(F.min_by(F.struct("a", "l", "r", "n", "score"), F.struct("score", "k")).alias("x")).select("lang", "phrase", "x.*")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = weakest.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
