"""Language-model scoring by a weighted backoff automaton over words.

The model: bigrams, smoothed by a Dirichlet prior of strength ``PRIOR`` on the unigrams, and these by adding 0.1 to every
count, with one unknown word. As an automaton: a state for each word that training holds and one for no history; an arc
for every trained bigram, with weight log10((c(hw) + m p(w)) / (c(h) + m)); from every state a failure arc of weight
log10(m / (c(h) + m)) to the state without history, which has an arc for every word. Weights of arcs and of failures
sum to one at every state. A document starts in the state of the end token and is read once from left to right.

Counts are those of the whole training part, without cut-offs, gathered by stripes (see ``stripes``). No task holds the
whole automaton: a bucket of documents asks for the counts of its own words and bigrams, and builds the part that its texts
can reach.

Rows: null text counts as empty, an empty text has its end token only; a null id counts as the empty id, whose remainder
is 0; repeated rows train and are scored each; without training rows every probability is that of the unknown word; an
empty table gives no rows; a text of any length is one document of its bucket; only the named columns are used.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelmetrics.llm.common import drop_staged, staged, whole_text
from parcelmetrics.llm.stripes import (
    BUCKET_BYTES,
    WORDS,
    Numbers,
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
from parcelmetrics.llm.tokens import small_batches, summed

#: Strength of the prior in tokens, what is added to each unigram count, and the folds of which one is held out.
PRIOR, ADDED, FOLDS = 250.0, 0.1, 10

#: No word holds a line feed.
END = b"\n"

DOCUMENTS = "ids array<long>, lengths binary, held_out array<boolean>"
SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def held_out(doc_id: int | None, folds: int = FOLDS) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % folds == 0


class Automaton:
    """The part of the automaton for words 0..n-1, of which 0 is the end token.

    ``counts`` are the words' training counts; ``prefixes``, ``following`` and ``pair_counts`` the trained bigrams.
    """

    def __init__(self, counts: np.ndarray, total: int, distinct: int, prefixes: np.ndarray, following: np.ndarray, pair_counts: np.ndarray, prior: float = PRIOR):
        self.size = len(counts)
        self.known = counts > 0
        share = (counts + ADDED) / (total + ADDED * (distinct + 1))
        self.unigram = np.log10(share)
        # The state of word w is w + 1; a word without training has the state 0, of no history.
        self.state = np.where(self.known, np.arange(self.size) + 1, 0)
        self.failure = np.concatenate([[0.0], np.log10(prior / (counts + prior))])
        weights = np.log10((pair_counts + prior * share[following]) / (counts[prefixes] + prior))
        self.arcs = dict(zip(((prefixes + 1) * self.size + following).tolist(), weights.tolist()))

    def scores(self, words: np.ndarray, lengths: np.ndarray) -> list[float]:
        """Log10 probabilities of documents, each given by its words and the end token."""
        arcs, size = self.arcs, self.size
        failure, unigram, state_of = self.failure.tolist(), self.unigram.tolist(), self.state.tolist()
        out, at, words = [], 0, words.tolist()
        for length in lengths.tolist():
            state, score = state_of[0], 0.0
            for word in words[at : at + length]:
                weight = arcs.get(state * size + word)
                score += failure[state] + unigram[word] if weight is None else weight
                state = state_of[word]
            out.append(score)
            at += length
        return out


def document_buckets(docs: DataFrame, folds: int = FOLDS) -> DataFrame:
    """(bucket, n, WORDS, counts, codes, ...) of (doc_id, text: binary): codes of words and end tokens, training counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = bucket_numbers()
        for batch in small_batches(batches, "text", BUCKET_BYTES):
            found, codes = Numbers({END: 0}), []
            ids = batch.column("doc_id").to_pylist()
            for text in batch.column("text").to_pylist():
                words = text.lower().split()
                codes.append(np.fromiter(map(found.__getitem__, words), np.int64, len(words)))
            end = np.zeros(1, np.int64)
            lengths = np.array([len(c) + 1 for c in codes], np.int64)
            flat = np.concatenate([x for c in codes for x in (c, end)])
            out = np.array([held_out(i, folds) for i in ids])
            train = np.repeat(~out, lengths)
            # The end token stays number 0.
            rest, order = by_frequency(flat - 1, len(found) - 1)
            flat, keys = rest + 1, list(found)
            counts = np.bincount(flat, train, len(found)).astype(np.int64)
            words = [END, *[keys[k + 1] for k in order.tolist()]]
            values = [
                pa.array([next(numbers)]),
                pa.array([len(flat)]),
                *[pa.array([c], pa.binary()) for c in word_columns(words)],
                pa.array([packed(counts)], pa.binary()),
                pa.array([packed(flat)], pa.binary()),
                pa.array([ids], pa.list_(pa.int64())),
                pa.array([packed(lengths)], pa.binary()),
                pa.array([out.tolist()], pa.list_(pa.bool_())),
            ]
            yield pa.RecordBatch.from_arrays(values, ["bucket", "n", "words", "word_lengths", "places", "counts", "codes", "ids", "lengths", "held_out"])

    return docs.mapInArrow(run, f"bucket long, n long, {WORDS}, counts binary, codes binary, {DOCUMENTS}")


def _pairs(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Local prefixes, following words and training counts of the bigrams whose words both occur in training."""
    codes, totals, lengths = unpacked(row["codes"]), unpacked(row["totals"]), unpacked(row["lengths"])
    before = np.concatenate([np.zeros(1, np.int64), codes[:-1]])
    train = np.repeat(~np.array(row["held_out"]), lengths)
    known = totals > 0
    own = known[before] & known[codes]
    keys, entry = np.unique(before[own] * len(totals) + codes[own], return_inverse=True)
    return keys // len(totals), keys % len(totals), np.bincount(entry, train[own], len(keys)).astype(np.int64)


def _ask(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    prefixes, following, counts = _pairs(row)
    ids = unpacked(row["word_ids"])
    return ids[prefixes], ids[following], counts


def score(docs: DataFrame, prior: float = PRIOR, folds: int = FOLDS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), whole_text(text).cast("binary").alias("text"))
    buckets = staged(document_buckets(rows, folds), "document-buckets")
    shards = shards_for(buckets)
    answers = count_words(buckets, shards, 1)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            totals = [unpacked(t) for t in batch.column("totals").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([int(t.sum()) for t in totals], pa.int64()), pa.array([len(t) for t in totals], pa.int64())], ["n", "v"])

    sums = answers.where("bucket is null").select("totals").mapInArrow(counted, "n long, v long").agg(F.sum("n"), F.sum("v")).first()
    total, distinct = sums[0] or 0, sums[1] or 0

    def with_words(row: dict, told: pa.Table) -> pa.Table:
        ids, totals = told_words(row["places"], told)
        one = {"bucket": [row["bucket"]], "codes": [row["codes"]], "word_ids": [packed(ids)], "totals": [packed(totals)]}
        return pa.table(one | {c: [row[c]] for c in ("ids", "lengths", "held_out")})

    own = buckets.drop("counts", "n", "words", "word_lengths")
    known = staged(with_answers(own, answers, with_words, f"bucket long, codes binary, word_ids binary, totals binary, {DOCUMENTS}"), "document-words")
    drop_staged(answers)
    drop_staged(buckets)
    pairs = count_pairs(known, _ask, shards, 1)

    def read(row: dict, told: pa.Table) -> pa.Table:
        codes, lengths, counts, ids = (unpacked(row[c]) for c in ("codes", "lengths", "totals", "word_ids"))
        prefixes, following, _ = _pairs(row)
        _, pair_counts = told_pairs(ids[prefixes], ids[following], told, shards)
        seen = pair_counts > 0
        automaton = Automaton(counts, total, distinct, prefixes[seen], following[seen], pair_counts[seen], prior)
        ends = np.cumsum(lengths) - lengths
        return pa.table(
            {
                "doc_id": row["ids"],
                "held_out": row["held_out"],
                "n_tokens": lengths,
                "n_known": summed(automaton.known[codes].astype(np.int64), lengths),
                "train_tokens": np.full(len(lengths), total, np.int64),
                "base_score": np.add.reduceat(automaton.unigram[codes], ends),
                "score": automaton.scores(codes, lengths),
            }
        )

    # A bucket without a trained bigram asks for nothing, and is read all the same, without answers.
    return with_answers(known, pairs, read, SCORES)
