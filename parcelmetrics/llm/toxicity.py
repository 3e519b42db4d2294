"""Toxicity by a classifier chain: each category's model also gets the probabilities of the categories before it.

Every model is a sparse logistic regression on the presence of words and of their first letters (stems matter in inflected
languages), hashed. Of these features the most telling by chi-square take part. A later model is trained with out-of-fold
probabilities of the earlier ones: the labelled rows are dealt into folds, and each fold is scored by a model of the other
folds, so that training sees what scoring will see. The models are fitted on at most about ``TRAINING_ROWS`` labelled
documents, drawn by a hash of the id; all documents are scored, and whole.

Rows: null text counts as empty and is scored like any other; labels that are null do not train, of several labels of an id
the largest counts; with no or only one class of labels the probability is the share of that class (0 without labels);
repeated rows are scored alike; an empty table gives no rows; other columns pass through, but for ones with the names of
the outputs, which are replaced.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelmetrics.llm.common import staged
from parcelmetrics.llm.tokens import SliceCache, int_lists, small_batches, summed

TRAINING_ROWS, FOLDS = 8_000, 3
FEATURES, SELECTED, STEMS = 1 << 20, 1000, (4, 6)
PENALTY, ITERATIONS = 2e-4, 80
THRESHOLD = 0.5
#: Text that a worker splits at a time; its words and their features take some twenty times as much.
TEXT_BYTES = 1_000_000

WORD = re.compile(r"[^\W_]+")


class Features:
    """Distinct hashed features of texts, all or only those that ``place`` (feature to column, -1: none) selects."""

    def __init__(self, place: np.ndarray | None = None):
        self._place = place
        self._cache = SliceCache(self._of_chunks)

    def _of_chunks(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        counts, found = [], []
        for chunk in chunks:
            terms = set()
            for word in WORD.findall(chunk.lower()):
                terms.add(word)
                terms.update(word[:n] + "*" for n in STEMS if len(word) > n)
            ids = [zlib.crc32(t.encode("utf-8", "surrogatepass")) % FEATURES for t in terms]
            if self._place is not None:
                ids = [k for k in self._place[ids].tolist() if k >= 0] if ids else []
            counts.append(len(ids))
            found += ids
        return np.array(counts, np.int64), np.array(found, np.int32)

    def of(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of distinct features, and these, of each text in turn."""
        chunks = [(t or "").split() for t in texts]
        counts = np.fromiter(map(len, chunks), np.int64, len(chunks))
        lengths, flat = self._cache.expand(self._cache.indices([c for own in chunks for c in own]))
        rows = np.repeat(np.arange(len(texts)), summed(lengths, counts))
        self._cache.trim()
        pairs = np.unique(rows * FEATURES + flat)
        return np.bincount(pairs // FEATURES, minlength=len(texts)), (pairs % FEATURES).astype(np.int32)


@dataclass
class Step:
    """A category's weights: of the selected features, of the earlier probabilities, and the constant."""

    name: str
    weights: np.ndarray
    chained: np.ndarray
    constant: float


def probabilities(step: Step, rows: np.ndarray, columns: np.ndarray, earlier: np.ndarray) -> np.ndarray:
    """Of as many texts as ``earlier`` (texts x earlier categories) has rows; features come as pairs of row and column."""
    z = np.bincount(rows, step.weights[columns], len(earlier)) + earlier @ step.chained + step.constant
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


class Sums:
    """Sums of values by group, the values given in ``order``."""

    def __init__(self, groups: np.ndarray, size: int):
        self.order = np.argsort(groups, kind="stable")
        counts = np.bincount(groups, minlength=size)
        self.some = np.flatnonzero(counts)
        self.starts, self.size = (np.cumsum(counts) - counts)[self.some], size

    def of(self, values: np.ndarray) -> np.ndarray:
        out = np.zeros(self.size)
        if len(self.some):
            out[self.some] = np.add.reduceat(values, self.starts)
        return out


def fit(name: str, size: int, rows: np.ndarray, columns: np.ndarray, earlier: np.ndarray, y: np.ndarray) -> Step:
    """Logistic regression with an L1 penalty by accelerated proximal gradients (Beck and Teboulle 2009)."""
    n, k = earlier.shape
    if n == 0 or y.min() == y.max():
        constant = 0.0 if n == 0 else float(y[0])
        return Step(name, np.zeros(size), np.zeros(k), 500.0 if constant else -500.0)
    share = y.mean()
    w = np.zeros(size + k + 1)
    w[-1] = np.log(share / (1 - share))
    ahead, pace, rate = w.copy(), 1.0, 1.0

    by_row, by_column = Sums(rows, n), Sums(columns, size)
    columns, rows = columns[by_row.order], rows[by_column.order]

    def margin(v: np.ndarray) -> np.ndarray:
        return by_row.of(v[columns]) + earlier @ v[size:-1] + v[-1]

    def loss(z: np.ndarray) -> float:
        return float(np.mean(np.logaddexp(0, z) - y * z))

    for _ in range(ITERATIONS):
        z = margin(ahead)
        residual = (1 / (1 + np.exp(-np.clip(z, -500, 500))) - y) / n
        gradient = np.concatenate([by_column.of(residual[rows]), earlier.T @ residual, [residual.sum()]])
        base = loss(z)
        while True:
            new = ahead - rate * gradient
            new[:-1] = np.sign(new[:-1]) * np.maximum(np.abs(new[:-1]) - rate * PENALTY, 0)
            step = new - ahead
            if loss(margin(new)) <= base + gradient @ step + step @ step / (2 * rate) + 1e-12:
                break
            rate /= 2
        quicker = (1 + np.sqrt(1 + 4 * pace**2)) / 2
        ahead = new + (pace - 1) / quicker * (new - w)
        w, pace, rate = new, quicker, rate * 1.2
    return Step(name, w[:size], w[size:-1], float(w[-1]))


@dataclass
class Chain:
    """Columns of the selected features, and the steps in order."""

    place: np.ndarray
    steps: list[Step]


def fit_chain(docs: DataFrame, labels: DataFrame, categories: list[str], training_rows: int = TRAINING_ROWS, folds: int = FOLDS) -> Chain:
    """Models for ``categories`` (0/1 columns of ``labels``, joined by doc_id) in that order."""
    labelled = labels.where("doc_id is not null").groupBy("doc_id").agg(*[F.max(c).cast("int").alias(c) for c in categories]).dropna()
    share = min(1.0, training_rows / max(1, labelled.count()))
    chosen = labelled.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < round(share * 1_000_000))
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(chosen, "doc_id")

    def featurize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        for batch in small_batches(batches, "text", TEXT_BYTES):
            made = int_lists(*features.of(batch.column("text").to_pylist()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *[batch.column(c) for c in categories], made], ["doc_id", *categories, "features"])

    kinds = ", ".join(f"`{c}` int" for c in categories)
    training = staged(rows.mapInArrow(featurize, f"doc_id long, {kinds}, features array<int>"), "training")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((1 + len(categories), FEATURES), np.int64)
        for batch in batches:
            lengths = np.array([len(x) for x in batch.column("features")], np.int64)
            flat = batch.column("features").flatten().to_numpy()
            total[0] += np.bincount(flat, minlength=FEATURES)
            for k, c in enumerate(categories, 1):
                positive = np.repeat(batch.column(c).to_numpy() > 0, lengths)
                total[k] += np.bincount(flat[positive], minlength=FEATURES)
        used = np.flatnonzero(total[0])
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), *[pa.array(t[used]) for t in total]], ["feature", "n", *[f"n_{k}" for k in range(len(categories))]])

    counted = training.mapInArrow(count, "feature int, n long, " + ", ".join(f"n_{k} long" for k in range(len(categories))))
    counted = staged(counted.groupBy("feature").agg(*[F.sum(c).alias(c) for c in counted.columns[1:]]), "features")
    size = training.count()
    place = np.full(FEATURES, -1, np.int32)
    telling: set[int] = set()
    for k, c in enumerate(categories):
        positive = training.where(F.col(c) > 0).count()
        expected = F.col("n") * positive / max(1, size)
        chi = (F.col(f"n_{k}") - expected) ** 2 / (expected + 1)
        telling.update(r.feature for r in counted.orderBy(chi.desc(), "feature").limit(SELECTED).collect())
    place[sorted(telling)] = np.arange(len(telling))

    def select(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = np.array([len(x) for x in batch.column("features")], np.int64)
            flat = place[batch.column("features").flatten().to_numpy()]
            made = int_lists(summed((flat >= 0).astype(np.int64), lengths), flat[flat >= 0])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *[batch.column(c) for c in categories], made], ["doc_id", *categories, "features"])

    # Bounded by the training rows and the selected features.
    known = training.mapInArrow(select, training.schema).toPandas().sort_values("doc_id", kind="stable")
    counts = np.array([len(x) for x in known["features"]], np.int64)
    columns = np.concatenate([np.asarray(x, np.int64) for x in known["features"]]) if len(known) else np.zeros(0, np.int64)
    row_of = np.repeat(np.arange(len(known)), counts)
    fold = np.arange(len(known)) % folds
    earlier, steps = np.zeros((len(known), 0)), []

    def part(inside: np.ndarray, name: str, y: np.ndarray) -> Step:
        at, own = np.cumsum(inside) - 1, inside[row_of]
        return fit(name, len(telling), at[row_of[own]], columns[own], earlier[inside], y[inside])

    for name in categories:
        y = known[name].to_numpy(np.float64)
        steps.append(part(np.ones(len(known), bool), name, y))
        if name != categories[-1]:
            held_out = np.zeros(len(known))
            for f in range(folds):
                own = part(fold != f, name, y)
                held_out[fold == f] = probabilities(own, row_of, columns, earlier)[fold == f]
            earlier = np.column_stack([earlier, held_out])
    return Chain(place, steps)


def score(docs: DataFrame, chain: Chain, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with ``p_<category>`` for every category, and ``toxic``, whether the last one reaches ``threshold``."""
    made = [*[f"p_{s.name}" for s in chain.steps], "toxic"]
    docs = docs.drop(*[c for c in docs.columns if c.lower() in {m.lower() for m in made}])
    schema = T.StructType([*docs.schema.fields, *[T.StructField(m, T.DoubleType()) for m in made[:-1]], T.StructField("toxic", T.BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features(chain.place)
        for batch in small_batches(batches, "text", TEXT_BYTES):
            counts, columns = features.of(batch.column("text").to_pylist())
            rows = np.repeat(np.arange(len(counts)), counts)
            earlier = np.zeros((len(counts), 0))
            for step in chain.steps:
                earlier = np.column_stack([earlier, probabilities(step, rows, columns, earlier)])
            toxic = earlier[:, -1] >= threshold
            yield pa.RecordBatch.from_arrays([*batch.columns, *[pa.array(p) for p in earlier.T], pa.array(toxic)], [*batch.schema.names, *made])

    return docs.mapInArrow(run, schema)


def toxic_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` scored by the chain low quality, then toxic."""
    return score(docs, fit_chain(docs, labels.select("doc_id", (1 - F.col("quality")).alias("low_quality"), F.col("toxic")), ["low_quality", "toxic"]))
