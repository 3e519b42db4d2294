"""Packing of tokenized documents into fixed windows by non-negative least squares.

Documents longer than the window are cut into full windows and a tail. The histogram of piece lengths goes to the driver
(at most one row for each length of the window). Pairs and triples of lengths that fill the window exactly are the columns
of a non-negative least squares problem; its solution says how often each combination repeats. Repeats are rounded down,
what is left is packed greedily, longest first, into the fullest place, again on the histogram. Every piece finds its slot
from its rank among the pieces of its length; ranks are counts of earlier parts plus the place in its own part.

Rows: null text counts as empty, a document without ids gives no piece; repeated rows are packed like any other; an empty
table gives no pieces. Only the columns named below are used.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcelmetrics.llm.common import staged, whole_text
from parcelmetrics.llm.tokens import byte_encoder, small_batches

WINDOW = 2048
#: Triples enumerated for each length, and rounds of the solver.
TRIPLES, ROUNDS = 8, 400


def cut_documents(docs: DataFrame, vocabulary_path: str, ranks_path: str, end_id: int, window: int = WINDOW, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Pieces of at most ``window`` ids: (doc_id, start, length, doc_tokens, ids as little-endian uint32, part, nth).

    ``part`` is the task, ``nth`` the place of the piece among those of its length there; stage the pieces before packing.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = byte_encoder(vocabulary_path, ranks_path)
        part, seen = TaskContext.get().partitionId(), np.zeros(window + 1, np.int64)
        for batch in small_batches(batches, "text"):
            counts, flat = encoder.encode(batch.column("text").to_pylist())
            flat = np.insert(flat, np.cumsum(counts), end_id).astype("<u4")
            counts = counts + 1
            pieces = (counts + window - 1) // window
            own = np.repeat(np.arange(len(counts)), pieces)
            start = (np.arange(len(own)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * window
            length = np.minimum(window, counts[own] - start)
            order = np.argsort(length, kind="stable")
            sorted_length = length[order]
            nth = np.empty(len(own), np.int64)
            nth[order] = np.arange(len(own)) - np.searchsorted(sorted_length, sorted_length) + seen[sorted_length]
            seen += np.bincount(length, minlength=window + 1)
            offsets = np.concatenate([[0], np.cumsum(length)]).astype(np.int32) * 4
            ids = pa.Array.from_buffers(pa.binary(), len(own), [None, pa.py_buffer(offsets), pa.py_buffer(flat)])
            columns = [batch.column("doc_id").take(pa.array(own)), pa.array(start), pa.array(length), pa.array(counts[own]), ids, pa.array(np.full(len(own), part, np.int32)), pa.array(nth)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "length", "doc_tokens", "ids", "part", "nth"])
        encoder.release()

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), whole_text(text).alias("text"))
    return rows.mapInArrow(cut, "doc_id long, start long, length long, doc_tokens long, ids binary, part int, nth long")


def combinations(window: int) -> np.ndarray:
    """Length combinations that fill the window, zero for no third: all pairs, and triples spread over each first length."""
    first = np.arange(1, window // 2 + 1)
    pairs = np.stack([first, window - first, np.zeros_like(first)], 1)
    a = np.repeat(np.arange(1, window - 1), TRIPLES)
    k = np.arange(len(a))
    b = 1 + (k * 0.6180339887498949 % 1 * (window - a - 1)).astype(np.int64)
    triples = np.stack([a, b, window - a - b], 1)
    triples = np.sort(triples[(triples > 0).all(1)], 1)[:, ::-1]
    return np.unique(np.concatenate([np.sort(pairs, 1)[:, ::-1], triples]), axis=0)


def least_squares(columns: np.ndarray, histogram: np.ndarray) -> np.ndarray:
    """Non-negative repeats x of the combinations that bring their lengths' sums near the histogram.

    Multiplicative updates, which keep x non-negative and never raise the squared error (Lee and Seung 2001).
    """
    size = len(histogram)
    target = histogram.astype(np.float64)
    target[0] = 0

    def lengths_of(x: np.ndarray) -> np.ndarray:
        out = np.bincount(columns.ravel(), np.repeat(x, 3), size)
        out[0] = 0
        return out

    gain = target[columns].sum(1)
    x = gain / 9
    for _ in range(ROUNDS):
        x *= gain / np.maximum(lengths_of(x)[columns].sum(1), 1e-12)
    return x


def plan(histogram: np.ndarray, window: int = WINDOW) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of a sequence, repeats): together exactly the pieces of ``histogram`` (index: length)."""
    left = histogram.astype(np.int64).copy()
    left[0] = 0
    found: list[tuple[tuple[int, ...], int]] = []

    def take(lengths: tuple[int, ...], most: int) -> None:
        kinds, need = np.unique(lengths, return_counts=True)
        n = min(most, int((left[kinds] // need).min()))
        if n > 0:
            left[kinds] -= n * need
            found.append((lengths, n))

    take((window,), int(left[window]))
    columns = combinations(window)
    columns = columns[((left[columns] > 0) | (columns == 0)).all(1)]
    repeats = np.floor(least_squares(columns, left) + 1e-6).astype(np.int64) if len(columns) else np.zeros(0, np.int64)
    for k in np.argsort(-repeats, kind="stable"):
        if repeats[k] > 0:
            take(tuple(int(x) for x in columns[k] if x), int(repeats[k]))
    lengths = list(np.flatnonzero(left)[::-1])  # longest first
    while lengths:
        sequence, room = [], window
        need: dict[int, int] = {}
        while room:
            fit = next((x for x in lengths if x <= room and left[x] > need.get(x, 0)), None)
            if fit is None:
                break
            sequence.append(int(fit))
            need[fit] = need.get(fit, 0) + 1
            room -= fit
        take(tuple(sequence), int(left[sequence[0]]))
        lengths = [x for x in lengths if left[x] > 0]
    return found


def pack(pieces: DataFrame, window: int = WINDOW) -> DataFrame:
    """``pieces`` (staged, with length, part, nth) with ``sequence_id`` and ``offset`` in place of part and nth.

    The slots are broadcast: their number depends on the window alone, not on the rows.
    """
    spark = pieces.sparkSession
    by_part = pieces.groupBy("part", "length").agg(F.count("*").alias("n"))
    histogram = np.zeros(window + 1, np.int64)
    for row in pieces.groupBy("length").agg(F.count("*").alias("n")).collect():  # at most one row for each length
        histogram[row.length] = row.n
    slots, base, used = [], 0, np.zeros(window + 1, np.int64)
    for lengths, repeats in plan(histogram, window):
        offset = 0
        for length in lengths:
            slots.append((length, int(used[length]), int(used[length]) + repeats, base, offset))
            used[length] += repeats
            offset += length
        base += repeats
    slot = spark.createDataFrame(slots, "length long, rank_from long, rank_to long, base long, offset long")
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ranks = by_part.withColumn("earlier", F.coalesce(F.sum("n").over(earlier), F.lit(0))).drop("n")
    ranked = pieces.join(ranks, ["part", "length"]).withColumn("rank", F.col("earlier") + F.col("nth"))
    placed = ranked.join(F.broadcast(slot), (ranked["length"] == slot["length"]) & (F.col("rank") >= F.col("rank_from")) & (F.col("rank") < F.col("rank_to"))).drop(slot["length"])
    placed = placed.withColumn("sequence_id", F.col("base") + F.col("rank") - F.col("rank_from"))
    return placed.drop("part", "nth", "earlier", "rank", "rank_from", "rank_to", "base")


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences themselves: (sequence_id, ids as little-endian uint32), at most a window of ids each."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.lit(b""), lambda a, x: F.concat(a, x["ids"]))
    return packed.groupBy("sequence_id").agg(joined.alias("ids"))


def packed_documents(docs: DataFrame, vocabulary_path: str, ranks_path: str, end_id: int) -> DataFrame:
    """Placed pieces of ``docs`` with a checksum of their ids; only the slim columns are staged and shuffled."""
    pieces = cut_documents(docs, vocabulary_path, ranks_path, end_id)
    slim = staged(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"), "pieces")
    return pack(slim).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
