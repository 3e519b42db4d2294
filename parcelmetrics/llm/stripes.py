"""N-grams counted by stripes, exactly, without a vocabulary in one place.

Texts are dealt into buckets of some million bytes. A bucket numbers its own words and, length by length, its own n-grams.
Every prefix keys a stripe, the counter of the words that follow it; a bucket adds up its stripes before anything is sent.
Stripes are cut by following word and dealt over shards by a hash of prefix and word, so that the stripe of a frequent
prefix is never in one task, and entries come once a bucket however frequent they are. A shard merges the stripes of all
buckets elementwise, gives each entry that is frequent enough a number (its rank in the shard times the shards, plus the
shard), and answers every bucket in the order of its question: numbers and totals, no keys. The number of an n-gram is its
key as the prefix of the next length, so that no hash stands for a word or an n-gram.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelmetrics.llm.common import staged
from parcelmetrics.llm.tokens import runs

#: Bytes of text of a bucket, but for a longer single text, and entries aimed at in a shard.
BUCKET_BYTES, SHARD_ENTRIES = 3_000_000, 1_500_000

ANSWERS = "bucket long, shard int, ids binary, totals binary"
WORD_ANSWERS = f"{ANSWERS}, words binary, word_lengths binary"
#: What a bucket tells about its words: as bytes one after the other, in the order of their hashes, and the number of each.
WORDS = "words binary, word_lengths binary, places binary"
PAIR_ANSWERS = f"{ANSWERS}, prefixes binary, following binary"


def packed(values: np.ndarray) -> bytes:
    """Integers from -1 on, their 16-bit planes compressed; small numbers take little room."""
    planes = (np.asarray(values, np.int64) + 1).view("<u2").reshape(-1, 4).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), "<u2").reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<i8").ravel() - 1


def joined(words: list[bytes]) -> tuple[bytes, bytes]:
    """Words one after the other, and their lengths."""
    return zstandard.ZstdCompressor(level=3).compress(b"".join(words)), packed(np.fromiter(map(len, words), np.int64, len(words)))


def apart(words: bytes, lengths: bytes) -> pa.BinaryArray:
    offsets = np.concatenate([[0], np.cumsum(unpacked(lengths))]).astype(np.int32)
    data = zstandard.ZstdDecompressor().decompress(words) if words else b""
    return pa.BinaryArray.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def word_columns(words: list[bytes]) -> list[bytes]:
    """The columns WORDS for a bucket's words, which are numbered in the given order."""
    places = np.argsort(_hashes(words), kind="stable")
    return [*joined([words[k] for k in places.tolist()]), packed(places)]


class Numbers(dict):
    """Numbers of keys in the order of their first use."""

    def __missing__(self, key):
        n = self[key] = len(self)
        return n


def bucket_numbers() -> Iterator[int]:
    """Numbers that no other task has; a repeated task has the same."""
    first = TaskContext.get().partitionId() << 32
    return iter(range(first, first + (1 << 32)))


def by_frequency(codes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes renumbered by descending frequency (-1 stays), and the old number of each new one."""
    order = np.argsort(-np.bincount(codes[codes >= 0], minlength=size), kind="stable")
    new = np.empty(size + 1, np.int64)
    new[order], new[size] = np.arange(size), -1
    return new[codes], order


def shards_for(buckets: DataFrame) -> int:
    """Shards for as many entries as ``buckets`` has positions (column ``n``)."""
    total = buckets.agg(F.sum("n")).first()[0] or 0
    return max(buckets.sparkSession.sparkContext.defaultParallelism, -(-total // SHARD_ENTRIES))


def _hashes(words: Iterable[bytes]) -> np.ndarray:
    return np.fromiter(map(zlib.crc32, words), np.int64)


def _shard_of_pairs(prefixes: np.ndarray, following: np.ndarray, shards: int) -> np.ndarray:
    mixed = prefixes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + following.astype(np.uint64)
    mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return ((mixed ^ (mixed >> np.uint64(32))) % np.uint64(shards)).astype(np.int64)


def _dealt(shard: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Shards that occur, ascending, and the places of their entries."""
    order = np.argsort(shard, kind="stable")
    cuts = np.flatnonzero(np.diff(shard[order])) + 1
    for places in np.split(order, cuts) if len(order) else []:
        yield int(shard[places[0]]), places


def _in_shards(questions: DataFrame) -> DataFrame:
    return questions.repartition("shard").sortWithinPartitions("shard")


def _column(rows: pa.Table, name: str) -> list[np.ndarray]:
    return [unpacked(x) for x in rows.column(name).to_pylist()]


def _answers(rows: pa.Table, shard: int, shards: int, entries: np.ndarray, totals: np.ndarray, least: int, sizes: list[int]) -> tuple[np.ndarray, np.ndarray, list]:
    """Kept entries, numbers of all entries, and the answers to the rows, whose entries come one after the other."""
    kept = np.flatnonzero(totals >= least)
    ids = np.full(len(totals), -1, np.int64)
    ids[kept] = np.arange(len(kept)) * shards + shard
    cuts = np.cumsum(sizes)[:-1]
    told = [(packed(ids[own]), packed(totals[own])) for own in np.split(entries, cuts)]
    return kept, ids, list(zip(rows.column("bucket").to_pylist(), told))


def count_words(buckets: DataFrame, shards: int, least: int) -> DataFrame:
    """Answers for ``buckets`` (bucket, counts: packed, and WORDS), staged.

    A shard has a range of the words' hashes, in whose order a bucket lists its words. A row without bucket has a shard's
    words with totals of at least ``least``.
    """

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                words = apart(row["words"], row["word_lengths"]).to_pylist()
                counts, rows = unpacked(row["counts"])[unpacked(row["places"])], []
                for shard, places in _dealt((_hashes(words) * shards) >> 32):
                    rows.append((shard, row["bucket"], *joined(words[places[0] : places[-1] + 1]), packed(counts[places])))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], ["shard", "bucket", "words", "word_lengths", "counts"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in runs(batches, ["shard"]):
            shard = rows.column("shard")[0].as_py()
            lists = [apart(w, n) for w, n in zip(rows.column("words").to_pylist(), rows.column("word_lengths").to_pylist())]
            found = pa.concat_arrays(lists).dictionary_encode()
            entries = found.indices.to_numpy()
            totals = np.bincount(entries, np.concatenate(_column(rows, "counts")), len(found.dictionary)).astype(np.int64)
            kept, ids, told = _answers(rows, shard, shards, entries, totals, least, [len(x) for x in lists])
            out = [(None, shard, packed(ids[kept]), packed(totals[kept]), *joined(found.dictionary.take(pa.array(kept)).to_pylist()))]
            out += [(bucket, shard, *own, None, None) for bucket, own in told]
            types = [pa.int64(), pa.int32(), *[pa.binary()] * 4]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], ["bucket", "shard", "ids", "totals", "words", "word_lengths"])

    asked = buckets.select("bucket", "counts", *[c.split()[0] for c in WORDS.split(", ")])
    asked = asked.mapInArrow(ask, "shard int, bucket long, words binary, word_lengths binary, counts binary")
    return staged(_in_shards(asked).mapInArrow(merge, WORD_ANSWERS), "word-totals")


def count_pairs(buckets: DataFrame, stripes: Callable[[dict], tuple[np.ndarray, np.ndarray, np.ndarray]], shards: int, least: int) -> DataFrame:
    """Answers for the ``stripes`` of each row of ``buckets``: prefixes, following words, counts; staged.

    A row without bucket has a shard's entries with totals of at least ``least``.
    """

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                columns, rows = stripes(row), []
                for shard, places in _dealt(_shard_of_pairs(columns[0], columns[1], shards)):
                    rows.append((shard, row["bucket"], *[packed(c[places]) for c in columns]))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], ["shard", "bucket", "prefixes", "following", "counts"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in runs(batches, ["shard"]):
            shard = rows.column("shard")[0].as_py()
            parts = _column(rows, "prefixes")
            prefixes, following, counts = np.concatenate(parts), np.concatenate(_column(rows, "following")), np.concatenate(_column(rows, "counts"))
            heads, head = np.unique(prefixes, return_inverse=True)
            words, word = np.unique(following, return_inverse=True)
            keys, entries = np.unique(head * len(words) + word, return_inverse=True)
            totals = np.bincount(entries, counts, len(keys)).astype(np.int64)
            kept, ids, told = _answers(rows, shard, shards, entries, totals, least, [len(p) for p in parts])
            own = keys[kept]
            out = [(None, shard, packed(ids[kept]), packed(totals[kept]), packed(heads[own // len(words)]), packed(words[own % len(words)]))]
            out += [(bucket, shard, *answer, None, None) for bucket, answer in told]
            types = [pa.int64(), pa.int32(), *[pa.binary()] * 4]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], ["bucket", "shard", "ids", "totals", "prefixes", "following"])

    asked = buckets.mapInArrow(ask, "shard int, bucket long, prefixes binary, following binary, counts binary")
    return staged(_in_shards(asked).mapInArrow(merge, PAIR_ANSWERS), "pair-totals")


def _told(order: np.ndarray, answers: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Numbers and totals of a bucket's entries from the answers to it, which name them in the given order."""
    answers = answers.sort_by("shard")
    ids, totals = np.empty(len(order), np.int64), np.empty(len(order), np.int64)
    ids[order] = np.concatenate([np.zeros(0, np.int64), *_column(answers, "ids")])
    totals[order] = np.concatenate([np.zeros(0, np.int64), *_column(answers, "totals")])
    return ids, totals


def told_words(places: bytes, answers: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Numbers and totals of the words of a bucket with the column ``places``."""
    return _told(unpacked(places), answers)


def told_pairs(prefixes: np.ndarray, following: np.ndarray, answers: pa.Table, shards: int) -> tuple[np.ndarray, np.ndarray]:
    return _told(np.argsort(_shard_of_pairs(prefixes, following, shards), kind="stable"), answers)


def with_answers(buckets: DataFrame, answers: DataFrame, take: Callable[[dict, pa.Table], pa.Table | None], schema: str) -> DataFrame:
    """``take`` of each bucket's row and the answers to it; no rows where it gives None."""
    from pyspark.sql.pandas.types import to_arrow_schema

    kinds = to_arrow_schema(answers.sparkSession.createDataFrame([], schema).schema)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        made = take(left.to_pylist()[0], right) if left.num_rows else None
        return kinds.empty_table() if made is None else made.cast(kinds)

    told = answers.where("bucket is not null").select("bucket", "shard", "ids", "totals")
    return buckets.groupBy("bucket").cogroup(told.groupBy("bucket")).applyInArrow(run, schema)
