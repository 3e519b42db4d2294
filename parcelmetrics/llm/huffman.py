"""Token-id files: canonical length-limited Huffman codes from global counts, decoded by table from checkpoints.

A set of files is a folder with two Parquet tables. ``codes`` has the code length of each id; canonical codes follow from
the lengths. ``blocks`` has rows of about ``BLOCK_BYTES`` of code bits of whole documents in ascending document id: their
ids, numbers of tokens, byte-aligned bit strings, and the bit offset of every ``STEP``-th token. Blocks are independent,
and a reader decodes from all checkpoints of a block side by side.

Rows: null text counts as empty and still gets the end id; a null document id sorts first; rows with the same id each
keep a place, in the order of their text; an empty table gives files without rows; other columns are not written. A
document of any length lies in one block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelmetrics.llm.common import drop_staged, scratch_path, whole_text
from parcelmetrics.llm.tokens import byte_encoder, small_batches, summed

STEP = 256
BLOCK_BYTES = 1 << 20
MAX_BITS = 16


def code_lengths(counts: np.ndarray, most: int = MAX_BITS) -> np.ndarray:
    """Optimal code lengths of at most ``most`` bits for positive counts, by package-merge (Larmore and Hirschberg 1990)."""
    n = len(counts)
    if n <= 1:
        return np.ones(n, np.int64)
    most = max(most, int(np.ceil(np.log2(n))))
    order = np.argsort(counts, kind="stable")
    weights = counts[order].astype(np.float64)
    leaves, packages = [], np.zeros(0)
    for _ in range(most):
        merged = np.concatenate([weights, packages])
        rank = np.argsort(merged, kind="stable")
        leaves.append(rank < n)
        merged = merged[rank]
        packages = merged[0 : len(merged) // 2 * 2 : 2] + merged[1::2]
    lengths, taken = np.zeros(n, np.int64), 2 * n - 2
    for is_leaf in reversed(leaves):
        own = int(is_leaf[:taken].sum())
        lengths[:own] += 1
        taken = 2 * (taken - own)
    out = np.empty(n, np.int64)
    out[order] = lengths
    return out


class Code:
    """Canonical code: shorter codes first, equal lengths by id."""

    def __init__(self, ids: np.ndarray, lengths: np.ndarray):
        order = np.lexsort((ids, lengths))
        ids, lengths = ids[order], lengths[order]
        self.bits = int(lengths.max(initial=1))
        size = 1 << (self.bits - lengths)  # the share of the table that begins with each code
        first = np.cumsum(size) - size
        vocabulary = int(ids.max(initial=0)) + 1
        self.length, self.code = np.zeros(vocabulary, np.int64), np.zeros(vocabulary, np.uint64)
        self.length[ids] = lengths
        self.code[ids] = (first >> (self.bits - lengths)).astype(np.uint64)
        self.table_id, self.table_length = np.zeros(1 << self.bits, np.int32), np.ones(1 << self.bits, np.int64)
        self.table_id[: size.sum()] = np.repeat(ids, size)
        self.table_length[: size.sum()] = np.repeat(lengths, size)

    def encode(self, counts: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Bytes, byte counts of documents of ``counts`` ids each, numbers of checkpoints, and checkpoints in bits."""
        lengths = self.length[ids]
        ends = np.cumsum(lengths)
        at = ends - lengths
        sizes = (summed(lengths, counts) + 7) // 8
        first = np.cumsum(counts) - counts  # of each document's ids
        filled = counts > 0
        begin = np.zeros(len(counts), np.int64)
        begin[filled] = at[first[filled]]
        inside = at - np.repeat(begin, counts)
        at = inside + np.repeat(8 * (np.cumsum(sizes) - sizes), counts)
        words = np.zeros(int(sizes.sum()) // 4 + 3, np.uint64)
        if len(ids):
            placed = self.code[ids] << (64 - (at & 31) - lengths).astype(np.uint64)
            word = at >> 5
            cuts = np.append(0, np.flatnonzero(np.diff(word)) + 1)
            words[word[cuts]] += np.add.reduceat(placed >> np.uint64(32), cuts)
            words[word[cuts] + 1] += np.add.reduceat(placed & np.uint64(0xFFFFFFFF), cuts)
        coded = words.astype(">u4").view(np.uint8)[: int(sizes.sum())]
        marks = (counts + STEP - 1) // STEP
        nth = np.arange(int(marks.sum())) - np.repeat(np.cumsum(marks) - marks, marks)
        return coded, sizes, marks, inside[np.repeat(first, marks) + nth * STEP]

    def decode(self, coded: np.ndarray, sizes: np.ndarray, counts: np.ndarray, checkpoints: np.ndarray) -> np.ndarray:
        """The ids of documents of ``counts`` ids in ``sizes`` bytes each, from all checkpoints side by side."""
        padded = np.concatenate([coded, np.zeros(4, np.uint8)]).astype(np.uint32)
        window = padded[:-3] << 24 | padded[1:-2] << 16 | padded[2:-1] << 8 | padded[3:]
        marks = (counts + STEP - 1) // STEP
        nth = np.arange(int(marks.sum())) - np.repeat(np.cumsum(marks) - marks, marks)
        at = checkpoints + 8 * np.repeat(np.cumsum(sizes) - sizes, marks)
        out_at = np.repeat(np.cumsum(counts) - counts, marks) + nth * STEP
        todo = np.minimum(STEP, np.repeat(counts, marks) - nth * STEP)
        order = np.argsort(-todo, kind="stable")
        at, out_at, todo = at[order], out_at[order], todo[order]
        out = np.zeros(int(counts.sum()), np.int32)
        shift, mask = 32 - self.bits, (1 << self.bits) - 1
        for step in range(int(todo.max(initial=0))):
            active = int(np.searchsorted(-todo, -step, side="left"))
            now = at[:active]
            code = (window[now >> 3] >> (shift - (now & 7)).astype(np.uint32)) & mask
            out[out_at[:active] + step] = self.table_id[code]
            at[:active] += self.table_length[code]
        return out


def _packed(counts: np.ndarray, flat: np.ndarray, width: str = "<u4") -> pa.Array:
    raw = flat.astype(width)
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64) * raw.itemsize
    return pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(raw)])


def write_ids(docs: DataFrame, path: str, vocabulary_path: str, ranks_path: str, end_id: int, text: str = "text", doc_id: str = "doc_id") -> None:
    """Encode ``docs`` (``doc_id`` long, ``text``) with ``end_id`` after each document and write the files at ``path``.

    The ids are staged once in input order, with a row of each task's counts beside them; the counts give the code, and what is
    shuffled into document order is already coded.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), whole_text(text).alias("text"))

    def tokenize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = byte_encoder(vocabulary_path, ranks_path)
        total = np.zeros(0, np.int64)
        names = ["doc_id", "tie", "ids", "used", "n"]
        for batch in small_batches(batches, "text"):
            counts, flat = encoder.encode(batch.column("text").to_pylist())
            flat = np.insert(flat, np.cumsum(counts), end_id)
            own = np.bincount(flat)
            total = np.pad(total, (0, max(0, len(own) - len(total))))
            total[: len(own)] += own
            none = pa.nulls(batch.num_rows, pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("tie"), _packed(counts + 1, flat), none, none], names)
        encoder.release()
        used = np.flatnonzero(total)
        if len(used):
            kinds = [pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64())]
            row = [None, None, None, used.tolist(), total[used].tolist()]
            yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], names)

    staging = scratch_path(spark, "token-ids")
    # Rows with the same id are told apart by a hash of their text.
    layout = "doc_id long, tie long, ids binary, used array<long>, n array<long>"
    tokenized = rows.withColumn("tie", F.xxhash64("text")).mapInArrow(tokenize, layout)
    tokenized.write.option("compression", "zstd").parquet(staging)
    staged_ids = spark.read.schema(layout).parquet(staging)
    ids = staged_ids.where("used IS NULL").select("doc_id", "tie", "ids")

    # At most one row for each id of the vocabulary.
    each = staged_ids.where("used IS NOT NULL").select(F.explode(F.arrays_zip("used", "n")).alias("x")).select("x.used", "x.n")
    counted = each.groupBy(F.col("used").alias("id")).agg(F.sum("n").alias("n")).toPandas()
    used, lengths = counted["id"].to_numpy(np.int64), code_lengths(counted["n"].to_numpy(np.int64))
    codes = spark.createDataFrame(list(zip(used.tolist(), lengths.tolist())), "id int, length int")
    codes.coalesce(1).write.parquet(f"{path}/codes")

    # Borders of document ids: one part for each shuffle partition.
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    borders = ids.select(F.percentile_approx("doc_id", [k / parts for k in range(1, parts)] or [0.5], 10 * parts)).first()[0]
    borders = sorted(set(borders or []))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = Code(used, lengths)
        for batch in small_batches(batches, "ids"):
            raw = batch.column("ids").to_pylist()
            counts = np.array([len(x) // 4 for x in raw], np.int64)
            coded, sizes, marks, checkpoints = code.encode(counts, np.frombuffer(b"".join(raw), "<u4"))
            keys = batch.column("doc_id").to_numpy(zero_copy_only=False)
            part = np.where(batch.column("doc_id").is_null().to_numpy(zero_copy_only=False), 0, np.searchsorted(np.array(borders, np.float64), np.nan_to_num(keys.astype(np.float64)), side="left"))
            columns = [pa.array(part.astype(np.int32)), batch.column("doc_id"), batch.column("tie"), pa.array(counts), _packed(sizes, coded, "u1"), _packed(marks, checkpoints)]
            yield pa.RecordBatch.from_arrays(columns, ["part", "doc_id", "tie", "n", "bits", "checkpoints"])

    coded = ids.mapInArrow(encode, "part int, doc_id long, tie long, n long, bits binary, checkpoints binary")
    in_order = coded.repartitionById(len(borders) + 1, F.col("part")).sortWithinPartitions("part", "doc_id", "tie")

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, block, start, held, size = -1, 0, 0, [], 0

        def row() -> pa.RecordBatch:
            doc_ids, counts, bits, marks = (list(x) for x in zip(*held))
            values = [[part], [block], [start], [doc_ids], [counts], [[len(b) for b in bits]], [b"".join(bits)], [b"".join(marks)]]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(), pa.binary()]
            names = ["part", "block", "start_in_part", "doc_ids", "counts", "sizes", "bits", "checkpoints"]
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds)], names)

        for batch in batches:
            for p, *document in zip(*(batch.column(c).to_pylist() for c in ("part", "doc_id", "n", "bits", "checkpoints"))):
                if held and (p != part or size + len(document[2]) > BLOCK_BYTES):
                    yield row()
                    block, start, held, size = block + 1, start + sum(d[1] for d in held), [], 0
                if p != part:
                    part, block, start = p, 0, 0
                held.append(document)
                size += len(document[2])
        if held:
            yield row()

    layout = "part int, block int, start_in_part long, doc_ids array<long>, counts array<long>, sizes array<long>, bits binary, checkpoints binary"
    in_order.mapInArrow(blocks, layout).write.parquet(f"{path}/blocks")
    drop_staged(staged_ids)


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """The documents of the files at ``path``: (doc_id, start: ids of all before, n_tokens, ids as little-endian uint32)."""
    codes = spark.read.parquet(f"{path}/codes").toPandas()  # a row for each id of the vocabulary
    used, lengths = codes["id"].to_numpy(np.int64), codes["length"].to_numpy(np.int64)
    blocks = spark.read.parquet(f"{path}/blocks")
    # One row for each part, and as many parts as the writer had shuffle partitions.
    totals = blocks.groupBy("part").agg(F.sum(F.aggregate("counts", F.lit(0).cast("long"), lambda a, x: a + x)).alias("n")).orderBy("part").collect()
    before, begin = {}, 0
    for row in totals:
        before[row.part], begin = begin, begin + row.n

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = Code(used, lengths)
        for batch in batches:
            for k in range(batch.num_rows):
                part, begin, doc_ids, counts, sizes, bits, marks = (batch.column(c)[k] for c in ("part", "start_in_part", "doc_ids", "counts", "sizes", "bits", "checkpoints"))
                counts = counts.values.to_numpy(zero_copy_only=False).astype(np.int64)
                sizes = sizes.values.to_numpy(zero_copy_only=False).astype(np.int64)
                ids = code.decode(np.frombuffer(bits.as_py(), np.uint8), sizes, counts, np.frombuffer(marks.as_py(), "<u4").astype(np.int64))
                start = before[part.as_py()] + begin.as_py() + np.cumsum(counts) - counts
                yield pa.RecordBatch.from_arrays([doc_ids.values, pa.array(start), pa.array(counts), _packed(counts, ids)], ["doc_id", "start", "n_tokens", "ids"])

    return blocks.drop("block").mapInArrow(decode, "doc_id long, start long, n_tokens long, ids binary")
