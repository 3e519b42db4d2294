"""Near-duplicate embeddings: random-hyperplane sign hashing in several tables, exact cosines, connected components.

Equal vectors become one with a count. Signs against random hyperplanes (Charikar 2002) give each vector a key in every
table; the number of signs grows with the logarithm of the rows, so that buckets keep their size, and the number of tables
follows from the recall wanted at the threshold. In a bucket all pairs are compared as one matrix product; a pair counts in
the first table where it meets, so links are summed without listing pairs, and each bucket passes on a forest of its links,
a row for each linked vector. Large buckets are cut in blocks, and blocks meet in pairs.

Rows: a vector that is null, zero, or has null or non-finite components links with nothing; vectors of other lengths do not
meet; repeated rows are vectors of their own; a null id keeps its row, without component; an empty table gives no rows;
only the named columns are used.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelmetrics.llm.common import components, staged

THRESHOLD, RECALL = 0.9, 0.97
#: Vectors of a bucket aimed at, and of a block at most.
BUCKET, BLOCK = 16, 1024


def tables_for(rows: int, threshold: float, recall: float = RECALL) -> tuple[int, int]:
    """(signs of a key, tables): a pair at the threshold meets in some table with probability ``recall``."""
    signs = min(30, max(4, math.ceil(math.log2(max(rows, 2) / BUCKET))))
    agree = (1 - math.acos(threshold) / math.pi) ** signs
    return signs, math.ceil(math.log(1 - recall) / math.log(1 - agree))


def forest(linked: np.ndarray) -> np.ndarray:
    """For each vertex of a symmetric adjacency matrix the least vertex that it reaches."""
    label = np.arange(len(linked))
    while True:
        least = np.minimum(label, np.where(linked, label[None, :], len(label)).min(1))
        least = least[least]
        if (least == label).all():
            return label
        label = least


def _bucket(ids: np.ndarray, copies: np.ndarray, vectors: np.ndarray, keys: np.ndarray, table: int, side: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Linked ids, their numbers of links first met here, and the least linked id that each reaches.

    ``side`` is 0 for all rows of one block, or parts two blocks of which only pairs across count.
    """
    # The largest component is taken out first, so that no norm overflows or vanishes.
    unit = vectors / abs(vectors).max(1)[:, None]
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    linked = unit @ unit.T >= threshold
    np.fill_diagonal(linked, False)
    if side.any():
        linked &= side[:, None] != side[None, :]
    for earlier in range(table):
        linked &= keys[:, earlier][:, None] != keys[:, earlier][None, :]
    some = np.flatnonzero(linked.any(1))
    linked = linked[np.ix_(some, some)]
    order = np.argsort(ids[some], kind="stable")
    some, linked = some[order], linked[np.ix_(order, order)]
    return ids[some], linked @ copies[some], ids[some][forest(linked)] if len(some) else ids[some]


def links(vectors: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL, block: int = BLOCK) -> DataFrame:
    """(vec_id, n, root) for ``vectors`` (vec_id, copies, embedding: array<double>, distinct): sums of links and a forest.

    A vector has a row for each bucket where it has links that no earlier table has.
    """
    signs, tables = tables_for(vectors.count(), threshold, recall)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = batch.column("embedding").to_pylist()
            keys = np.zeros((len(vectors), tables), np.int64)
            lengths = np.array([len(v) for v in vectors])
            for size in np.unique(lengths):
                if size not in planes:
                    planes[size] = np.random.default_rng([tables, signs, int(size)]).standard_normal((int(size), tables * signs))
                rows = np.flatnonzero(lengths == size)
                own = np.array([vectors[k] for k in rows])
                positive = own / abs(own).max(1)[:, None] @ planes[size] > 0
                keys[rows] = positive.reshape(len(rows), tables, signs) @ (1 << np.arange(signs))
            flat = pa.array(keys.ravel())
            offsets = pa.array(np.arange(len(vectors) + 1, dtype=np.int32) * tables)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.ListArray.from_arrays(offsets, flat)], [*batch.schema.names, "keys"])

    signed = staged(vectors.mapInArrow(sign, "vec_id long, copies long, embedding array<double>, keys array<long>"), "signed")
    met = signed.select("*", F.size("embedding").alias("dim"), F.posexplode("keys").alias("table", "key"))
    bucket = ["dim", "table", "key"]
    counts = signed.select(F.size("embedding").alias("dim"), F.posexplode("keys").alias("table", "key")).groupBy(bucket).agg(F.count("*").alias("n"))
    large = counts.where(F.col("n") > block).select(*bucket, F.ceil(F.col("n") / (block // 2)).cast("int").alias("blocks"))
    shared = counts.where(F.col("n") > 1).select(bucket)
    met = met.join(shared, bucket).join(large, bucket, "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    own = F.pmod(F.xxhash64("vec_id", F.lit(1)), "blocks").cast("int")
    met = met.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    met = met.withColumn("low", F.least("own", "other")).withColumn("high", F.greatest("own", "other"))
    group = [*bucket, "low", "high"]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        last: tuple | None = None

        def done() -> Iterator[pa.RecordBatch]:
            rows = pa.Table.from_batches(held)
            if last is None or rows.num_rows < 2:
                return
            array = lambda c: rows.column(c).to_numpy()
            wide = lambda c: rows.column(c).combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(rows.num_rows, -1)
            ids, n, root = _bucket(array("vec_id"), array("copies"), wide("embedding"), wide("keys"), last[1], (array("own") == last[4]) & (last[3] != last[4]), threshold)
            if len(ids):
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(n), pa.array(root)], ["vec_id", "n", "root"])

        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(c).to_numpy() for c in group], 1)
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1).tolist(), batch.num_rows]
            for a, b in zip(cuts[:-1], cuts[1:]):
                key = tuple(keys[a].tolist())
                if key != last:
                    if held:
                        yield from done()
                    held, last = [], key
                held.append(batch.slice(a, b - a))
        if held:
            yield from done()

    sent = met.select("vec_id", "copies", "embedding", "keys", "own", *group)
    return sent.repartition(*group).sortWithinPartitions(*group).mapInArrow(compare, "vec_id long, n long, root long")


def near_duplicates(embeddings: DataFrame, threshold: float = THRESHOLD, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row."""
    rows = embeddings.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("embedding"))
    finite = F.forall("embedding", lambda x: F.coalesce(F.abs(x) < F.lit(float("inf")), F.lit(False)))
    usable = F.col("vec_id").isNotNull() & F.coalesce(finite & F.exists("embedding", lambda x: x != 0), F.lit(False))
    rows = rows.withColumn("embedding", F.when(usable, F.col("embedding")))
    distinct = staged(rows.where("embedding is not null").groupBy("embedding").agg(F.min("vec_id").alias("vec_id"), F.count("*").alias("copies")).select("vec_id", "copies", "embedding"), "vectors")
    found = staged(links(distinct, threshold), "vector-links")
    sums = found.groupBy("vec_id").agg(F.sum("n").alias("n"))
    classes = components(found.select(F.col("vec_id").alias("a"), F.col("root").alias("b")))
    of = (
        distinct.select("embedding", "vec_id", "copies")
        .join(sums, "vec_id", "left")
        .join(classes, F.col("vec_id") == F.col("id"), "left")
        .select("embedding", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "vec_id").alias("component_id"))
    )
    out = rows.join(of, "embedding", "left").select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
