"""Exact Jaccard join of documents by their five-word shingles, as a join in the metric space of Jaccard distance.

Documents with equal sets become one. The first pivots are the sets of a single shingle. A document's nearest pivot is its
first shingle in a global order, rare before frequent; within the distance that still links, a partner keeps all but a
fifth of its shingles, so the window of pivots that a document must be sent to is the first fifth of its shingles and one
more. Documents of one pivot are its region. Regions with equal members are one.

Small regions give pairs within the window of set sizes. Other pivots prune these: for any part P of all shingles,
| |x & P| - |y & P| | bounds the difference of x and y by the triangle inequality, and its parity does. The parities of 512
parts, eight longs, travel with a pair first; then those of as many small parts as twice the shingles. What is left is compared exactly: each document first with the
partner that has most partners, and after that only what these links don't connect. Large regions are joined recursively: document pivots make Voronoi cells, a document also goes to all
cells q with d(x, q) <= d(x, p) + 2 * 0.2, and whatever one pivot already connects is not compared again. A region too large
for a task first loses, round by round, what a pivot connects; regions that don't shrink are compared in blocks.

Rows: null or empty texts and texts without words have no shingles and link with nothing; fewer than five words are one
shingle; repeated rows are documents of their own that link; a null id keeps its row without component; an empty table
gives no rows; only the named columns are used. Shingles are compared by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelmetrics.llm.common import components, drop_staged, staged, whole_text, with_mark
from parcelmetrics.llm.tokens import CACHED_CHUNKS, runs, small_batches

WORDS = 5
#: Bits of the slots of frequent shingles, at least and at most, and of the chunks they are added up in; parts of all shingles whose parities bound differences.
SLOT_BITS, MOST_SLOT_BITS, CHUNK_BITS, PARTS = 20, 24, 6, 512
#: Members of a small region, of one that a task joins, pivots of a recursion, and its smallest share that still helps.
SMALL, LARGE, PIVOTS, SHRINK = 64, 4096, 8, 0.8
LINK, EPSILON = 0.8, 0.2
SKETCH = [f"s{k}" for k in range(PARTS // 64)]
#: Odd factor between the words of a shingle.
STEP = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(33))  # a new array, changed in place from here on
    for factor in (np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)):
        x *= factor
        x ^= x >> np.uint64(33)
    return x


class WordHashes(dict):
    """64-bit hashes by word, remembered."""

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) > CACHED_CHUNKS:
            self.clear()
        if len(word) <= 64:
            self[word] = value
        return value


def shingles(text: str | None, hashes: WordHashes, width: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of the shingles; words end at ASCII white space, A-Z count as a-z."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    return shingles_of(np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words)), width)


def shingles_of(each: np.ndarray, width: int = WORDS) -> np.ndarray:
    """The same from the hashes of one word at least."""
    return distinct(hashed(each, min(width, len(each))))


def hashed(each: np.ndarray, width: int) -> np.ndarray:
    """Hashes of the shingles in the order of the words, of which there are ``width`` at least."""
    n = len(each) - width + 1
    out = np.full(n, width, np.uint64)
    for k in range(width):
        out *= STEP
        out += each[k : k + n]
    return mixed(out)


def distinct(values: np.ndarray) -> np.ndarray:
    """Sorted distinct values, of which there is one at least."""
    out = np.sort(values)
    new = np.empty(len(out), bool)
    new[0] = True
    np.not_equal(out[1:], out[:-1], out=new[1:])
    return out[new]


def linked(common: int, n: int, m: int) -> bool:
    return 100 * common >= 80 * (n + m - common)


def slot_bits(rows: DataFrame) -> int:
    """Bits of a slot number: some sixteen slots a document, within bounds that a task can count and a driver send."""
    return min(MOST_SLOT_BITS, max(SLOT_BITS, (16 * max(rows.count(), 1) - 1).bit_length()))


def frequent_slots(rows: DataFrame, bits: int) -> np.ndarray:
    """For each slot of shingle hashes how far its count is above the mean, as a power of two, or 0 if it isn't well above.

    Tasks count all slots; their counts are added up in chunks of slots, so that a shingle that is spread over all tasks
    stands out too. Any order of shingles keeps the join exact.
    """
    shift, chunk = np.uint64(64 - bits), 1 << (bits - CHUNK_BITS)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, total = WordHashes(), np.zeros(1 << bits, np.uint32)
        for batch in small_batches(batches, "text"):
            for text in batch.column("text").to_pylist():
                # A text has a shingle once, but two of its shingles may share a slot.
                np.add.at(total, (shingles(text, hashes) >> shift).astype(np.int64), 1)
        for k in range(1 << CHUNK_BITS):
            packed = zstandard.ZstdCompressor(level=1).compress(total[k * chunk : (k + 1) * chunk].tobytes())
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([packed])], ["chunk", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in runs(batches, ["chunk"]):
            total = np.zeros(chunk, np.int64)
            for counts in run.column("counts").to_pylist():
                total += np.frombuffer(zstandard.ZstdDecompressor().decompress(counts), np.uint32)
            mean = total.mean()
            above = np.maximum(total - mean, 1)
            level = np.where(total > mean + 5 * np.sqrt(mean) + 8, np.log2(above), 0).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([run.column("chunk").chunk(0)[:1], pa.array([level.tobytes()])], ["chunk", "levels"])

    counted = rows.select("text").mapInArrow(count, "chunk int, counts binary").repartition("chunk").sortWithinPartitions("chunk")
    # A byte for each slot.
    found = counted.mapInArrow(add, "chunk int, levels binary").orderBy("chunk").collect()
    return np.frombuffer(b"".join(bytes(r.levels) for r in found), np.uint8) if found else np.zeros(1 << bits, np.uint8)


def parities(own: np.ndarray) -> bytes:
    """For each of at least twice as many parts as there are shingles, whether it has an odd number of them, as bits."""
    size = max(64, 1 << (2 * len(own) - 1).bit_length())
    return np.packbits(np.bincount((own & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1, bitorder="little").tobytes()


def least_difference(x: bytes, y: bytes) -> int:
    """A lower bound of the number of shingles that only one of two sets has, from their :func:`parities`."""
    p, q = np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)
    size = min(len(p), len(q))  # parts of the larger number fold into those of the smaller
    p, q = (np.bitwise_xor.reduce(v.reshape(-1, size), 0) for v in (p, q))
    return int(np.bitwise_count(p ^ q).sum())


def _profiles(rows: DataFrame, level: np.ndarray, slot: int) -> DataFrame:
    """(doc_id, tie, n, set_key, first: shingles of its window, s0..s7: parities of its parts, bits: of more parts)."""
    sent = rows.sparkSession.sparkContext.broadcast(level)  # a byte for each slot

    def profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in small_batches(batches, "text"):
            keys, sizes, first, parts, bits = [], [], [], [], []
            for text in batch.column("text").to_pylist():
                own = shingles(text, hashes)
                n = len(own)
                keys.append(xxhash.xxh3_128_digest(own.tobytes()))
                sizes.append(n)
                order = np.argsort(sent.value[(own >> np.uint64(64 - slot)).astype(np.int64)], kind="stable")
                first.append(own[order[: n - -(-4 * n // 5) + 1]].astype(np.int64) if n else np.zeros(0, np.int64))
                parts.append(np.packbits(np.bincount((own % np.uint64(PARTS)).astype(np.int64), minlength=PARTS) & 1).tobytes())
                bits.append(parities(own))
            sketches = np.frombuffer(b"".join(parts), "<i8").reshape(len(parts), -1)
            columns = [batch.column("doc_id"), batch.column("tie"), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(first, pa.list_(pa.int64())), pa.array(bits, pa.binary())]
            yield pa.RecordBatch.from_arrays([*columns, *map(pa.array, sketches.T)], ["doc_id", "tie", "n", "set_key", "first", "bits", *SKETCH])

    return rows.mapInArrow(profile, f"doc_id long, tie long, n long, set_key binary, first array<long>, bits binary, {', '.join(f'{s} long' for s in SKETCH)}")


def _near_enough(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Those of ``pairs`` (a, b) that the parities of their parts don't rule out."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "x"):
            sizes = zip(*(batch.column(c).to_pylist() for c in ("n_a", "n_b", "x", "y")))
            keep = np.array([9 * least_difference(x, y) <= n + m for n, m, x, y in sizes], bool)
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    ends = pairs.select(F.col("a").alias("rep")).union(pairs.select("b"))
    some = with_mark(classes.select("rep", "n", "bits"), ends, ["rep"], "met").where("met")
    x, y = (some.select(F.col("rep").alias(end), F.col("n").alias(f"n_{end}"), F.col("bits").alias(bits)) for end, bits in (("a", "x"), ("b", "y")))
    return pairs.join(x, "a").join(y, "b").select("a", "b", "n_a", "n_b", "x", "y").mapInArrow(compare, "a long, b long")


def _whole_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Arrays (shingle, n, rep) of whole runs, many runs at a time; a run over several batches is held until it ends."""
    held: list[tuple[np.ndarray, ...]] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = tuple(batch.column(c).to_numpy() for c in ("shingle", "n", "rep"))
        last = int(np.searchsorted(columns[0], columns[0][-1]))
        if last == 0 and held and held[0][0][0] == columns[0][0]:
            held.append(columns)
            continue
        ended = [*held, tuple(c[:last] for c in columns)]
        yield tuple(np.concatenate(c) for c in zip(*ended))
        held = [tuple(c[last:] for c in columns)]
    if held:
        yield tuple(np.concatenate(c) for c in zip(*held))


def _pairs_and_regions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From members (shingle, n, rep) sorted by shingle and n: pairs of small regions (region null), members of large ones."""
    names = ["region", "a", "b"]

    def rows(region: int | None, a: np.ndarray, b: np.ndarray | None) -> pa.RecordBatch:
        none = pa.nulls(len(a), pa.int64())
        return pa.RecordBatch.from_arrays([none if region is None else pa.array(np.full(len(a), region)), pa.array(a), none if b is None else pa.array(b)], names)

    for shingle, n, rep in _whole_runs(batches):
        if not len(shingle):
            continue
        starts = np.flatnonzero(np.append(True, shingle[1:] != shingle[:-1]))
        lengths = np.diff(np.append(starts, len(shingle)))
        for start, m in zip(starts[lengths > SMALL], lengths[lengths > SMALL]):
            members = np.sort(rep[start : start + m])
            yield rows(int(xxhash.xxh3_64_intdigest(members.tobytes()) >> 1), members, None)
        left, right = [], []
        for m in np.unique(lengths[(lengths > 1) & (lengths <= SMALL)]):  # all regions of one size together
            i, j = np.triu_indices(m, 1)
            at = starts[lengths == m, None]
            i, j = (at + i).ravel(), (at + j).ravel()
            near = 5 * n[i] >= 4 * n[j]  # sorted by size
            left.append(np.minimum(rep[i], rep[j])[near])
            right.append(np.maximum(rep[i], rep[j])[near])
        if left:
            a, b = np.concatenate(left), np.concatenate(right)
            order = np.lexsort((b, a))
            a, b = a[order], b[order]
            new = np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]))[: len(a)]
            yield rows(None, a[new], b[new])


def distances(sets: list[np.ndarray], pivot: np.ndarray) -> np.ndarray:
    """Jaccard distances of many sets to one."""
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    common = np.add.reduceat(np.isin(np.concatenate(sets), pivot), np.cumsum(sizes) - sizes, dtype=np.int64)
    return 1 - common / (sizes + len(pivot) - common)


def join_region(sets: list[np.ndarray], label: np.ndarray) -> np.ndarray:
    """Labels of members that links within the region connect, ``label`` being what is already connected.

    Only connections count, so members with one label need not meet.
    """
    parent = {int(x): int(x) for x in label}

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def unite(a: int, b: int) -> None:
        a, b = root(int(a)), root(int(b))
        parent[max(a, b)] = min(a, b)

    todo = [np.arange(len(sets))]
    while todo:
        members = todo.pop()
        own = np.array([root(int(x)) for x in label[members]])
        if len(members) < 2 or (own == own[0]).all():
            continue
        if len(members) <= 2 * PIVOTS:
            for i, a in enumerate(members):
                for b in members[i + 1 :]:
                    x, y = sets[a], sets[b]
                    if root(int(label[a])) != root(int(label[b])) and 5 * min(len(x), len(y)) >= 4 * max(len(x), len(y)):
                        if linked(len(np.intersect1d(x, y, assume_unique=True)), len(x), len(y)):
                            unite(label[a], label[b])
            continue
        chosen = members[np.linspace(0, len(members) - 1, PIVOTS).astype(int)]
        some = [sets[k] for k in members]
        to_pivot = np.stack([distances(some, sets[p]) for p in chosen], 1)
        for k, p in enumerate(chosen):
            for x in members[to_pivot[:, k] <= EPSILON + 1e-12]:
                if root(int(label[x])) != root(int(label[p])) and linked(len(np.intersect1d(sets[x], sets[p], assume_unique=True)), len(sets[x]), len(sets[p])):
                    unite(label[x], label[p])
        rest = ~np.isin(members, chosen)  # the pivots have met everyone
        members, to_pivot = members[rest], to_pivot[rest]
        nearest = to_pivot.min(1)
        cells = []
        for k in range(PIVOTS):
            home = to_pivot.argmin(1) == k
            inside = to_pivot[:, k] <= nearest + 2 * EPSILON + 1e-9
            if home.any():  # and no further from the pivot than the window of the cell's own members
                inside &= to_pivot[:, k] <= to_pivot[home, k].max() + EPSILON + 1e-9
                cells.append(members[inside])
        if not cells or max(map(len, cells)) <= SHRINK * (len(members) + PIVOTS):
            todo += cells
        else:  # no cell is small enough: one by one, within the windows of the pivots' distances
            for i in range(len(members)):
                near = np.flatnonzero((np.abs(to_pivot[i + 1 :] - to_pivot[i]) <= EPSILON + 1e-9).all(1)) + i + 1
                apart = [j for j in near if root(int(label[members[j]])) != root(int(label[members[i]]))]
                if apart:
                    found = distances([sets[members[j]] for j in apart], sets[members[i]])
                    for j in np.array(apart)[found <= EPSILON + 1e-12]:
                        x, y = sets[members[i]], sets[members[j]]
                        if linked(len(np.intersect1d(x, y, assume_unique=True)), len(x), len(y)):
                            unite(label[members[i]], label[members[j]])
    return np.array([root(int(x)) for x in label])


def _as_sets(column: pa.ChunkedArray) -> list[np.ndarray]:
    return [np.frombuffer(x, np.uint64) for x in column.to_pylist()]


def _reach(n: np.ndarray, label: np.ndarray, bits: list[bytes]) -> np.ndarray:
    """Which of some sets may link with one of another label, by their sizes and :func:`parities`."""
    of = np.fromiter(map(len, bits), np.int64, len(bits))
    keep = np.zeros(len(n), bool)
    for size in np.unique(of):
        # Those of this number of parts with each other, and with larger ones folded into as many.
        at = np.flatnonzero(of >= size)
        parts = np.stack([np.bitwise_xor.reduce(np.frombuffer(bits[k], np.uint64).reshape(-1, size // 8), 0) for k in at])
        for i in np.flatnonzero(of[at] == size):
            k = at[i]
            some = np.flatnonzero((label[at] != label[k]) & (5 * np.minimum(n[at], n[k]) >= 4 * np.maximum(n[at], n[k])) & ~(keep[at] & keep[k]))
            if len(some):
                near = 9 * np.bitwise_count(parts[some] ^ parts[i]).sum(1, dtype=np.int64) <= n[at[some]] + n[k]
                keep[at[some[near]]] = True
                keep[k] |= near.any()
    return keep


def _within_reach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of members (region, rep, label, n, bits) sorted by region those that may link with one of another label in it."""
    for run in runs(batches, ["region"]):
        keep = _reach(run.column("n").to_numpy(), run.column("label").to_numpy(), run.column("bits").to_pylist())
        yield from run.select(["region", "rep", "label"]).filter(pa.array(keep)).to_batches()


def _join_regions(members: DataFrame, sets: DataFrame, sketches: DataFrame | None = None) -> DataFrame:
    """(a, b) edges that connect what is linked in each region; members: (region, rep, label)."""

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in runs(batches, ["region"]):
            reps, before = run.column("rep").to_numpy(), run.column("label").to_numpy()
            after = join_region(_as_sets(run.column("shingles")), before)
            yield pa.RecordBatch.from_arrays([pa.array(np.append(reps, before)), pa.array(np.append(after, after))], ["a", "b"])

    if sketches is not None:  # before their sets travel
        slim = members.join(sketches, "rep").select("region", "rep", "label", "n", "bits")
        members = slim.repartition("region").sortWithinPartitions("region").mapInArrow(_within_reach, "region long, rep long, label long")
    members = staged(members, "members")
    sets = with_mark(sets.select("rep", "shingles"), members, ["rep"], "met").where("met").drop("met")
    rows = members.join(sets, "rep").select("region", "rep", "label", "shingles")
    return rows.repartition("region").sortWithinPartitions("region", "rep").mapInArrow(join, "a long, b long")


def _shrunk(members: DataFrame, sets: DataFrame, salts: int) -> tuple[DataFrame, DataFrame]:
    """One round on regions too large for a task: edges to each region's pivot, and the members that may still link."""
    pivots = members.groupBy("region").agg(F.min(F.struct(F.xxhash64("rep", "label"), "rep")).alias("p")).select("region", F.col("p.rep").alias("rep"))
    dealt = members.withColumn("salt", F.pmod(F.xxhash64("rep"), F.lit(salts))).join(sets.select("rep", "shingles"), "rep")
    # Columns of its own: both sides come from the same tables, and Spark refuses to tell equal ones apart.
    spread = pivots.join(sets.select("rep", "shingles"), "rep").select(
        F.col("region").alias("of"), F.col("rep").alias("pivot"), F.col("shingles").alias("p"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))).alias("for_salt")
    )

    def measure(own: pa.Table, pivot: pa.Table) -> pa.Table:
        p = np.frombuffer(pivot.column("p")[0].as_py(), np.uint64)
        found = distances(_as_sets(own.column("shingles")), p) if own.num_rows else np.zeros(0)
        columns = [own.column("region"), own.column("rep"), own.column("label"), pa.array(np.full(own.num_rows, pivot.column("pivot")[0].as_py(), np.int64)), pa.array(found)]
        return pa.Table.from_arrays(columns, ["region", "rep", "label", "pivot", "d"])

    measured = staged(dealt.groupBy("region", "salt").cogroup(spread.groupBy("of", "for_salt")).applyInArrow(measure, "region long, rep long, label long, pivot long, d double"), "measured")
    near = F.col("d") <= EPSILON + 1e-12
    edges = measured.where(near).select(F.col("rep").alias("a"), F.col("pivot").alias("b")).union(measured.where(near).select("label", "pivot"))
    least = measured.where(~near).groupBy("region").agg(F.min("d").alias("least"))
    left = measured.join(least, "region").where((F.col("rep") != F.col("pivot")) & (F.col("d") >= F.col("least") - EPSILON - 1e-9))
    return edges, left.select("region", "rep", F.when(near, F.col("pivot")).otherwise(F.col("label")).alias("label"))


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of ``pairs`` (a, b) that link. The set of ``a`` travels to that of ``b``."""

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "x"):
            left, right = (_as_sets(batch.column(c)) for c in ("x", "y"))
            keep = np.array([linked(len(np.intersect1d(p, q, assume_unique=True)), len(p), len(q)) for p, q in zip(left, right)], bool)
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    met = sets.join(pairs.select("b").distinct(), F.col("rep") == F.col("b"), "left_semi")
    both = sets.select(F.col("rep").alias("a"), F.col("shingles").alias("x")).join(pairs, "a").join(met.select(F.col("rep").alias("b"), F.col("shingles").alias("y")), "b")
    return both.select("a", "b", "x", "y").mapInArrow(verify, "a long, b long")


def _stars(pairs: DataFrame) -> DataFrame:
    """Of ``pairs`` one for each document: (a, b), b being its partner with most partners."""
    ends = pairs.select("a", "b").union(pairs.select("b", "a"))
    partners = ends.groupBy(F.col("a").alias("b")).agg(F.count("*").alias("partners"))
    hub = ends.join(partners, "b").groupBy("a").agg(F.max(F.struct("partners", "b")).alias("hub")).select("a", F.col("hub.b").alias("b"))
    # Two that chose each other meet once.
    other = hub.select(F.col("b").alias("a"), F.col("a").alias("b"), F.lit(True).alias("mutual"))
    return hub.join(other, ["a", "b"], "left").where("mutual is null or a < b").select("a", "b")


def _to_pivots(regions: DataFrame) -> DataFrame:
    """A pair (a, b) for each member of ``regions`` (region, rep) and the pivot of its largest region, and of its smallest.

    Near copies share many regions with nearly equal members. Once their pivots connect them, these regions have nothing left
    to compare, and no set travels to each of them.
    """
    own = regions.groupBy("region").agg(F.count("*").alias("m"), F.min(F.struct(F.xxhash64("rep"), "rep")).alias("p"))
    placed = regions.select("region", "rep").join(own.select("region", "m", F.col("p.rep").alias("pivot")), "region")
    order = F.struct("m", "region", "pivot")
    ends = placed.groupBy("rep").agg(F.array(F.max(order), F.min(order)).alias("some"))
    pairs = ends.select("rep", F.explode("some.pivot").alias("pivot")).where("rep <> pivot")
    return pairs.select(F.least("rep", "pivot").alias("a"), F.greatest("rep", "pivot").alias("b"))


def verified_edges(pairs: DataFrame, regions: DataFrame, sets: DataFrame, sketches: DataFrame | None = None) -> DataFrame:
    """(a, b) edges that connect all linked of ``pairs`` (a, b) and of the members (region, rep, label) of ``regions``.

    ``sets`` has (rep, shingles: sorted hashes as bytes) of all that take part. Each document of ``pairs`` first meets one
    hub, so that its set travels once; then only pairs and regions that these links don't connect are compared. ``sketches``
    (rep, n, bits: :func:`parities`) keep members of regions that can link with no other from being compared.
    """
    stars = staged(_stars(pairs), "stars")
    found = staged(_verified(stars, sets), "hub-links")
    class_of = staged(components(found), "hub-classes")
    a, b = (class_of.select(F.col("id").alias(end), F.col("component").alias(f"of_{end}")) for end in ("a", "b"))
    rest = pairs.select("a", "b").join(a, "a", "left").join(b, "b", "left").where("coalesce(of_a, a) <> coalesce(of_b, b)").select("a", "b")
    met = stars.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    rest = staged(rest.join(met, ["a", "b"], "left_anti"), "rest")
    edges = [found, _verified(rest, sets)]

    own = class_of.select(F.col("id").alias("rep"), "component")
    regions = staged(regions.join(own, "rep", "left").select("region", "rep", F.coalesce("component", "label").alias("label")), "regions")
    apart = regions.groupBy("region").agg((F.min("label") < F.max("label")).alias("apart")).where("apart").select("region")
    regions = regions.join(apart, "region")
    sizes = regions.groupBy("region").agg(F.count("*").alias("m"))
    before = None
    while True:
        large = sizes.where(F.col("m") > LARGE)
        total = large.agg(F.sum("m"), F.max("m")).first()
        edges.append(_join_regions(regions.join(sizes.where(F.col("m") <= LARGE).select("region"), "region"), sets, sketches))
        if not total[0]:
            break
        rest = regions.join(large.select("region"), "region")
        if before is not None and total[0] > SHRINK * before:
            blocks = -(-2 * total[1] // LARGE)
            block = F.pmod(F.xxhash64("rep", F.lit(1)), F.lit(blocks))
            other = rest.withColumn("own", block).withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
            regions = other.select(F.xxhash64("region", F.least("own", "other"), F.greatest("own", "other")).alias("region"), "rep", "label")
            edges.append(_join_regions(regions, sets, sketches))
            break
        found, regions = _shrunk(rest, sets, -(-2 * total[1] // LARGE))
        edges.append(found)
        regions, before = staged(regions, "regions"), total[0]
        sizes = regions.groupBy("region").agg(F.count("*").alias("m"))

    joined = edges[0]
    for e in edges[1:]:
        joined = joined.union(e)
    return joined


def text_components(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, tie: hash of its text, n, first: (doc_id, tie) of the least in its component) of every row.

    Rows with one id and different texts are told apart. ``first`` is null where a row has no shingles or no id.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), whole_text(text).alias("text")).withColumn("tie", F.xxhash64("text"))
    slot = slot_bits(rows)
    wide = staged(_profiles(rows, frequent_slots(rows, slot), slot), "profiles")
    usable = wide.where("n > 0 and doc_id is not null")
    # Sets that come once stay where they are.
    again = usable.groupBy("set_key").agg(F.count("*").alias("m")).where("m > 1").select("set_key")
    usable = with_mark(usable, again, ["set_key"], "again")
    columns = ["n", "first", "bits", *SKETCH]
    once = usable.where("not again").select("set_key", F.struct("doc_id", "tie").alias("least"), F.lit(1).cast("long").alias("m"), *columns)
    more = usable.where("again").groupBy("set_key").agg(F.min(F.struct("doc_id", "tie")).alias("least"), F.count("*").alias("m"), F.first(F.struct(*columns)).alias("x"))
    classes = staged(once.union(more.select("set_key", "least", "m", "x.*")).withColumn("rep", F.xxhash64("set_key")), "classes")
    profiles = staged(wide.select("doc_id", "tie", "n", "set_key"), "documents")
    drop_staged(wide)

    members = classes.select("rep", "n", F.explode("first").alias("shingle"))
    met = staged(members.repartition("shingle").sortWithinPartitions("shingle", "n").mapInArrow(_pairs_and_regions, "region long, a long, b long"), "met")
    regions = staged(met.where("region is not null").select("region", F.col("a").alias("rep")).distinct().withColumn("label", F.col("rep")), "regions")
    pairs = met.where("region is null").select("a", "b").union(_to_pivots(regions)).distinct()
    x, y = (classes.select(F.col("rep").alias(end), F.col("n").alias(f"n_{end}"), *[F.col(s).alias(f"{s}_{end}") for s in SKETCH]) for end in ("a", "b"))
    differ = reduce(lambda a, b: a + b, [F.bit_count(F.col(f"{s}_a").bitwiseXOR(F.col(f"{s}_b"))) for s in SKETCH])
    sketched = staged(pairs.join(x, "a").join(y, "b").where(9 * differ <= F.col("n_a") + F.col("n_b")).select("a", "b"), "pairs")
    pairs = staged(_near_enough(sketched, classes), "near-pairs")
    sketches = staged(with_mark(classes.select("rep", "n", "bits"), regions, ["rep"], "met").where("met").drop("met"), "sketches")
    wide, classes = classes, staged(classes.drop("first", "bits"), "slim-classes")
    for done in (sketched, met, wide):
        drop_staged(done)

    # Sets of those documents only that take part, from their texts.
    needed = pairs.select(F.col("a").alias("rep")).union(pairs.select("b")).union(regions.select("rep")).distinct()
    # Written first, so that Spark knows its size, and moves no text where it is small.
    of = staged(classes.join(needed, "rep").select("rep", "least.*"), "needed")
    some = with_mark(rows, of, ["doc_id", "tie"], "met").where("met").join(of, ["doc_id", "tie"]).dropDuplicates(["doc_id", "tie", "rep"]).select("rep", "text")

    def shingle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in small_batches(batches, "text"):
            made = [shingles(t, hashes).tobytes() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("rep"), pa.array(made, pa.binary())], ["rep", "shingles"])

    sets = staged(some.mapInArrow(shingle, "rep long, shingles binary"), "sets")

    found = staged(components(verified_edges(pairs, regions, sets, sketches)), "found")
    # All others are the first of their own class.
    of = with_mark(classes.select("set_key", "rep", "least", "m"), found.select(F.col("id").alias("rep")), ["rep"], "met")
    of = of.where("met or m > 1").join(found, F.col("rep") == F.col("id"), "left").select("set_key", "least", F.coalesce("component", "rep").alias("of"))
    of = staged(of, "linked")
    first = of.groupBy("of").agg(F.min("least").alias("first"))
    of = of.join(first, "of").select("set_key", "first")
    profiles = with_mark(profiles, of, ["set_key"], "met").withColumn("own", F.struct("doc_id", "tie"))
    joined = profiles.where("met").join(of, "set_key", "left").withColumn("first", F.coalesce("first", "own"))
    out = joined.drop("met").unionByName(profiles.where("not met").withColumn("first", F.col("own")).drop("met"))
    return out.select("doc_id", "tie", "n", F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.col("first")).alias("first"))


def jaccard_components(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, n_shingles, component_id) of every document."""
    found = text_components(docs, text, doc_id)
    return found.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("first.doc_id", "doc_id").alias("component_id"))
