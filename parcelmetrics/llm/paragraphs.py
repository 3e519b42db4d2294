"""Removal of repeated passages: MinHash banding of paragraphs, exact Jaccard similarity, connected components.

Paragraphs are of two kinds: lines, and all ``RUN`` consecutive words of a text wherever they start and lines break.

Any run of ``RUN`` words that occurs before (in the order of document id, text hash, place; in the same text only where
the two don't overlap) is removed, so passages go that lie inside longer lines or over short ones. The MinHash of such a
paragraph is the least hash of its shingles of ``WIDE`` words, one band, as equal paragraphs always share it. Neighbours with
one MinHash are a segment. Segments of one MinHash and equal words are a class; all but its first are repeated whole.
Only where a MinHash has several classes, their firsts are compared paragraph by paragraph. So no step gathers a group.

A long line is a line of at least ``MIN_WORDS`` words. Equal ones (by words, A-Z as a-z) become one class. Bands of the
MinHash signature of the five-word shingles, tuned so that a pair at the threshold meets with probability ``RECALL``, bring
paragraphs together; what meets is compared exactly. Of each component the paragraph of the least (document id, place)
stays, all others are to be removed. Buckets of many different paragraphs are joined like large regions of the Jaccard join.

Rows: null text counts as empty and has no paragraph; words are compared with A-Z as a-z, white space doesn't count; a repeated row is
a copy whose paragraphs are removed (rows with the same id and text cannot be told apart and keep the first's paragraphs in
both); rows with a null id are not searched and lose nothing; an empty table gives no rows; only the named columns are used.
Lines of any length are compared whole. Runs are compared by 64-bit hashes of their words.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelmetrics.llm.common import components, staged, whole_text
from parcelmetrics.llm.jaccard import STEP, WORDS, WordHashes, _pairs_and_regions, distinct, hashed, mixed, shingles, shingles_of, verified_edges
from parcelmetrics.llm.tokens import small_batches

MIN_WORDS, THRESHOLD, RECALL, SIGNATURE = 50, 0.8, 0.995, 128
#: Words of a run that is removed where it occurs before, and of the shingles of its MinHash.
RUN, WIDE = 51, 12
#: Shingles that are signed at a time.
BLOCK = 128
SPACE = np.isin(np.arange(256), list(b" \t\n\r\x0b\x0c"))


def tuned_bands(threshold: float = THRESHOLD, recall: float = RECALL, most: int = SIGNATURE) -> tuple[int, int]:
    """(bands, rows): the most selective banding of at most ``most`` hashes that finds a pair at the threshold so surely."""
    for rows in range(most, 0, -1):
        bands = int(np.ceil(np.log(1 - recall) / np.log1p(-(threshold**rows)))) if threshold < 1 else 1
        if bands * rows <= most:
            return bands, rows
    raise ValueError("no banding reaches this recall")


class Signer:
    """Band keys of shingle sets."""

    def __init__(self, bands: int, rows: int):
        dice = np.random.default_rng(bands * 1000 + rows)
        self.shape = (bands, rows)
        self.factor = dice.integers(1, 1 << 63, bands * rows, dtype=np.uint64) | np.uint64(1)
        self.add = dice.integers(0, 1 << 63, bands * rows, dtype=np.uint64)
        self.values, self.high = np.empty((2, BLOCK, bands * rows), np.uint64)

    def least(self, own: np.ndarray) -> np.ndarray:
        """The signature of a set."""
        least = np.full(self.shape[0] * self.shape[1], ~np.uint64(0))
        for at in range(0, len(own), BLOCK):
            some = own[at : at + BLOCK, None]
            values, high = self.values[: len(some)], self.high[: len(some)]
            np.multiply(some, self.factor, out=values)
            values += self.add
            values ^= np.right_shift(values, np.uint64(32), out=high)
            np.minimum(least, values.min(0), out=least)
        return least

    def keys(self, signatures: list[np.ndarray]) -> np.ndarray:
        """The band keys of many signatures, a row each."""
        columns = np.stack(signatures).reshape(-1, *self.shape)
        key = np.arange(self.shape[0], dtype=np.uint64)
        for k in range(self.shape[1]):
            key = mixed(key * np.uint64(31) + columns[:, :, k])
        return key.astype(np.int64)


class Words:
    """The words of some texts, one after the other, with a hash of any run of them."""

    def __init__(self, texts: list[str], hashes: WordHashes):
        self.raw = [t.encode("utf-8", "surrogatepass") for t in texts]
        self.split = split = [r.lower().split() for r in self.raw]
        self.ends = np.cumsum(np.fromiter(map(len, split), np.int64, len(split)))
        self.starts = np.append(0, self.ends[:-1])
        n = int(self.ends[-1]) if len(split) else 0
        self.each = np.fromiter(map(hashes.__getitem__, chain.from_iterable(split)), np.uint64, n)
        back = np.full(n + 1, pow(int(STEP), -1, 1 << 64), np.uint64)
        power = np.full(n, STEP)
        back[0] = 1
        self.back = np.multiply.accumulate(back)
        self.sums = np.append(np.uint64(0), np.cumsum(self.each * np.multiply.accumulate(power), dtype=np.uint64))

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of the words from ``start`` to ``end``, the same wherever they are."""
        return mixed((self.sums[end] - self.sums[start]) * self.back[start] + (end - start).astype(np.uint64))

    def shingled(self) -> np.ndarray:
        """Hashes of the five-word shingles that start at each word, before they are told apart."""
        return hashed(self.each, WORDS) if len(self.each) >= WORDS else np.zeros(0, np.uint64)

    def runs(self) -> np.ndarray:
        """Where a run of ``RUN`` words of one text starts."""
        return np.concatenate([np.arange(a, b - RUN + 1) for a, b in zip(self.starts.tolist(), self.ends.tolist()) if b - a >= RUN] or [np.zeros(0, np.int64)])

    def segments(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each segment the MinHash, the first word, and the number of runs that start in it."""
        at = self.runs()
        if not len(at):
            return np.zeros(0, np.uint64), at, at
        first = np.arange(len(self.each) - WIDE + 1)
        least, width = self.hash(first, first + WIDE), 1
        while width < RUN - WIDE + 1:
            step = min(width, RUN - WIDE + 1 - width)
            least = np.minimum(least[:-step], least[step:])
            width += step
        least = least[at]
        new = np.flatnonzero(np.append(True, (least[1:] != least[:-1]) | (at[1:] != at[:-1] + 1)))
        return least[new], at[new], np.diff(np.append(new, len(at)))

    def places(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Where each word of text ``k`` starts and ends, in characters."""
        raw = np.frombuffer(self.raw[k], np.uint8)
        edges = np.flatnonzero(np.diff(np.concatenate([[True], SPACE[raw], [True]]).astype(np.int8)))
        before = np.append(0, np.cumsum((raw & 0xC0) != 0x80))
        return before[edges[::2]], before[edges[1::2]]


def paragraphs_of(rows: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Long lines: (doc_id, tie, place: line number, start, end, n: shingles, paragraph: key of its words, bands).

    Segments: (doc_id, tie, place: first word, start, end, n: runs, paragraph: key of its words, least: MinHash), bands null.
    """
    bands = tuned_bands()
    names = ["doc_id", "tie", "place", "start", "end", "n", "paragraph", "bands", "least"]
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.int64()]

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, signer = WordHashes(), Signer(*bands)
        for batch in small_batches(batches, "text", 1_000_000):
            found, signatures, places = [], [], {}
            texts = batch.column("text").to_pylist()
            words = Words(texts, hashes)
            shingled = words.shingled()
            for k, (doc_id, tie, text) in enumerate(zip(batch.column("doc_id").to_pylist(), batch.column("tie").to_pylist(), texts)):
                if len(words.split[k]) < min(min_words, RUN):
                    continue
                places[k] = words.places(k)
                start = 0
                for place, line in enumerate(text.split("\n")):
                    if len(line) >= 2 * min_words - 1:
                        a, b = np.searchsorted(places[k][0], (start, start + len(line)))
                        if b - a >= min_words:
                            a_word, b_word = words.starts[k] + a, words.starts[k] + b
                            own = distinct(shingled[a_word : b_word - WORDS + 1]) if b - a >= WORDS else shingles_of(words.each[a_word:b_word])
                            key = xxhash.xxh3_64_intdigest(b" ".join(words.split[k][a:b])) >> 1
                            found.append((doc_id, tie, place, start, start + len(line), len(own), key))
                            signatures.append(signer.least(own))
                    start += len(line) + 1
            if found:
                columns = [pa.array(c, k) for c, k in zip(zip(*found), kinds)]
                edges = np.arange(len(found) + 1, dtype=np.int32) * bands[0]
                keys = pa.ListArray.from_arrays(pa.array(edges), pa.array(signer.keys(signatures).ravel()))
                yield pa.RecordBatch.from_arrays([*columns, keys.cast(kinds[7]), pa.nulls(len(found), kinds[8])], names)

            least, at, n = words.segments()
            if not len(at):
                continue
            of = np.searchsorted(words.ends, at, "right")
            start, end = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
            cuts = np.flatnonzero(np.diff(of)) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(at)]):
                begin, finish = places[of[a]]
                own = at[a:b] - words.starts[of[a]]
                start[a:b], end[a:b] = begin[own], finish[own + n[a:b] + RUN - 2]
            texts_of = pa.array(of)
            key = words.hash(at, at + n + RUN - 1).view(np.int64)
            columns = [batch.column("doc_id").take(texts_of), batch.column("tie").take(texts_of), pa.array((at - words.starts[of]).astype(np.int32)), pa.array(start), pa.array(end), pa.array(n), pa.array(key), pa.nulls(len(at), kinds[7]), pa.array(least.view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, names)

    layout = "doc_id long, tie long, place int, start long, end long, n long, paragraph long, bands array<long>, least long"
    return rows.where("doc_id is not null").mapInArrow(find, layout)


def _repeated(docs: DataFrame, text: str, doc_id: str) -> tuple[DataFrame, DataFrame]:
    """Lines to remove, as :func:`repeated_passages` gives them, and runs to remove (doc_id, tie, start, end, kept_doc_id)."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), whole_text(text).alias("text")).withColumn("tie", F.xxhash64("text"))
    both = staged(paragraphs_of(rows), "paragraphs")
    found = both.where("least is null")
    first = F.min(F.struct("doc_id", "tie", "place")).alias("first")
    classes = staged(found.groupBy("paragraph").agg(first, F.min("n").alias("n"), F.first("bands").alias("bands")), "classes")

    # Segments whose MinHash another one has, or that have it twice themselves.
    segments = both.where("least is not null").select("doc_id", "tie", "place", "start", "end", "n", "paragraph", "least")
    again = segments.groupBy("least").agg(F.count("*").alias("m"), F.max("n").alias("most")).where((F.col("m") > 1) | (F.col("most") > RUN - WIDE + 1)).select("least")
    segments = staged(segments.join(again, "least"), "segments")
    firsts = staged(segments.groupBy("least", "paragraph").agg(F.min(F.struct("doc_id", "tie", "place")).alias("f"), F.max("n").alias("n")), "firsts")
    mixed_up = firsts.groupBy("least").agg(((F.count("*") > 1) | (F.max("n") > RUN - WIDE + 1)).alias("mixed"))
    known = segments.join(firsts.join(mixed_up, "least").select("least", "paragraph", "f", "mixed"), ["least", "paragraph"])
    here = (F.col("doc_id") == F.col("f.doc_id")) & (F.col("tie") == F.col("f.tie")) & (F.col("place") < F.col("f.place") + RUN)
    whole = known.where(~here).select("doc_id", "tie", "start", "end", F.col("f.doc_id").alias("kept_doc_id"))
    # A first can begin again inside itself, or within the words of the class's first: both by single runs.
    single = known.where(here & F.col("mixed")).select("doc_id", "tie", F.lit(-1).cast("long").alias("rep"), "place", F.col("n").cast("int").alias("n")).distinct()

    # The band's number is part of its key. Buckets give pairs, or a region where they are large.
    members = classes.select(F.col("paragraph").alias("rep"), "n", F.explode("bands").alias("shingle"))
    met = staged(members.repartition("shingle").sortWithinPartitions("shingle", "n").mapInArrow(_pairs_and_regions, "region long, a long, b long"), "met")
    pairs = staged(met.where("region is null").select("a", "b").distinct(), "pairs")
    regions = staged(met.where("region is not null").select("region", F.col("a").alias("rep")).distinct().withColumn("label", F.col("rep")), "regions")

    needed = pairs.select(F.col("a").alias("rep")).union(pairs.select("b")).union(regions.select("rep")).distinct()
    wanted = classes.join(needed, F.col("paragraph") == F.col("rep")).select("first.doc_id", "first.tie", "rep", "first.place", F.lit(None).cast("int").alias("n"))
    wanted = wanted.union(single).groupBy("doc_id", "tie").agg(F.collect_list(F.struct("place", "rep", "n")).alias("wanted"))  # of one text
    some = rows.join(wanted, ["doc_id", "tie"]).dropDuplicates(["doc_id", "tie"]).select("doc_id", "tie", "text", "wanted")

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Shingles of lines, and single runs: their key (as rep) with their place and span."""
        hashes = WordHashes()
        names = ["rep", "shingles", "doc_id", "tie", "place", "start", "end"]
        for batch in small_batches(batches, "text", 2_000_000):
            for doc_id, tie, own, wanted in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "tie", "text", "wanted"))):
                lines = own.split("\n")
                some = [w for w in wanted if w["n"] is None]
                if some:
                    made = [shingles(lines[w["place"]], hashes).tobytes() for w in some]
                    nothing = pa.nulls(len(some), pa.int64())
                    yield pa.RecordBatch.from_arrays([pa.array([w["rep"] for w in some], pa.int64()), pa.array(made, pa.binary()), *[nothing] * 2, nothing.cast(pa.int32()), *[nothing] * 2], names)
                some = [w for w in wanted if w["n"] is not None]
                if some:
                    words = Words([own], hashes)
                    begin, finish = words.places(0)
                    at = np.concatenate([np.arange(w["place"], w["place"] + w["n"]) for w in some])
                    columns = [words.hash(at, at + RUN).view(np.int64), None, np.full(len(at), doc_id), np.full(len(at), tie), at.astype(np.int32), begin[at].astype(np.int64), finish[at + RUN - 1].astype(np.int64)]
                    yield pa.RecordBatch.from_arrays([pa.nulls(len(at), pa.binary()) if c is None else pa.array(c) for c in columns], names)

    parts = staged(some.mapInArrow(compared, "rep long, shingles binary, doc_id long, tie long, place int, start long, end long"), "sets")
    sets = parts.where("shingles is not null").select("rep", "shingles")

    runs = parts.where("shingles is null").drop("shingles")
    earliest = runs.groupBy("rep").agg(F.count("*").alias("m"), F.min(F.struct("doc_id", "tie", "place")).alias("f")).where("m > 1").drop("m")
    pieces = runs.join(earliest, "rep").where(~here).select("doc_id", "tie", "start", "end", F.col("f.doc_id").alias("kept_doc_id"))

    cluster = components(verified_edges(pairs, regions, sets))
    clustered = classes.select("paragraph", "first").join(cluster, F.col("paragraph") == F.col("id"), "left").select("paragraph", "first", F.coalesce("component", "paragraph").alias("cluster"))
    kept = clustered.groupBy("cluster").agg(F.min("first").alias("kept"))
    of = clustered.select("paragraph", "cluster").join(kept, "cluster").select("paragraph", "kept")
    again = found.select("doc_id", "tie", "place", "start", "end", "paragraph").join(of, "paragraph")
    same = (F.col("doc_id") == F.col("kept.doc_id")) & (F.col("tie") == F.col("kept.tie")) & (F.col("place") == F.col("kept.place"))
    lines = again.where(~same).select("doc_id", "tie", "place", "start", "end", F.col("kept.doc_id").alias("kept_doc_id"), F.col("kept.place").alias("kept_place")).distinct()
    return lines, whole.union(pieces)


def repeated_passages(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, tie, place, start, end, kept_doc_id, kept_place): a row for each long line to remove, with what stays."""
    return _repeated(docs, text, doc_id)[0]


def merged_spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From (doc_id, tie, spans: list of start, end, kept_doc_id) a row for each span that is left when those that meet are one."""
    for batch in batches:
        spans = batch.column("spans")
        row = np.repeat(np.arange(batch.num_rows), pc.list_value_length(spans).to_numpy(zero_copy_only=False))
        if not len(row):
            continue
        start, end, kept = (column.to_numpy(zero_copy_only=False) for column in spans.flatten().flatten())
        order = np.lexsort((kept, end, start, row))
        shift = row[order] * (end.max() + 1)  # rows one after the other
        reach = np.maximum.accumulate(end[order] + shift)
        first = np.flatnonzero(np.append(True, (start[order] + shift)[1:] > reach[:-1]))
        last = np.append(first[1:], len(order)) - 1
        of = pa.array(row[order[first]])
        columns = [batch.column("doc_id").take(of), batch.column("tie").take(of), *map(pa.array, (start[order[first]], (reach - shift)[last], kept[order[first]]))]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "tie", "start", "end", "kept_doc_id"])


def repeated_spans(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, tie, start, end, kept_doc_id): all that is to be removed, long lines and runs, as spans that don't overlap.

    ``kept_doc_id`` is the document that keeps what the span begins with.
    """
    lines, runs = _repeated(docs, text, doc_id)
    spans = lines.select("doc_id", "tie", "start", "end", "kept_doc_id").union(runs)
    each = spans.groupBy("doc_id", "tie").agg(F.collect_set(F.struct("start", "end", "kept_doc_id")).alias("spans"))

    return each.mapInArrow(merged_spans, "doc_id long, tie long, start long, end long, kept_doc_id long")


def _with_text(joined: DataFrame, changed: Column, text: Column, docs: DataFrame) -> DataFrame:
    joined = joined.withColumn("text", F.when(changed, text).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        joined = joined.withColumn("n_chars", F.when(changed, F.char_length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return joined.select(docs.columns)


def without_passages(docs: DataFrame) -> DataFrame:
    """``docs`` without the spans that :func:`repeated_spans` finds; ``n_chars`` follows where there is such a column.

    Where a span is cut out, the white space before it goes if it ends in a blank, else that after it up to the line's end.
    """
    cut = repeated_spans(docs).groupBy("doc_id", "tie").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("cut"))
    cut = staged(cut.select(F.col("doc_id").alias("cut_id"), F.col("tie").alias("cut_tie"), "cut"), "cut")
    joined = docs.join(cut, (F.col("doc_id") == F.col("cut_id")) & (F.xxhash64(whole_text()) == F.col("cut_tie")), "left")
    starts, ends = F.concat(F.array(F.lit(0).cast("long")), F.col("cut.end")), F.concat(F.col("cut.start"), F.array(F.char_length("text").cast("long")))
    pieces = F.zip_with(starts, ends, lambda a, b: F.substring(F.col("text"), (a + 1).cast("int"), (b - a).cast("int")))

    def put(before: Column, piece: Column) -> Column:
        blank = before.rlike(r"[ \t]\z")
        return F.when(blank, F.concat(F.regexp_replace(before, r"[ \t]+\z", ""), piece)).otherwise(F.concat(before, F.regexp_replace(piece, r"\A[ \t\r]*\n?", "")))

    rest = F.slice(pieces, 2, F.size(pieces))
    text = F.aggregate(rest, F.element_at(pieces, 1), put)
    return _with_text(joined, F.col("cut").isNotNull(), text, docs)


def without_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` without the lines alone that :func:`repeated_passages` finds; ``n_chars`` follows where there is such a column."""
    gone = repeated_passages(docs).groupBy("doc_id", "tie").agg(F.collect_set("place").alias("gone"))
    gone = gone.select(F.col("doc_id").alias("gone_id"), F.col("tie").alias("gone_tie"), "gone")
    joined = docs.join(gone, (F.col("doc_id") == F.col("gone_id")) & (F.xxhash64(whole_text()) == F.col("gone_tie")), "left")
    text = F.array_join(F.filter(F.split("text", "\n"), lambda line, i: ~F.array_contains("gone", i)), "\n")
    return _with_text(joined, F.col("gone").isNotNull(), text, docs)
