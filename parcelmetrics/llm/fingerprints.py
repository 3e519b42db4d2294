"""Document fingerprints by one-permutation MinHash with optimal densification, packed low-order bits, bias correction.

Every five-word shingle is hashed once. The top bits of a hash name its bin, the least hash of a bin is the bin's value. An
empty bin takes the value of a bin that it finds by its own sequence of hashed probes (Shrivastava 2017): the same sequence
for every document, so that like documents fill alike. Each bin keeps its lowest four bits. Chance agreement of four bits
is taken out of the share of equal bins (Li and Koenig 2010). Built-in functions only.

Rows: null text counts as empty; a text of fewer than five words is one shingle, an empty one the shingle of no word, so
every text has a fingerprint and equal texts have equal ones; repeated rows keep their own place in the order; an empty
table gives no rows. Words are parted by white space of ASCII.
"""

from __future__ import annotations

import random

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelmetrics.llm.common import whole_text

BINS, BIN_BITS, KEPT_BITS, WORDS = 256, 8, 4, 5
#: Probes that an empty bin makes before it ranks all filled bins by a hash.
PROBES = 8


def _longs(values: list[int]) -> Column:
    return F.expr("array(" + ",".join(f"{v}L" if v > -(1 << 63) else "-9223372036854775807L - 1L" for v in values) + ")")


def with_fingerprint(df: DataFrame, text: str, out: str) -> DataFrame:
    """``df`` with ``out``: 16 longs of 16 four-bit bins each. ``text`` must not be null."""
    low = (1 << (64 - BIN_BITS)) - 1
    ends = _longs([((b - BINS // 2) << (64 - BIN_BITS)) | low for b in range(BINS)])
    dice = random.Random(BINS)
    probes = [F.expr(f"array({','.join(str(dice.randrange(BINS)) for _ in range(BINS))})") for _ in range(PROBES)]
    words, hashes, ordered, bins, filled, kept = (f"{out}__{k}" for k in range(6))
    df = df.withColumn(words, F.transform(F.filter(F.split(text, r"[ \t-\r]+"), lambda w: w != ""), lambda w: F.xxhash64(w)))
    n = F.size(words)
    shingles = F.transform(F.sequence(F.lit(0), n - WORDS), lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WORDS)]))
    df = df.withColumn(hashes, F.when(n >= WORDS, shingles).otherwise(F.array(F.xxhash64(words))))
    # The largest value of each bin marks it, so that the first of each bin is its least hash or the mark.
    df = df.withColumn(ordered, F.sort_array(F.concat(hashes, ends)))
    bin_of = lambda x: F.shiftright(x, 64 - BIN_BITS)
    first = F.filter(ordered, lambda x, i: (i == 0) | (bin_of(x) != bin_of(F.get(ordered, i - 1))))
    df = df.withColumn(bins, F.transform(first, lambda x: F.when(x.bitwiseAND(F.lit(low)) != low, x)))
    df = df.withColumn(filled, F.filter(bins, lambda x: x.isNotNull()))

    def by_rank(i: Column) -> Column:
        rank = lambda x: F.xxhash64(i, bin_of(x)).bitwiseAND(F.lit(-BINS)).bitwiseOR(bin_of(x) + BINS // 2)
        best = F.get(bins, F.array_min(F.transform(filled, rank)).bitwiseAND(F.lit(BINS - 1)).cast("int"))
        return F.when(F.size(filled) > 0, best)

    found = lambda i: F.coalesce(F.get(bins, i), *[F.get(bins, F.get(p, i)) for p in probes], by_rank(i))
    # Hashed with its bin, a value that fills many bins does not agree or differ in all of them at once.
    df = df.withColumn(kept, F.transform(F.sequence(F.lit(0), F.lit(BINS - 1)), lambda i: F.xxhash64(found(i), i).bitwiseAND(F.lit((1 << KEPT_BITS) - 1))))
    per_long = 64 // KEPT_BITS
    packed = F.transform(
        F.sequence(F.lit(0), F.lit(BINS // per_long - 1)),
        lambda j: F.aggregate(F.slice(kept, j * per_long + 1, per_long), F.lit(0).cast("long"), lambda a, x: F.shiftleft(a, KEPT_BITS).bitwiseOR(x)),
    )
    # A second use of ``kept`` (and above of ``filled``) keeps the optimizer from computing it anew for each element.
    return df.withColumn(out, F.when(F.size(kept) > 0, packed)).drop(words, hashes, ordered, bins, filled, kept)


def as_text(packed: str) -> Column:
    """A fingerprint in hexadecimal, one digit for each bin."""
    return F.array_join(F.transform(packed, lambda p: F.lpad(F.lower(F.hex(p)), 64 // KEPT_BITS, "0")), "")


def likeness(a: str, b: str) -> Column:
    """Estimated Jaccard similarity of two fingerprints, 0 to 1."""
    ones = 0x1111111111111111

    def unequal(x: Column) -> Column:
        folded = x.bitwiseOR(F.shiftrightunsigned(x, 1))
        return F.bit_count(folded.bitwiseOR(F.shiftrightunsigned(folded, 2)).bitwiseAND(F.lit(ones)))

    differ = F.aggregate(F.zip_with(a, b, lambda x, y: unequal(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)
    chance = 1 / (1 << KEPT_BITS)
    return F.greatest(F.lit(0.0), (1 - differ / BINS - chance) / (1 - chance))


def with_next(docs: DataFrame, carried: list[str]) -> DataFrame:
    """``docs`` (doc_id long, tie, ...) with ``next_<c>`` of the next document in ascending (doc_id, tie), the first after the last.

    Ids are dealt into buckets of like size between their quantiles, so each window holds one bucket, wherever ids lie. A
    bucket also gets the first document of the next one as a guest, which is dropped afterwards. Rows with one id stay together.
    """
    spark = docs.sparkSession
    buckets = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    shares = [k / buckets for k in range(1, buckets)]
    borders = docs.select(F.percentile_approx("doc_id", shares, 10 * buckets)).first()[0]
    borders = sorted(set(borders or []))
    # The number of borders below an id, by a binary search; ids up to a border are in the bucket before it.
    array = F.array(*[F.lit(b).cast("long") for b in borders]) if borders else F.array().cast("array<bigint>")
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(len(borders).bit_length()))]) if borders else F.array().cast("array<int>")

    def passed(done: Column, step: Column) -> Column:
        return F.when((done + step <= len(borders)) & (F.get(array, done + step - 1) < F.col("doc_id")), done + step).otherwise(done)

    bucketed = F.aggregate(steps, F.lit(0), passed)
    # At most one row for each bucket: its first document.
    tops = docs.groupBy(bucketed.alias("bucket")).agg(F.min(F.struct("doc_id", "tie")).alias("first")).orderBy("bucket").collect()
    if not tops:
        return docs.select("*", *[F.col(c).alias(f"next_{c}") for c in carried])
    held = [t.bucket for t in tops]
    firsts = [t.first for t in tops]
    guests = spark.createDataFrame([(f.doc_id, f.tie, held[k - 1]) for k, f in enumerate(firsts)], "guest_id long, guest_tie long, bucket int")
    # At most one guest for each bucket.
    guest = docs.join(F.broadcast(guests), F.col("doc_id").eqNullSafe(F.col("guest_id")) & (F.col("tie") == F.col("guest_tie"))).drop("guest_id", "guest_tie")
    both = docs.withColumn("bucket", bucketed).withColumn("guest", F.lit(False)).unionByName(guest.withColumn("guest", F.lit(True)))
    order = Window.partitionBy("bucket").orderBy("guest", F.col("doc_id").asc_nulls_first(), "tie")
    return both.select("*", *[F.lead(c).over(order).alias(f"next_{c}") for c in carried]).where("not guest").drop("bucket", "guest")


def fingerprints(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Fingerprints of the texts and of their edited texts, with likenesses; see the contract of the query."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), whole_text(text).alias("text")).withColumn("tie", F.xxhash64("text"))
    chained = with_next(with_fingerprint(rows, "text", "own"), ["text", "own"])
    changed = F.floor(F.char_length("text") / 4).cast("int")
    chained = chained.withColumn("n_chars", F.char_length("text").cast("long"))
    edited = F.concat(F.col("text").substr(F.lit(1), F.col("n_chars").cast("int") - changed), F.col("next_text").substr(F.lit(1), changed))
    chained = with_fingerprint(chained.withColumn("edited", edited).drop("next_text", "text"), "edited", "other")
    return chained.select(
        "doc_id",
        "n_chars",
        F.sha2(F.encode("edited", "utf-8"), 256).alias("edited_sha256"),
        as_text("own").alias("fingerprint"),
        as_text("other").alias("edited_fingerprint"),
        likeness("own", "other").alias("near_edited"),
        likeness("own", "next_own").alias("near_next"),
    )
