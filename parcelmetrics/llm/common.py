"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bits that tell which keys may be in a table.
MARKS = 1 << 24

def scratch_root(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``, or one in the warehouse where it is unset."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    return root or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/scratch"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder, deleted when the driver's JVM ends."""
    path = f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(hadoop_path)
    return path


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once in the shared folder and read back: its lineage ends there, so a lost executor costs a re-read."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_staged(df: DataFrame) -> None:
    """Delete the files of a :func:`staged` table that nothing reads any more."""
    spark = df.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop_path, True)


def whole_text(name: str = "text") -> Column:
    """The text, with null as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def with_mark(rows: DataFrame, few: DataFrame, keys: list[str], name: str) -> DataFrame:
    """``rows`` with ``name``: false only where the ``keys`` are in no row of ``few``, true in some such rows as well.

    Keys set bits by their hash, and these alone are broadcast, at most ``MARKS`` of them. So wide rows without a partner are
    left out before a join moves them; the join itself decides.
    """
    slot = F.pmod(F.xxhash64(*keys), F.lit(MARKS)).cast("int")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("mark_slot") % 64)
    marks = few.select(slot.alias("mark_slot")).groupBy(F.shiftright("mark_slot", 6).alias("mark_of")).agg(F.bit_or(bit).alias("marks"))
    joined = rows.withColumn("mark_slot", slot).join(F.broadcast(marks), F.shiftright("mark_slot", 6) == F.col("mark_of"), "left")
    return joined.withColumn(name, F.coalesce(F.col("marks").bitwiseAND(bit) != 0, F.lit(False))).drop("mark_slot", "mark_of", "marks")


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of the undirected ``edges`` (a long, b long): rows (id, component), component the least id.

    Rows with a null end or a loop are ignored; repeated edges count once; no edges, no rows. Alternates the two star
    contractions of Kiveris et al., "Connected Components in MapReduce and Beyond" (2014): large-star links the larger
    neighbours of each node to its least neighbour, small-star the smaller ones. Both take the least neighbour by a
    map-side aggregate, so a node with very many neighbours is never gathered. Rounds are written to the shared folder.
    """

    def with_least(pairs: DataFrame) -> DataFrame:
        least = pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        return pairs.join(least, "u")

    def both_ways(links: DataFrame) -> DataFrame:
        return links.select(F.col("a").alias("u"), F.col("b").alias("v")).union(links.select(F.col("b"), F.col("a")))

    links = staged(
        edges.where("a is not null and b is not null and a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "links",
    )
    before = None
    for _ in range(max_rounds):
        large = with_least(both_ways(links)).where("v > u and v <> m").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        small_in = large.select(F.col("a").alias("u"), F.col("b").alias("v"))
        small = with_least(small_in)
        linked = (
            small.where("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b")).union(small.select(F.col("u"), F.col("m")))
        )
        new = staged(linked.where("a <> b").distinct(), "links")
        # The links are a set; equal counts and sums of hashes mean that nothing has moved.
        now = new.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        drop_staged(links)
        links = new
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = links.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    return links.select(F.col("a").alias("id"), F.col("b").alias("component")).union(roots)
