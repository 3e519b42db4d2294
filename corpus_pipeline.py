"""From raw documents to packed training sequences: each stage works on all that the one before has kept.

Rows: stages keep the columns of documents but for the last, which gives placed pieces. Null texts count as empty; rows
without id cannot be linked and stay as they are; repeated rows are one document after the second stage; an empty table
goes through empty. Texts that lose lines or personal data get their new ``n_chars``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from parcelmetrics.llm import jaccard, packing, paragraphs, pii, toxicity
from parcelmetrics.llm.common import scratch_path, whole_text
from parcelmetrics.llm.queries import BYTE_BPE, BYTE_RANKS
from parcelmetrics.llm.tokens import public_path

END_ID = 1
ORACLE_SQL = None


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain does not reject."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.toxic_documents(docs, labels).where("not toxic").select(docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that shingles link, directly or not, the one with the least id; of rows with equal id and text one."""
    found = jaccard.text_components(docs).where("doc_id is not null and (first is null or (doc_id = first.doc_id and tie = first.tie))")
    found = found.select("doc_id", F.col("tie").alias("tie_found")).distinct()
    own = docs.withColumn("tie_found", F.xxhash64(whole_text()))
    first = Window.partitionBy("doc_id", "tie_found").orderBy("text")
    kept = own.join(found, ["doc_id", "tie_found"]).withColumn("nth", F.row_number().over(first)).where("nth = 1").select(docs.columns)
    return kept.unionByName(docs.where("doc_id is null"))


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without runs of over 50 words that occur before, and without long lines that an earlier document nearly has."""
    return paragraphs.without_passages(docs)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with the kind of each span of personal data in its place."""
    found = pii.personal_data(docs).where(F.size("all_spans") > 0).dropDuplicates(["doc_id", "tie"])
    found = found.select(F.col("doc_id").alias("span_id"), F.col("tie").alias("span_tie"), "all_spans")
    joined = docs.join(found, F.col("doc_id").eqNullSafe(F.col("span_id")) & (F.xxhash64(whole_text()) == F.col("span_tie")), "left")
    some = F.col("all_spans").isNotNull()
    joined = joined.withColumn("text", F.when(some, pii.redacted(F.col("text"), F.col("all_spans"))).otherwise(F.col("text")))
    n_chars = F.char_length("text").cast(docs.schema["n_chars"].dataType)
    return joined.withColumn("n_chars", F.when(some, n_chars).otherwise(F.col("n_chars"))).select(docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Placed pieces of the tokenized documents in windows of 2048 ids."""
    return packing.packed_documents(docs, public_path(BYTE_BPE), public_path(BYTE_RANKS), END_ID)


STAGES = [
    ("toxicity", reject_toxic),
    ("ngram_jaccard", one_of_each_group),
    ("substring_dedup", drop_repeated_passages),
    ("personal_data", redact_personal_data),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of ``sf_dir``, each written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
