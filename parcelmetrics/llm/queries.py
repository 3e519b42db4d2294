"""One query for each operator, over its whole table with production parameters, and the pipeline."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelmetrics.llm import backoff, bpe, centroids, collocations, fingerprints, huffman, jaccard, neardup, packing, paragraphs, pii, toxicity, wrappers
from parcelmetrics.llm import checks
from parcelmetrics.llm.common import scratch_path
from parcelmetrics.llm.tokens import public_path

WORD_BPE = "word_bpe_49k.json"
BYTE_BPE, BYTE_RANKS = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    path = public_path(WORD_BPE)
    both = bpe.decode(bpe.encode(docs, path).drop("text"), path)
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "utf-8"), 256).alias("decoded_sha256"),
    )


def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(_table(spark, sf_dir, "documents"))


def op3_embedding_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paragraphs.repeated_spans(_table(spark, sf_dir, "documents")).select("doc_id", "start", "end", "kept_doc_id")


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_documents(_table(spark, sf_dir, "documents"), public_path(BYTE_BPE), public_path(BYTE_RANKS), 1)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity.toxic_documents(docs, _table(spark, sf_dir, "labels")).drop("text")


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(_table(spark, sf_dir, "documents"))


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    huffman.write_ids(_table(spark, sf_dir, "documents"), path, public_path(BYTE_BPE), public_path(BYTE_RANKS), 0)
    return huffman.read_ids(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.personal_data(_table(spark, sf_dir, "documents"))

    def number(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *map(number, pii.KINDS),
        F.sha2(pii.as_list("spans"), 256).alias("base_sha256"),
        pii.as_list("all_spans").alias("spans"),
        F.size("all_spans").cast("long").alias("n_spans"),
    )


def op10_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrappers.main_text(_table(spark, sf_dir, "pages")).withColumn("n_chars", F.char_length("text").cast("long"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_table(spark, sf_dir, "documents").select("lang", "text"))


def op12_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return backoff.score(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.clusters(_table(spark, sf_dir, "embeddings"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    "op1_bpe": op1_bpe,
    "op2_ngram_jaccard": op2_ngram_jaccard,
    "op3_embedding_neardup": op3_embedding_neardup,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_packing": op5_packing,
    "op6_toxicity": op6_toxicity,
    "op7_fingerprints": op7_fingerprints,
    "op8_token_files": op8_token_files,
    "op9_personal_data": op9_personal_data,
    "op10_main_text": op10_main_text,
    "op11_collocations": op11_collocations,
    "op12_lm_scores": op12_lm_scores,
    "op13_centroids": op13_centroids,
    "pipeline": pipeline,
}
#: The others can't be said in SQL; tests compare them with brute force, the tokenizers library or held-out labels.
ORACLE_SQL: dict[str, str] = {"op11_collocations": checks.COLLOCATIONS, "op13_centroids": checks.centroids()}
