"""Encoding, files and packing against the tokenizers library and exact round trips."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from parcelmetrics.llm import bpe, huffman, packing
from parcelmetrics.llm.bpe import WordVocabulary
from parcelmetrics.llm.common import scratch_path
from parcelmetrics.llm.tokens import ByteEncoder, public_path

WORD, BYTE, RANKS = public_path("word_bpe_49k.json"), public_path("byte_bpe_50k.json"), public_path("byte_bpe_50k.tiktoken")
ODD = ["", "  ", "a  b   c", " x", " \n b", "a\n <|endoftext|> b", "<|startoftext|>hi<|endoftext|>", "É é Σας ΑΣ İstanbul ß", "日本語 テスト　x", "a\x1cb \x85 c\xa0d", "it's we'LL 123 4½ ²", "aaaa aaaaaaa hahahaha", "🙂🙂 ok", "a   \n\n  b \t c  ", "!!! ..?!", "́x", "word " * 30000]


def texts():
    dice = random.Random(1)
    parts = ["a", "B", " ", "\n", "'s", "é", "Σ", "1", ".", "  ", "\t", "日", "́", "<|endoftext|>", "🙂", "x" * 30]
    return ODD + ["".join(dice.choice(parts) for _ in range(dice.randint(1, 30))) for _ in range(300)]


@pytest.mark.parametrize("make, path", [(lambda: WordVocabulary(WORD), WORD), (lambda: ByteEncoder(BYTE, RANKS), BYTE)])
def test_ids_are_those_of_the_library(make, path):
    own, library = make(), Tokenizer.from_file(path)
    counts, flat = own.encode(texts())
    got = [x.tolist() for x in np.split(flat, np.cumsum(counts)[:-1])]
    want = [e.ids for e in library.encode_batch(texts(), add_special_tokens=False)]
    assert got == want
    if path == WORD:
        assert [bpe.decoded(bpe.tokens(WORD), x) for x in want] == [library.decode(x, skip_special_tokens=False) for x in want]


def test_bpe_columns(spark):
    df = spark.createDataFrame([(1, None, "z"), (2, "Hello hello", "z"), (2, "Hello hello", "z")], "doc_id long, text string, IDS string")
    rows = bpe.decode(bpe.encode(df, WORD), WORD).orderBy("doc_id").collect()
    assert [len(r.ids) for r in rows] == [0, 2, 2] and rows[0].decoded == "" and rows[1].decoded == "hello</w> hello</w>"
    assert bpe.encode(df.limit(0), WORD).count() == 0


def documents(spark):
    rows = [(k, t) for k, t in enumerate(texts())] + [(9000, None), (9001, "x " * 5000), (9002, "y"), (9002, "y")]
    random.Random(2).shuffle(rows)
    return spark.createDataFrame(rows, "doc_id long, text string").withColumn("start", F.lit("clash")).repartition(4), sorted(rows, key=lambda r: r[0])


def test_files_read_back(spark):
    docs, rows = documents(spark)
    library, path = Tokenizer.from_file(BYTE), scratch_path(spark, "files")
    huffman.write_ids(docs, path, BYTE, RANKS, 0)
    got = huffman.read_ids(spark, path).orderBy("start").collect()
    start = 0
    for r, (doc_id, text) in zip(got, rows, strict=True):
        ids = library.encode(text or "", add_special_tokens=False).ids + [0]
        assert (r.doc_id, r.start, r.n_tokens) == (doc_id, start, len(ids)) and np.frombuffer(r.ids, "<u4").tolist() == ids
        start += len(ids)
    empty = scratch_path(spark, "files")
    huffman.write_ids(docs.limit(0), empty, BYTE, RANKS, 0)
    assert huffman.read_ids(spark, empty).count() == 0


def test_code_lengths_are_limited_and_complete():
    for counts in ([5], [1, 1], [2**k for k in range(30)], list(range(1, 400))):
        lengths = huffman.code_lengths(np.array(counts))
        assert lengths.max() <= 16 and (len(counts) == 1 or sum(0.5**x for x in lengths.tolist()) == 1)


def test_pieces_and_sequences(spark):
    docs, rows = documents(spark)
    library = Tokenizer.from_file(BYTE)
    pieces = packing.cut_documents(docs, BYTE, RANKS, 1)
    path = scratch_path(spark, "pieces")
    pieces.write.parquet(path)
    packed = packing.pack(spark.read.parquet(path))
    got = packed.toPandas().sort_values(["sequence_id", "offset"])
    ends = got.groupby("sequence_id")["length"].cumsum()
    assert (ends - got["length"] == got["offset"]).all() and ends.max() <= 2048
    by_doc = {}
    for r in got[got.doc_id != 9002].itertuples():
        by_doc.setdefault(r.doc_id, {})[r.start] = np.frombuffer(r.ids, "<u4").tolist()
    for doc_id, text in rows:
        if doc_id != 9002:
            ids = library.encode(text or "", add_special_tokens=False).ids + [1]
            assert sum((by_doc[doc_id][k] for k in sorted(by_doc[doc_id])), []) == ids
    assert (got.doc_id == 9002).sum() == 2
    slim = packing.packed_documents(docs, BYTE, RANKS, 1).toPandas()
    assert sorted(slim.ids_crc32) == sorted(zlib.crc32(x) for x in got.ids)
    assert packing.sequences(packed).count() == got.sequence_id.nunique()
    assert packing.packed_documents(docs.limit(0), BYTE, RANKS, 1).count() == 0


def test_plan_uses_every_piece_once():
    dice = np.random.default_rng(3)
    for histogram in (dice.integers(0, 50, 2049), np.eye(1, 2049, 1500, dtype=np.int64)[0] * 9, np.zeros(2049, np.int64)):
        used = np.zeros(2049, np.int64)
        for lengths, repeats in packing.plan(histogram):
            assert sum(lengths) <= 2048
            np.add.at(used, list(lengths), repeats)
        assert (used[1:] == histogram[1:]).all()
