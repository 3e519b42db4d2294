"""Text to token ids in Arrow batches, through caches of the distinct chunks between spaces."""

from __future__ import annotations

import base64
import os
import re
from collections.abc import Callable, Iterable, Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: A worker forgets its distinct chunks beyond so many, or so many characters of them; only speed depends on it.
CACHED_CHUNKS, CACHED_CHARACTERS = 500_000, 16_000_000

Ragged = tuple[np.ndarray, np.ndarray]  # lengths, values


def public_path(name: str) -> str:
    """Where the public vocabulary file ``name`` lies."""
    import public_tokenizers

    return public_tokenizers.path(name)


def gather(starts: np.ndarray, lengths: np.ndarray, flat: np.ndarray) -> np.ndarray:
    """The slices ``flat[start:start + length]`` one after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.repeat(starts - (ends - lengths), lengths) + np.arange(total)]


class SliceCache:
    """Ids by key; new keys are encoded together by ``encode_new``, which returns lengths and ids in their order."""

    def __init__(self, encode_new: Callable[[list], Ragged], most: int = CACHED_CHUNKS):
        self._encode_new, self._most = encode_new, most
        self.clear()

    def clear(self) -> None:
        cache = self

        class Index(dict):
            def __missing__(self, key):
                cache.new.append(key)
                k = self[key] = len(self)
                return k

        self.index, self.new, self._characters = Index(), [], 0
        self.starts, self.lengths, self.flat = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)

    def indices(self, keys: Sequence) -> np.ndarray:
        return np.fromiter(map(self.index.__getitem__, keys), np.int64, len(keys))

    def fill(self) -> None:
        if self.new:
            self._characters += sum(len(k[0]) if type(k) is tuple else 1 if type(k) is int else len(k) for k in self.new)
            lengths, flat = self._encode_new(self.new)
            lengths = lengths.astype(np.int64)
            self.starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(lengths) - lengths])
            self.lengths = np.concatenate([self.lengths, lengths])
            self.flat = np.concatenate([self.flat, flat.astype(np.int32)])
            self.new = []

    def expand(self, indices: np.ndarray) -> Ragged:
        """Lengths and ids of the keys with these indices."""
        self.fill()
        lengths = self.lengths[indices]
        return lengths, gather(self.starts[indices], lengths, self.flat)

    def trim(self) -> None:
        if len(self.index) > self._most or self._characters > CACHED_CHARACTERS:
            self.clear()


def summed(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of ``counts`` consecutive values each."""
    ends = np.concatenate([[0], np.cumsum(values)])
    at = np.cumsum(counts)
    return ends[at] - ends[at - counts]


class ByteEncoder:
    """Ids as the tokenizers library gives them for the byte-level vocabulary, without special tokens added.

    A space after a character that isn't white space always begins a new piece of the vocabulary's pattern, so the text
    between such spaces can be encoded by itself, and each distinct chunk once. Chunks of Latin letters go to tiktoken,
    which has the same ranks and is several times faster; all others, and texts with a special token, to tokenizers.
    """

    _SPECIAL = "<|endoftext|>"
    _LATIN = re.compile(r"[\x00-ɏ]*")
    _JOINED = 20_000

    def __init__(self, json_path: str, ranks_path: str):
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self._exact = Tokenizer.from_file(json_path)
        self._exact.no_truncation()
        self._exact.no_padding()
        with open(ranks_path, "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        self._fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self._spaced = np.zeros(max(ranks.values()) + 2, bool)
        self._spaced[[i for b, i in ranks.items() if b[:1] == b" "]] = True
        self._cache = SliceCache(self._encode_new)

    def whole(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self._exact.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode_new(self, keys: list) -> Ragged:
        # The first chunk of a text comes as a tuple, all others are preceded by a space.
        found: list = [None] * len(keys)
        joined, rare = [], []
        for k, key in enumerate(keys):
            chunk = key[0] if type(key) is tuple else " " + key
            if not self._LATIN.fullmatch(chunk):
                rare.append((k, chunk))
            elif type(key) is tuple or not key or " " in key:
                found[k] = self._fast.encode_ordinary(chunk)
            else:
                joined.append(k)
        for (k, _), ids in zip(rare, self.whole([c for _, c in rare])):
            found[k] = ids
        for at in range(0, len(joined), self._JOINED):
            some = joined[at : at + self._JOINED]
            ids = np.array(self._fast.encode_ordinary(" " + " ".join([keys[k] for k in some])), np.int32)
            cuts = np.flatnonzero(self._spaced[ids])
            assert len(cuts) == len(some) and cuts[0] == 0
            for k, part in zip(some, np.split(ids, cuts[1:])):
                found[k] = part
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        flat = np.concatenate([np.asarray(x, np.int32) for x in found]) if found else np.zeros(0, np.int32)
        return lengths, flat

    def _chunks(self, text: str) -> list:
        chunks = re.split(r"(?<=\S) ", text) if "  " in text else text.split(" ")
        chunks[0] = (chunks[0],)
        return chunks

    def encode(self, texts: list[str | None]) -> Ragged:
        """Numbers of ids and all ids, of each text in turn; null counts as empty."""
        texts = [t or "" for t in texts]
        odd = [k for k, t in enumerate(texts) if self._SPECIAL in t]
        chunks = [self._chunks("" if self._SPECIAL in t else t) for t in texts]
        counts = np.fromiter(map(len, chunks), np.int64, len(chunks))
        indices = self._cache.indices([c for own in chunks for c in own])
        lengths, flat = self._cache.expand(indices)
        totals = summed(lengths, counts)
        self._cache.trim()
        if odd:
            parts = np.split(flat, np.cumsum(totals)[:-1])
            for k, ids in zip(odd, self.whole([texts[k] for k in odd])):
                parts[k] = np.array(ids, np.int32)
            totals, flat = np.array([len(p) for p in parts]), np.concatenate(parts)
        return totals, flat


    def release(self) -> None:
        """Forget the chunks: a worker is used again, also by stages that encode nothing."""
        self._cache.clear()


@lru_cache(maxsize=4)
def byte_encoder(json_path: str, ranks_path: str) -> ByteEncoder:
    """One encoder for each worker process, which Spark uses again for later tasks."""
    return ByteEncoder(json_path, ranks_path)


def int_lists(lengths: np.ndarray, flat: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.astype(np.int32)))


def small_batches(batches: Iterable[pa.RecordBatch], column: str, most: int = 8_000_000) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``most`` bytes of ``column``, so that memory does not depend on text length."""
    for batch in batches:
        if not batch.num_rows:
            continue
        values = batch.column(column)
        length = pc.list_value_length if pa.types.is_list(values.type) else pc.binary_length
        sizes = length(values).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        group = np.cumsum(sizes) // most
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(group)) + 1, [batch.num_rows]])
        for a, b in zip(cuts[:-1], cuts[1:]):
            yield batch.slice(a, b - a)


def with_column(df: DataFrame, name: str, kind: T.DataType, of: str, make: Callable[[], Callable[[list], pa.Array]], most: int = 8_000_000) -> DataFrame:
    """``df`` with column ``name`` computed in Arrow batches from column ``of``; a column of that name is replaced.

    ``make`` runs in the worker and returns the function from the values of a batch to an Arrow array.
    """
    df = df if of.lower() == name.lower() else df.drop(name)
    schema = T.StructType([f for f in df.schema if f.name.lower() != name.lower()] + [T.StructField(name, kind)])
    names = [f.name for f in schema][:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        convert = make()
        for batch in small_batches(batches, of, most):
            made = convert(batch.column(of).to_pylist())
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], made], [*names, name])

    return df.mapInArrow(run, schema)


def runs(batches: Iterable[pa.RecordBatch], by: list[str]) -> Iterator[pa.Table]:
    """Consecutive rows with equal integer columns ``by``, run after run; the rows must come sorted by them."""
    held: list[pa.RecordBatch] = []
    last: tuple | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in by], 1)
        cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts[:-1], cuts[1:]):
            key = tuple(keys[a].tolist())
            if key != last and held:
                yield pa.Table.from_batches(held)
                held = []
            last = key
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)
