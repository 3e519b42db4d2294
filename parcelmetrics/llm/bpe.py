"""BPE encoding and decoding by an index of pair occurrences.

All distinct words of a batch lie in one array of symbols. An index has the positions of each pair that the vocabulary
can merge. Ranks are applied in ascending order, each to all its positions at once, and every merge puts the pairs to its
left and right into the lists of their ranks. A rank's pairs only consist of symbols that lower ranks have made (checked
when the vocabulary is read), so this gives the ids of merging each word by itself, lowest rank first.

Rows: null text counts as empty and has no ids; a repeated row is encoded like any other; an empty table gives an empty
table; other columns pass through, one with the name of the output is replaced. A text of any length is encoded whole.
"""

from __future__ import annotations

import heapq
import json
import os
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from parcelmetrics.llm.tokens import Ragged, SliceCache, int_lists, summed, with_column


#: Bytes of text encoded together, and distinct chunks and words that a worker remembers; only memory and speed depend on them.
BATCH_BYTES, REMEMBERED = 4_000_000, 250_000


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return [chr(b) if b in plain else chr(256 + others.index(b)) for b in range(256)]


class PairMerger:
    """Merges the symbols of many words by the vocabulary's ranks."""

    def __init__(self, left: np.ndarray, right: np.ndarray, made: np.ndarray, size: int):
        self.left, self.right, self.made, self.size = left, right, made, size
        keys = left.astype(np.int64) * size + right
        self._order = np.argsort(keys)
        self._keys = keys[self._order]
        born = np.full(size, -1)
        np.maximum.at(born, made, np.arange(len(made)))
        if len(made) and (np.maximum(born[left], born[right]) >= np.arange(len(made))).any():
            raise ValueError("a merge uses a symbol that a later merge makes")

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, -1 where it does not merge."""
        if not len(self._keys):
            return np.full(len(left), -1)
        keys = left.astype(np.int64) * self.size + right
        at = np.minimum(np.searchsorted(self._keys, keys), len(self._keys) - 1)
        return np.where(self._keys[at] == keys, self._order[at], -1)

    def merge(self, symbols: np.ndarray, lengths: np.ndarray) -> Ragged:
        """Numbers of ids and ids of words given as consecutive symbols."""
        n = len(symbols)
        if not n:
            return np.zeros(len(lengths), np.int64), symbols
        word = np.repeat(np.arange(len(lengths)), lengths)
        same = np.append(word[1:] == word[:-1], False)
        after = np.where(same, np.arange(1, n + 1), -1)
        before = np.where(np.append(False, same[:-1]), np.arange(-1, n - 1), -1)
        sym = symbols.astype(np.int64)
        occurrences: dict[int, list[np.ndarray]] = {}
        active: list[int] = []

        def enter(at: np.ndarray) -> None:
            ranks = self.ranks(sym[at], sym[after[at]])
            at, ranks = at[ranks >= 0], ranks[ranks >= 0]
            if not len(at):
                return
            order = np.argsort(ranks, kind="stable")
            at, ranks = at[order], ranks[order]
            cuts = np.flatnonzero(np.diff(ranks)) + 1
            for rank, part in zip(ranks[np.append(0, cuts)].tolist(), np.split(at, cuts)):
                if rank in occurrences:
                    occurrences[rank].append(part)
                else:
                    occurrences[rank] = [part]
                    heapq.heappush(active, rank)

        # Who wrote a place last: leaves one of repeated places without sorting them.
        last = np.empty(n, np.int32)

        def distinct(at: np.ndarray) -> np.ndarray:
            k = np.arange(len(at), dtype=np.int32)
            last[at] = k
            return at[last[at] == k]

        enter(np.flatnonzero(same))
        while active:
            rank = heapq.heappop(active)
            parts = occurrences.pop(rank)
            at = parts[0] if len(parts) == 1 else distinct(np.concatenate(parts))
            a, b, made = self.left[rank], self.right[rank], self.made[rank]
            at = at[(sym[at] == a) & (after[at] >= 0)]
            at = at[sym[after[at]] == b]
            if a == b and len(at) > 1:  # of overlapping pairs the first, third and so on
                at = np.sort(at)
                k = np.arange(len(at))
                first = np.maximum.accumulate(np.where(np.append(True, at[1:] != after[at[:-1]]), k, 0))
                at = at[(k - first) % 2 == 0]
            if not len(at):
                continue
            gone = after[at]
            later = after[gone]
            sym[at], sym[gone], after[at] = made, -1, later
            before[later[later >= 0]] = at[later >= 0]
            earlier = before[at]
            enter(distinct(np.concatenate([earlier[earlier >= 0], at[later >= 0]])))
        alive = sym >= 0
        return np.bincount(word[alive], minlength=len(lengths)), sym[alive]


class WordVocabulary:
    """A vocabulary file of kind BPE with word ends: its own normalizer and splitting, merges by :class:`PairMerger`."""

    _LATIN = re.compile(r"[\x00-ɏ]*")

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        ids, merges = spec["model"]["vocab"], spec["model"]["merges"]
        self.end = spec["model"].get("end_of_word_suffix") or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max(*ids.values(), *self.special.values()) + 1
        left, right = (np.array([ids[m[k]] for m in merges], np.int64) for k in (0, 1))
        self._merger = PairMerger(left, right, np.array([ids[a + b] for a, b in merges], np.int64), size)
        letters = byte_letters()
        self._inner = np.array([ids[c] for c in letters], np.int64)
        self._last = np.array([ids[c + self.end] for c in letters], np.int64)
        self._bytes = {c: b for b, c in enumerate(letters)}
        library = Tokenizer.from_file(path)
        self._normalizer, self._splitter = library.normalizer, library.pre_tokenizer
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")["pattern"]["Regex"]
        self._pattern = regex.compile(" |" + split)
        self._special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self._words = SliceCache(self._merge_words, REMEMBERED)
        self._chunks = SliceCache(self._encode_chunks, REMEMBERED)

    def _merge_words(self, words: list) -> Ragged:
        # A word is bytes; a special token comes as its id.
        lengths = np.array([len(w) if type(w) is bytes else 0 for w in words], np.int64)
        raw = np.frombuffer(b"".join([w for w in words if type(w) is bytes]), np.uint8)
        ends = np.cumsum(lengths)
        symbols = self._inner[raw]
        last = ends[lengths > 0] - 1
        symbols[last] = self._last[raw[last]]
        counts, ids = self._merger.merge(symbols, lengths)
        special = [(k, w) for k, w in enumerate(words) if type(w) is int]
        if special:
            at = np.cumsum(counts)[[k for k, _ in special]]
            ids = np.insert(ids, at, [w for _, w in special])
            counts[[k for k, _ in special]] = 1
        return counts, ids

    def _split(self, chunk: str) -> list:
        """Words of a chunk by the library's own normalizer and splitter, special tokens as ids."""
        words: list = []
        for part in self._special.split(chunk) if self._special else [chunk]:
            if part in self.special:
                words.append(self.special[part])
            elif part:
                pieces = self._splitter.pre_tokenize_str(self._normalizer.normalize_str(part))
                words += [bytes(map(self._bytes.__getitem__, piece)) for piece, _ in pieces]
        return words

    def _encode_chunks(self, chunks: list[str]) -> Ragged:
        plain = [bool(self._LATIN.fullmatch(c)) and not (self._special and self._special.search(c)) for c in chunks]
        # Latin letters are as the normalizer leaves them but for case; a space ends each chunk.
        found = self._pattern.findall("".join([c + " " for c, p in zip(chunks, plain) if p]).lower())
        ends = np.fromiter((w == " " for w in found), bool, len(found))
        own = np.diff(np.append(-1, np.flatnonzero(ends))) - 1
        fast = [w.encode() for w in found if w != " "]
        if all(plain):
            counts, words = own, fast
        else:
            counts, words, at, k = np.zeros(len(chunks), np.int64), [], 0, 0
            for i, chunk in enumerate(chunks):
                if plain[i]:
                    part = fast[at : at + own[k]]
                    at, k = at + own[k], k + 1
                else:
                    part = self._split(chunk)
                words += part
                counts[i] = len(part)
        lengths, flat = self._words.expand(self._words.indices(words))
        return summed(lengths, counts), flat

    def encode(self, texts: list[str | None]) -> Ragged:
        """Numbers of ids and all ids, of each text in turn. White space only parts words, so chunks go by themselves."""
        chunks = [(t or "").replace("\n", " ").replace("\t", " ").split(" ") for t in texts]
        counts = np.fromiter(map(len, chunks), np.int64, len(chunks))
        lengths, flat = self._chunks.expand(self._chunks.indices([c for own in chunks for c in own]))
        self._words.trim()
        self._chunks.trim()
        return summed(lengths, counts), flat


@lru_cache(maxsize=2)
def vocabulary(path: str) -> WordVocabulary:
    """One vocabulary for each worker process."""
    return WordVocabulary(path)


@lru_cache(maxsize=2)
def tokens(path: str) -> list[str]:
    """The vocabulary's tokens by id, which is all that decoding needs."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    ids = {**spec["model"]["vocab"], **{t["content"]: t["id"] for t in spec["added_tokens"]}}
    by_id = [""] * (max(ids.values()) + 1)
    for token, i in ids.items():
        by_id[i] = token
    return by_id


def decoded(by_id: list[str], ids: list[int] | None) -> str:
    """The tokens of the ids with a space between, which is how a vocabulary without decoder is decoded."""
    return " ".join(map(by_id.__getitem__, ids or ()))


def encode(df: DataFrame, vocabulary_path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``df`` with the column ``ids`` (array of int) of the whole ``text``."""

    def make():
        own = vocabulary(vocabulary_path)
        return lambda texts: int_lists(*own.encode(texts))

    return with_column(df, ids, T.ArrayType(T.IntegerType()), text, make, BATCH_BYTES)


def decode(df: DataFrame, vocabulary_path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``df`` with the column ``text`` decoded from ``ids``; null ids give an empty text."""

    def make():
        by_id = tokens(vocabulary_path)
        return lambda lists: pa.array([decoded(by_id, x) for x in lists], pa.string())

    return with_column(df, text, T.StringType(), ids, make, BATCH_BYTES // 8)
