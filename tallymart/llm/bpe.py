"""Byte-level BPE through a rank queue with a hierarchical bitmap.

A text is split by the vocabulary's pattern; each match (pre-token) is merged on its own. Its bytes
form a linked list of parts. Every neighbouring pair whose bytes are a token waits in the bucket of
that token's rank, as the position where the pair begins. A bitmap over the ranks says which buckets
hold something, and a second bitmap which words of the first are not zero, so that two
find-first-set steps lead to the lowest rank. Positions of one bucket leave from left to right. A
merge changes the pairs on both sides, which are queued anew; what was queued for the old pairs is
stale and skipped when it comes up. A pre-token of n bytes takes O(n) such steps (a bucket's order
costs a logarithm more), however long it is.

Pre-tokens that were merged before are remembered, in two generations of bounded size.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from heapq import heappop, heappush
from itertools import islice
from struct import pack

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymart.llm.common import bound_batches

WORD_SHIFT = 8  # a word of the lower bitmap stands for 2**8 ranks
WORD_MASK = (1 << WORD_SHIFT) - 1
CACHE_WORDS = 500_000  # pre-tokens whose ids a Python worker remembers
CACHE_WORD_CHARS = 48
MATCHES = 1 << 16  # pre-tokens of a text that are held at a time

_codecs: dict[tuple[str, str], "Codec"] = {}


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a file with one base64 token and its rank per line."""
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


class _Remembered(dict):
    """Ids of pre-tokens; a missing one is merged. The older half goes when the newer is full."""

    def __init__(self, codec: Codec):
        super().__init__()
        self.codec = codec
        self.older: dict[str, bytes] = {}

    def __missing__(self, word: str) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            ids = self.codec.merge(word.encode("utf-8", "replace"))
            ids = pack(f"<{len(ids)}I", *ids)
        if len(word) <= CACHE_WORD_CHARS:
            if len(self) >= CACHE_WORDS // 2:
                self.older = dict(self)
                self.clear()
            self[word] = ids
        return ids


def _add(first: dict[int, int], others: dict[int, list[int]], rank: int, position: int) -> None:
    """Put a position into a bucket that has one already."""
    if position < first[rank]:
        position, first[rank] = first[rank], position
    heappush(others.setdefault(rank, []), position)


class Codec:
    """Encoder and decoder of one vocabulary; ids are little-endian and have 32 bits."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.pairs = {tuple(token): rank for token, rank in ranks.items() if len(token) == 2}
        self.longest = max(map(len, ranks), default=0)
        words = (max(self.tokens, default=0) >> WORD_SHIFT) + 1
        self.bitmap = [0] * words
        self.bit = [1 << i for i in range(max(words, WORD_MASK + 1))]
        self.pattern = regex.compile(pattern)
        self.known = _Remembered(self)

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one pre-token.

        The queue is written out in this one loop, as a call for each step would double its time.
        It is empty again at the end, so the bitmap is there for the next pre-token.
        """
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        ranks, rank_of, longest, n = self.ranks, self.ranks.get, self.longest, len(piece)
        bitmap, bit = self.bitmap, self.bit
        first: dict[int, int] = {}  # leftmost position of each bucket
        others: dict[int, list[int]] = {}  # the rest of it, where there is one, as a heap
        summary = 0  # which words of the bitmap are not zero
        after = list(range(1, n + 2))  # the next part of the part that begins here
        before = list(range(-1, n))
        # Rank of this part and the next as one token.
        pair = [*map(self.pairs.get, zip(piece, piece[1:])), None]
        for i, rank in enumerate(pair):
            if rank is None:
                continue
            if rank in first:
                others.setdefault(rank, []).append(i)
            else:
                first[rank] = i
                word = rank >> WORD_SHIFT
                bitmap[word] |= bit[rank & WORD_MASK]
                summary |= bit[word]
        while summary:
            word = (summary & -summary).bit_length() - 1
            waiting = bitmap[word]
            rank = (word << WORD_SHIFT) + (waiting & -waiting).bit_length() - 1
            if rank in others:
                i, rest = first[rank], others[rank]
                first[rank] = heappop(rest)
                if not rest:
                    del others[rank]
            else:
                i = first.pop(rank)
                waiting &= waiting - 1
                bitmap[word] = waiting
                if not waiting:
                    summary &= summary - 1
            if pair[i] != rank:
                continue  # stale: one of the two parts has changed since
            second = after[i]
            end = after[second]
            after[i], before[end], pair[second], pair[i] = end, i, None, None
            if end < n and after[end] - i <= longest:
                pair[i] = rank = rank_of(piece[i:after[end]])
                if rank is not None:
                    if rank in first:
                        _add(first, others, rank, i)
                    else:
                        first[rank] = i
                        word = rank >> WORD_SHIFT
                        bitmap[word] |= bit[rank & WORD_MASK]
                        summary |= bit[word]
            if i:
                left = before[i]
                pair[left] = rank = rank_of(piece[left:end]) if end - left <= longest else None
                if rank is not None:
                    if rank in first:
                        _add(first, others, rank, left)
                    else:
                        first[rank] = left
                        word = rank >> WORD_SHIFT
                        bitmap[word] |= bit[rank & WORD_MASK]
                        summary |= bit[word]
        ids, at = [], 0
        while at < n:
            end = after[at]
            ids.append(ranks[piece[at:end]])
            at = end
        return ids

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if len(text) <= MATCHES:
            return b"".join(map(self.known.__getitem__, self.pattern.findall(text)))
        matches = (m.group() for m in self.pattern.finditer(text))
        parts = []
        while block := list(islice(matches, MATCHES)):
            parts.append(b"".join(map(self.known.__getitem__, block)))
        return b"".join(parts)

    def decode(self, ids: bytes) -> bytes:
        numbers = np.frombuffer(ids, "<u4")
        return b"".join(
            b"".join(map(self.tokens.__getitem__, numbers[at:at + MATCHES].tolist()))
            for at in range(0, len(numbers), MATCHES))


def codec(path: str, pattern: str) -> Codec:
    """One per worker process, file and pattern."""
    if (path, pattern) not in _codecs:
        _codecs[path, pattern] = Codec(read_ranks(path), pattern)
    return _codecs[path, pattern]


def encoded(text: Column, path: str, pattern: str) -> Column:
    """Ids of each text as little-endian 32-bit numbers; NULL counts as empty."""

    @F.pandas_udf("binary")
    def bpe_encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known = codec(path, pattern)
        for batch in batches:
            yield pd.Series([known.encode(t) for t in batch], dtype=object)

    return bpe_encode(text)


def decoded(ids: Column, path: str, pattern: str) -> Column:
    """Bytes of each row of ids. An id that the vocabulary lacks fails the job; NULL is empty."""

    @F.pandas_udf("binary")
    def bpe_decode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known = codec(path, pattern)
        for batch in batches:
            yield pd.Series([known.decode(b or b"") for b in batch], dtype=object)

    return bpe_decode(ids)


def round_trip(documents: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, and SHA-256 of the ids and of the bytes decoded from them.

    Both steps run in one pass, as ids and decoded bytes need not travel to be hashed. Defined
    cases: NULL and empty texts have no tokens and the hashes of nothing; repeated rows and NULL ids
    are rows like others; an empty table gives an empty result; further columns are ignored.
    """
    bound_batches(documents.sparkSession)

    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def bpe_round_trip(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known = codec(path, pattern)
        for batch in batches:
            rows = []
            for text in batch:
                ids = known.encode(text)
                rows.append((len(ids) // 4, hashlib.sha256(ids).hexdigest(),
                             hashlib.sha256(known.decode(ids)).hexdigest()))
            yield pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    return documents.select("doc_id", bpe_round_trip("text").alias("coded")).select(
        "doc_id", "coded.*")
