"""Packing documents into sequences by shortest-pack-first over the length histogram.

Every document is tokenised and ends with the end token. It is cut into pieces of the sequence
length and a remainder. The remainders are packed by their histogram alone: lengths are placed from
the longest to the shortest, each onto the patterns (multisets of lengths) that are shortest so far
and still have room, splitting a pattern's count where only a part of it gets the length. The
histogram has at most as many bins as a sequence has tokens, so the plan's size does not depend on
the data. Remainders of one length are numbered and join the plan's slots by length and rank.
"""

from __future__ import annotations

import bisect
import os
import string
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymart.llm.common import bound_batches
from tallymart.llm.ranks import shuffle_partitions, with_positions
from tallymart.workspace import scratch_dir, write_and_read

SEQUENCE_TOKENS = 4096
END_TOKEN = 2
CACHE_WORDS = 600_000  # words whose ids a Python worker remembers
CACHE_WORD_BYTES = 64

PIECE = "doc_id string, start long, length long, ids_crc32 long, doc_tokens long"

_encoders: dict[str, "WordEncoder"] = {}


class WordEncoder:
    """Token ids of whole texts, little-endian in 32 bits, through a cache of words.

    The tokenizer lower-cases, splits at white space and encodes the parts on their own, so the ids
    of a text are those of its words one after the other. ASCII letters are lower-cased and ASCII
    white space is split beforehand; whatever else the normaliser does stays with the tokenizer. A
    word of letters with ASCII punctuation after it is two parts (the apostrophe can start a
    contraction, so such words are kept whole; so are words that normalising turns into letters and
    marks, as marks belong to the punctuation after them). All new words of letters are encoded in
    one call: each is one part, and the last token of a part is one with the end-of-word mark.
    Tokens that the file adds to the vocabulary are found before lower-casing and need no spaces
    around them; texts that hold the letters of one, in any case, are encoded as a whole.
    """

    PUNCTUATION = string.punctuation.replace("'", "").encode()

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.ends = np.zeros(self.tokenizer.get_vocab_size(), dtype=bool)
        for token, number in self.tokenizer.get_vocab().items():
            if token.endswith("</w>"):
                self.ends[number] = True
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.added = [t.content.encode().lower() for t in added if t.content]
        # Words of the last batches and of those before; the older half goes when the other is full.
        self.recent: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def _known(self, words: set[bytes]) -> dict[bytes, bytes]:
        """Ids of those words that are in the cache."""
        found = {w: self.recent[w] for w in words if w in self.recent}
        found.update((w, self.older[w]) for w in words if w not in found and w in self.older)
        return found

    def _ids(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, dtype="<u4").tobytes() for e in found]

    def _learn(self, words: set[bytes]) -> dict[bytes, bytes]:
        """Ids of words that the cache lacks."""
        letters, others, split = set(), set(), []
        for word in words:
            stem = word.rstrip(self.PUNCTUATION)
            if stem.isalpha() if stem.isascii() else _letters(stem.decode()):
                letters.add(stem)
                if len(stem) < len(word):
                    split.append((word, stem, word[len(stem):]))
                    others.add(word[len(stem):])
            else:
                others.add(word)
        ids = self._known(letters | others)
        new = [w for w in letters if w not in ids]
        if new:
            [joined] = self._ids([b" ".join(new).decode()])
            ends = (np.flatnonzero(self.ends[np.frombuffer(joined, "<u4")]) + 1) * 4
            if len(ends) == len(new):
                starts = np.concatenate([[0], ends[:-1]])
                ids.update((w, joined[a:b]) for w, a, b in
                           zip(new, starts.tolist(), ends.tolist()))
            else:  # a normaliser that splits or drops letters: one by one
                ids.update(zip(new, self._ids([w.decode() for w in new])))
        new = [w for w in others if w not in ids]
        ids.update(zip(new, self._ids([w.decode() for w in new])))
        ids.update((word, ids[stem] + ids[rest]) for word, stem, rest in split)
        return ids

    def encode(self, texts: list[str | None]) -> Iterator[bytes]:
        lowered = [b"" if t is None else t.encode("utf-8", "replace").lower() for t in texts]
        whole = {i: self._ids([texts[i]])[0] for i, text in enumerate(lowered)
                 if any(token in text for token in self.added)}
        words = [[] if i in whole else text.split() for i, text in enumerate(lowered)]
        if len(self.recent) > CACHE_WORDS // 2:
            self.older, self.recent = self.recent, {}
        distinct = set().union(*words) if words else set()
        missing = distinct.difference(self.recent)
        again = {w: self.older[w] for w in missing if w in self.older}
        self.recent.update(again)
        missing.difference_update(again)
        learnt = self._learn(missing) if missing else {}
        self.recent.update(learnt)
        for i, parts in enumerate(words):
            yield whole[i] if i in whole else b"".join(map(self.recent.__getitem__, parts))
        for word in learnt:
            if len(word) > CACHE_WORD_BYTES:
                del self.recent[word]


def _letters(word: str) -> bool:
    """All letters, also after the tokenizer's normaliser."""
    return word.isalpha() and unicodedata.normalize("NFC", word).lower().isalpha()


def encoder(path: str) -> WordEncoder:
    """One per worker process and file."""
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def pieces(documents: DataFrame, tokenizer: str, sequence: int = SEQUENCE_TOKENS,
           end_token: int = END_TOKEN, keep_ids: bool = False) -> DataFrame:
    """The pieces of every document: doc_id, start, length, ids_crc32, doc_tokens, and with
    ``keep_ids`` the ids as little-endian 32-bit numbers."""
    end = int(end_token).to_bytes(4, "little")

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(tokenizer).encode
        for batch in batches:
            texts, doc_ids = batch["text"].tolist(), batch["doc_id"].tolist()
            for at in range(0, len(texts), 128):  # bounds the words held at a time
                rows = []
                for doc_id, ids in zip(doc_ids[at:at + 128], encode(texts[at:at + 128])):
                    ids += end
                    total = len(ids) // 4
                    for start in range(0, total, sequence):
                        part = ids[4 * start: 4 * (start + sequence)]
                        rows.append((doc_id, start, len(part) // 4, zlib.crc32(part), total)
                                    + ((part,) if keep_ids else ()))
                yield pd.DataFrame(rows, columns=columns)

    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    columns += ["ids"] * keep_ids
    # Ids pass through pandas as text: a column of numbers with NULL would turn into floats.
    slim = documents.select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    cut_rows = slim.mapInPandas(cut, PIECE + (", ids binary" if keep_ids else ""))
    return cut_rows.withColumn("doc_id", F.col("doc_id").cast(documents.schema["doc_id"].dataType))


def plan(histogram: dict[int, int], sequence: int) -> list[tuple[tuple[int, ...], int]]:
    """Patterns (lengths from the longest) and how often each is used.

    For each length, from the longest, the patterns with the least filled length take it first. If
    none has room, no more new patterns start than all tokens that are still to be placed would
    fill, so that short lengths share patterns too.
    """
    open_fills: list[int] = []  # sorted fills that have patterns
    groups: dict[int, list[list]] = {}  # fill -> [pattern, count]

    def put(pattern: tuple[int, ...], count: int, fill: int) -> None:
        if fill not in groups:
            groups[fill] = []
            bisect.insort(open_fills, fill)
        groups[fill].append([pattern, count])

    unplaced = sum(length * count for length, count in histogram.items())
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            if open_fills and open_fills[0] + length <= sequence:
                fill = open_fills[0]
                pattern, count = groups[fill].pop()
                used = min(left, count)
                if count > used:
                    groups[fill].append([pattern, count - used])
                if not groups[fill]:
                    del groups[fill]
                    open_fills.pop(0)
                put(pattern + (length,), used, fill + length)
            else:
                used = min(left, -(-unplaced // sequence))
                put((length,), used, length)
            left -= used
            unplaced -= used * length
    return [(tuple(p), n) for fill in sorted(groups, reverse=True) for p, n in groups[fill]]


def slots(patterns: list[tuple[tuple[int, ...], int]], first_sequence: int) -> list[tuple]:
    """(length, first_rank, last_rank, sequence_id of the first, offset) of every pattern slot."""
    ranks: dict[int, int] = {}
    rows, sequence_id = [], first_sequence
    for pattern, count in patterns:
        offset = 0
        for length in pattern:
            rank = ranks.get(length, 0)
            rows.append((length, rank, rank + count - 1, sequence_id, offset))
            ranks[length] = rank + count
            offset += length
        sequence_id += count
    return rows


def pack(documents: DataFrame, tokenizer: str, sequence: int = SEQUENCE_TOKENS,
         end_token: int = END_TOKEN, keep_ids: bool = False) -> DataFrame:
    """The pieces of every document with sequence_id (gapless from 0) and offset.

    Defined cases: a NULL or empty text is the end token alone; repeated rows are packed one by one;
    an empty table gives an empty result; further columns are ignored. ``keep_ids`` adds the ids.
    """
    spark = documents.sparkSession
    bound_batches(spark)
    written = write_and_read(pieces(documents, tokenizer, sequence, end_token, keep_ids),
                             scratch_dir(spark, "packing/pieces"))
    # Sorted by length, the position minus the number of shorter pieces is the rank in the length.
    order = ["length", "doc_id", "start", "ids_crc32"]
    placed, _ = with_positions(written, order, shuffle_partitions(spark), "packing")
    counts = {r["length"]: r["n"] for r in  # at most `sequence` rows
              written.groupBy("length").agg(F.count("*").alias("n")).collect()}
    shorter, before = {}, 0
    for length in sorted(counts):
        shorter[length] = before
        before += counts[length]
    full = counts.get(sequence, 0)
    partial = {n: c for n, c in counts.items() if n < sequence}
    rows = slots(plan(partial, sequence), full)
    if full:
        rows.append((sequence, 0, full - 1, 0, 0))
    fields = ["length", "first_rank", "last_rank", "first_sequence", "offset", "shorter"]
    # Each slot is a row of the plan, whose size is bounded by the bins of the histogram. From an
    # Arrow table Spark makes rows without Python workers, which would stay in memory.
    values = np.array([(*r, shorter[r[0]]) for r in rows], dtype=np.int64).reshape(-1, 6).T
    table = spark.createDataFrame(
        pa.table({name: pa.array(column) for name, column in zip(fields, values)}))
    by_length = (
        table.groupBy("length", "shorter")
        .agg(F.array_sort(F.collect_list(F.struct(
            "first_rank", "last_rank", "first_sequence", "offset"))).alias("ranges")))
    ranked = placed.join(F.broadcast(by_length), "length").withColumn(
        "rank", F.col("position") - F.col("shorter"))
    slot = F.element_at(F.filter("ranges", lambda s: (s["first_rank"] <= F.col("rank"))
                                 & (F.col("rank") <= s["last_rank"])), 1)
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"] + ["ids"] * keep_ids
    return ranked.withColumn("slot", slot).select(
        *columns,
        (F.col("slot")["first_sequence"] + F.col("rank") - F.col("slot")["first_rank"])
        .alias("sequence_id"),
        F.col("slot")["offset"].alias("offset"))
