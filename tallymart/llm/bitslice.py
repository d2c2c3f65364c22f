"""Exact top-k by inner product over a bit-sliced index.

A block of candidate rows is held as bit slices: for every dimension and binary digit of its
quantised value, one bitmap over the rows. A query's scores are built without looking at a row: each
of its components is written in signed binary digits, every digit adds the slices of its dimension,
shifted, and carry-save adders over whole bitmaps reduce all of them to the bit slices of the score
sum. The best rows are then selected from the most significant score slice downwards; rows that tie
at the boundary are resolved by id.

Blocks of candidates and chunks of queries have bounded sizes; every block meets every chunk, and
the best k of all blocks are the answer, so the result is exact. A candidate is copied once for every
chunk and a query once for every block; chunks are large, so that both copies weigh about the same
and the index of a block is built for thousands of queries at a time.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymart.workspace import scratch_dir, write_and_read

SCALE = 64
K = 20
QUERY_EVERY = 20
BLOCK_ROWS = 32_768
QUERY_ROWS = 16_384


def quantised(vector: Column) -> Column:
    """floor(64 x) of every component; NULL if the vector or a component is NULL or not finite."""
    wide = F.transform(vector, lambda x: x.cast("double"))
    bad = F.exists(wide, lambda x: F.coalesce(
        F.isnan(x) | (F.abs(x) == F.lit(float("inf"))), F.lit(True)))
    clean = vector.isNotNull() & ~F.coalesce(
        F.exists(wide, lambda x: x.isNull()), F.lit(True)) & ~F.coalesce(bad, F.lit(True))
    return F.when(clean, F.transform(wide, lambda x: F.floor(x * SCALE).cast("long")))


def signed_digits(value: int) -> list[tuple[int, int]]:
    """(position, +1 or -1) with no two neighbouring positions, summing to ``value``."""
    digits, at = [], 0
    while value:
        if value & 1:
            sign = 2 - (value & 3)
            digits.append((at, sign))
            value -= sign
        value >>= 1
        at += 1
    return digits


class SlicedIndex:
    """Bit slices of one block of candidates, sorted by vec_id."""

    def __init__(self, ids: np.ndarray, values: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids = ids[order]
        self.rows = len(ids)
        values = values[order]
        self.low = values.min(axis=0) if self.rows else np.zeros(values.shape[1], np.int64)
        offset = values - self.low
        words = -(-self.rows // 64)
        self.words = words
        self.everyone = self._packed(np.ones(self.rows, dtype=np.uint8))
        self.slices: list[list[np.ndarray]] = []
        self.inverse: list[list[np.ndarray]] = []
        for column in offset.T:
            bits = int(column.max()).bit_length() if self.rows else 0
            planes = [self._packed(((column >> b) & 1).astype(np.uint8)) for b in range(bits)]
            self.slices.append(planes)
            self.inverse.append([plane ^ self.everyone for plane in planes])

    def _packed(self, bits: np.ndarray) -> np.ndarray:
        padded = np.zeros(self.words * 64, dtype=np.uint8)
        padded[: self.rows] = bits
        return np.packbits(padded, bitorder="little").view(np.uint64)

    def score_slices(self, query: np.ndarray) -> tuple[list[np.ndarray], int]:
        """Bit slices of score - base for every row, least significant first, and base."""
        columns: dict[int, list[np.ndarray]] = defaultdict(list)
        base = int(sum(int(q) * int(low) for q, low in zip(query, self.low)))
        for q, planes, inverse in zip(query, self.slices, self.inverse):
            for position, sign in signed_digits(int(q)):
                # -s = ~s - 1 on each binary digit s: the inverse slice, less one unit.
                for b, plane in enumerate(planes if sign > 0 else inverse):
                    columns[position + b].append(plane)
                    if sign < 0:
                        base -= 1 << (position + b)
        result, at = [], 0
        while columns and at <= max(columns):
            stack = columns.pop(at, [])
            carries = columns[at + 1] if len(stack) > 1 else columns.get(at + 1, [])
            while len(stack) > 2:  # a full adder: three bitmaps of one weight become two
                a, b, c = stack.pop(), stack.pop(), stack.pop()
                half = a ^ b
                stack.insert(0, half ^ c)
                carries.append((a & b) | (half & c))
            if len(stack) == 2:
                a, b = stack
                stack = [a ^ b]
                carries.append(a & b)
            result.append(stack[0] if stack else np.zeros(self.words, dtype=np.uint64))
            at += 1
        return result, base

    def best(self, query: np.ndarray, own: int | None, k: int) -> tuple[np.ndarray, np.ndarray]:
        """vec_id and score of the k best rows other than the query's own, ties to smaller ids."""
        slices, base = self.score_slices(query)
        possible = self.everyone.copy()
        if own is not None:
            for i in range(*np.searchsorted(self.ids, [own, own + 1]).tolist()):
                possible[i >> 6] &= ~np.uint64(1 << (i & 63))
        certain = np.zeros(self.words, dtype=np.uint64)
        taken = 0
        for plane in reversed(slices):
            upper = possible & plane
            n = int(np.bitwise_count(upper).sum())
            if taken + n > k:
                possible = upper
            else:
                certain |= upper
                taken += n
                possible &= ~plane
                if taken == k:
                    break
        sure = self._positions(certain)
        tied = self._positions(possible)[: k - len(sure)]  # rows are in id order
        rows = np.concatenate([sure, tied])
        word, bit = rows >> 6, (rows & 63).astype(np.uint64)
        scores = np.full(len(rows), base, dtype=np.int64)
        for weight, plane in enumerate(slices):
            scores += ((plane[word] >> bit) & np.uint64(1)).astype(np.int64) << weight
        return self.ids[rows], scores

    def _positions(self, bitmap: np.ndarray) -> np.ndarray:
        words = np.flatnonzero(bitmap)
        bits = np.unpackbits(bitmap[words].view(np.uint8), bitorder="little").reshape(-1, 64)
        word, bit = np.nonzero(bits)
        return words[word] * 64 + bit


def dealt(rows: int, queries: int, tasks: int, block_rows: int = BLOCK_ROWS,
          query_rows: int = QUERY_ROWS) -> tuple[int, int]:
    """Blocks and chunks that keep both bounds; more chunks if they are too few for all tasks."""
    blocks = max(1, -(-rows // block_rows))
    return blocks, max(1, -(-queries // query_rows), min(queries, -(-tasks // blocks)))


def top_k(embeddings: DataFrame, k: int = K, query_every: int = QUERY_EVERY,
          block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """query_id, rank, vec_id and score of the k best candidates of every query.

    Queries are the rows whose vec_id is divisible by ``query_every``. Defined cases: a NULL vec_id
    takes no part, nor does a vector that is NULL or holds a NULL or non-finite component; empty
    vectors match empty vectors with score 0; only vectors of equal length are compared; repeated
    rows are candidates of their own, a repeated query counts once (of rows that share a query's id,
    the smallest vector), and no row with the query's id is its candidate; an empty table gives an
    empty result; further columns are ignored. Scores are exact while they fit in 64 bits.
    """
    spark = embeddings.sparkSession
    rows = write_and_read(
        embeddings.where(F.col("vec_id").isNotNull())
        .select("vec_id", quantised(F.col("embedding")).alias("q"))
        .where(F.col("q").isNotNull()).withColumn("size", F.size("q")),
        scratch_dir(spark, "bitslice/rows"))
    is_query = F.pmod(F.col("vec_id"), F.lit(query_every)) == 0
    queries = rows.where(is_query).groupBy("vec_id").agg(F.min("q").alias("q")).withColumn(
        "size", F.size("q"))
    blocks, chunks = dealt(rows.count(), rows.where(is_query).count(),
                           spark.sparkContext.defaultParallelism, block_rows, query_rows)
    # Hashing deals both sides evenly; every block meets every chunk.
    candidate_rows = rows.select(
        "size", F.pmod(F.xxhash64("vec_id", "q"), F.lit(blocks)).cast("int").alias("block"),
        F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("chunk"),
        F.lit(False).alias("query"), "vec_id", "q")
    query_side = queries.select(
        "size", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"),
        F.pmod(F.xxhash64("vec_id"), F.lit(chunks)).cast("int").alias("chunk"),
        F.lit(True).alias("query"), "vec_id", "q")

    def search(part: pd.DataFrame) -> pd.DataFrame:
        asked, held = part[part["query"]], part[~part["query"]]
        found = []
        if len(asked) and len(held):
            size = int(part["size"].iloc[0])
            values = np.array(held["q"].tolist(), dtype=np.int64).reshape(len(held), size)
            index = SlicedIndex(held["vec_id"].to_numpy(dtype=np.int64), values)
            for own, query in zip(asked["vec_id"], asked["q"]):
                ids, scores = index.best(np.asarray(query), int(own), k)
                found.append(pd.DataFrame({"query_id": own, "vec_id": ids, "score": scores}))
        return pd.concat(found) if found else pd.DataFrame(
            {"query_id": [], "vec_id": [], "score": []}).astype("int64")

    best = (
        candidate_rows.unionByName(query_side).groupBy("size", "block", "chunk")
        .applyInPandas(search, "query_id long, vec_id long, score long")
    )
    by_score = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(by_score)).where(
        F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
