"""SimHash near-dedup: exact pairs within a few bits through vantage-point trees.

Fingerprints are 64-bit signs over hashed word shingles. Two fingerprints that differ in at most
``max_bits`` bits differ in at most ``max_bits // blocks`` bits in one of ``blocks`` bit blocks. Each
block gets a vantage-point tree over the Hamming distance in that block: every level has a vantage
point and splits by the median distance to it, over all distinct fingerprints. A fingerprint lives
in one leaf of each tree; by the triangle bound |d(x, v) - d(y, v)| <= d(x, y), its neighbours can
only live in leaves on its own side of each split, or beyond a split whose boundary is within the
radius, so it also visits those leaves as a guest. A guest keeps account of the bits that can have
brought it across, which ends most paths further down. Leaves are shards: within one, each resident
is compared with all residents and guests on all 64 bits. The union over the trees holds every pair.

A leaf with many fingerprints is cut into tiles of residents, each of which meets all rows of the
leaf, so that no task holds or compares an unbounded group. Tasks return a spanning forest of the
links they found, not all pairs; components are found on those.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymart.llm.common import bound_batches
from tallymart.llm.links import components
from tallymart.workspace import scratch_dir, write_and_read

SHINGLE_WORDS = 4
MAX_BITS = 4
HASH_SEED = 42
BLOCKS = 3
LEAF_ROWS = 512  # aimed-at residents of a leaf
TILE_ROWS = 4096  # most residents that one task compares at a time
VANTAGE_SEED = 20


def fingerprint(text: str | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """Unsigned 64-bit SimHash; bytes.split() takes the white space \\x09-\\x0D and \\x20."""
    words = b"" if text is None else text.encode("utf-8", "replace").lower()
    words = words.split() if words else []
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle_words:
        return xxhash.xxh64_intdigest(joined, HASH_SEED)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: len(words) - shingle_words + 1].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], HASH_SEED)
                       for a, b in zip(starts, ends[shingle_words - 1:].tolist())], dtype="<u8")
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 16):  # bounds the unpacked bits of very long texts
        part = hashes[at:at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * counts > len(hashes)).astype(np.uint64)
    return int((bits << np.arange(64, dtype=np.uint64)).sum())


def fingerprint_column(shingle_words: int) -> Column:
    """The fingerprint of ``text`` as a signed long."""

    @F.pandas_udf("long")
    def simhash(texts: pd.Series) -> pd.Series:
        values = np.array([fingerprint(t, shingle_words) for t in texts], dtype=np.uint64)
        return pd.Series(values.view(np.int64))

    return simhash(F.col("text"))


def block_masks(blocks: int) -> list[int]:
    """Masks of near-equal runs of bits that cover all 64."""
    edges = [round(64 * i / blocks) for i in range(blocks + 1)]
    return [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:])]


def vantage_points(levels: int, blocks: int) -> np.ndarray:
    """Seeded vantage points, one per tree and level."""
    rng = np.random.default_rng(VANTAGE_SEED)
    return rng.integers(0, 1 << 64, size=(blocks, levels), dtype=np.uint64)


def _distances(values: np.ndarray, vantage: np.uint64, mask: int) -> np.ndarray:
    return np.bitwise_count((values ^ vantage) & np.uint64(mask))


def medians(distinct: DataFrame, points: np.ndarray, masks: list[int]) -> np.ndarray:
    """Median distance to each vantage point over all fingerprints: at most 65 counts each."""
    blocks, levels = points.shape

    def histogram(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = np.zeros((blocks, levels, 65), dtype=np.int64)
        for batch in batches:
            values = batch["fp"].to_numpy(dtype=np.int64).view(np.uint64)
            for b in range(blocks):
                for k in range(levels):
                    counts[b, k] += np.bincount(_distances(values, points[b, k], masks[b]),
                                                minlength=65)
        b, k, d = np.nonzero(counts)
        yield pd.DataFrame({"tree": b, "level": k, "d": d, "n": counts[b, k, d]})

    rows = (distinct.select("fp").mapInPandas(histogram, "tree int, level int, d int, n long")
            .groupBy("tree", "level", "d").agg(F.sum("n").alias("n")).collect())
    counts = np.zeros((blocks, levels, 65), dtype=np.int64)
    for r in rows:
        counts[r["tree"], r["level"], r["d"]] = r["n"]
    below = counts.cumsum(axis=2)
    # The split whose inner side is nearest to one half.
    return np.abs(2 * below - below[:, :, -1:]).argmin(axis=2)


def route(values: np.ndarray, points: np.ndarray, splits: np.ndarray, mask: int,
          radius: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, leaf, resident) of every visit of the values to the leaves of one tree.

    With radius 0 the visits are the residents. With radius 1 a visit carries the bits whose change
    leads down its path, and ends when none is left: a leaf is visited if and only if some value
    within one bit lives there, so a tree of any depth has at most one visit per bit of its block,
    and the resident's. Beyond, each split is judged by the triangle bound alone.
    """
    mask = np.uint64(mask)
    row = np.arange(len(values))
    leaf = np.zeros(len(values), dtype=np.int64)
    resident = np.ones(len(values), dtype=bool)
    ways = np.full(len(values), mask)  # bits whose change keeps to the path, at radius 1
    for vantage, split in zip(points, splits):
        apart = (values[row] ^ vantage) & mask
        d = np.bitwise_count(apart).astype(np.int64)
        inner = d <= split
        crosses = np.where(inner, d + radius > split, d - radius <= split)
        stays = np.ones(len(row), dtype=bool)
        across = ways
        if radius == 1:
            across = np.where(crosses, ways & np.where(inner, ~apart, apart), np.uint64(0))
            ways = ways & ~across
            crosses, stays = across != 0, resident | (ways != 0)
        row = np.concatenate([row[stays], row[crosses]])
        leaf = np.concatenate([(2 * leaf + inner)[stays], (2 * leaf + ~inner)[crosses]])
        resident = np.concatenate([resident[stays], np.zeros(int(crosses.sum()), dtype=bool)])
        ways = np.concatenate([ways[stays], across[crosses]])
    return row, leaf, resident


def forest_within(residents: np.ndarray, others: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Links that connect whatever the pairs (resident, resident or other) connect: from each
    node to the smallest one, as signed numbers, that it is connected with."""
    residents = np.sort(residents.view(np.int64)).view(np.uint64)
    nodes = np.sort(np.concatenate([residents, others]).view(np.int64)).view(np.uint64)
    parent = np.arange(len(nodes))

    def roots(of: np.ndarray) -> np.ndarray:
        up = parent[of]
        while True:
            higher = parent[up]
            if np.array_equal(higher, up):
                return up
            up = higher

    step = max(1, (1 << 21) // max(len(nodes), 1))
    for at in range(0, len(residents), step):
        near = np.bitwise_count(residents[at:at + step, None] ^ nodes[None, :]) <= max_bits
        for i in np.flatnonzero(near.sum(axis=1) > 1):
            linked = np.flatnonzero(near[i])
            top = roots(linked)
            root = top.min()
            parent[top] = root
            parent[linked] = root
    top = roots(np.arange(len(nodes)))
    moved = np.flatnonzero(top != np.arange(len(nodes)))
    return list(zip(nodes[moved].view(np.int64).tolist(),
                    nodes[top[moved]].view(np.int64).tolist()))


def near_links(distinct: DataFrame, max_bits: int = MAX_BITS, blocks: int = BLOCKS,
               leaf_rows: int = LEAF_ROWS, tile_rows: int = TILE_ROWS) -> DataFrame:
    """Links (a, b) whose components are those of all pairs within ``max_bits`` bits.

    ``distinct`` has one row per fingerprint in the long column ``fp`` and can be read repeatedly.
    """
    radius = max_bits // blocks
    masks = block_masks(blocks)
    levels = max(0, math.ceil(math.log2(max(1, distinct.count()) / leaf_rows)))
    points = vantage_points(levels, blocks)
    splits = medians(distinct, points, masks) if levels else np.zeros((blocks, 0), dtype=np.int64)

    def routed(batches: Iterator[pd.DataFrame], within: int) -> Iterator[pd.DataFrame]:
        for batch in batches:
            values = batch["fp"].to_numpy(dtype=np.int64).view(np.uint64)
            for at in range(0, len(values), 2048):  # bounds the visits held at a time
                part = values[at:at + 2048]
                for tree in range(blocks):
                    row, leaf, resident = route(part, points[tree], splits[tree], masks[tree],
                                                within)
                    yield pd.DataFrame({"leaf": leaf * blocks + tree,
                                        "fp": part[row].view(np.int64), "resident": resident})

    prints = distinct.select("fp")
    visits = prints.mapInPandas(lambda batches: routed(batches, radius),
                                "leaf long, fp long, resident boolean")
    residents = (
        prints.mapInPandas(lambda batches: (v[["leaf"]] for v in routed(batches, 0)), "leaf long")
        .groupBy("leaf").agg(F.count("*").alias("n"))
        .where(F.col("n") > tile_rows)
        .select("leaf", F.ceil(F.col("n") / tile_rows).cast("int").alias("tiles"))
    )
    tiled = visits.join(residents, "leaf", "left").withColumn(
        "tiles", F.coalesce("tiles", F.lit(1)))
    # A resident is compared as such in one tile; in the other tiles of its leaf it is a guest.
    tiled = (
        tiled.withColumn("tile", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
        .withColumn("resident", F.col("resident")
                    & (F.pmod(F.xxhash64("fp"), F.col("tiles").cast("long")) == F.col("tile")))
        .select("leaf", "tile", "fp", "resident")
    )

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        values = rows["fp"].to_numpy(dtype=np.int64).view(np.uint64)
        resident = rows["resident"].to_numpy(dtype=bool)
        found = forest_within(values[resident], values[~resident], max_bits)
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return tiled.groupBy("leaf", "tile").applyInPandas(compare, "a long, b long")


def _classes(documents: DataFrame, shingle_words: int, max_bits: int, blocks: int, leaf_rows: int,
             tile_rows: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id, row_hash, fp) of every row, and (fp, root, component_id, first_row) of every
    distinct fingerprint; first_row is the row_hash of a row with the component's smallest id."""
    bound_batches(documents.sparkSession)
    folder = scratch_dir(documents.sparkSession, "simhash")
    marked = write_and_read(
        documents.select("doc_id", _row_hash(), fingerprint_column(shingle_words).alias("fp")),
        f"{folder}/fingerprints")
    distinct = write_and_read(
        marked.groupBy("fp").agg(F.min(_first()).alias("first")), f"{folder}/distinct")
    links = near_links(distinct, max_bits, blocks, leaf_rows, tile_rows)
    roots = components(links, "simhash/components")
    classes = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root"))
    smallest = classes.groupBy("root").agg(F.min("first").alias("least"))
    return marked, classes.join(smallest, "root").select(
        "fp", "root", F.col("least.doc_id").alias("component_id"),
        F.col("least.row_hash").alias("first_row"))


def _row_hash() -> Column:
    """Tells apart the texts of a reused doc_id."""
    return F.xxhash64("doc_id", "text").alias("row_hash")


def _first() -> Column:
    """Orders rows by doc_id with NULL last, then by their hash."""
    return F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "row_hash")


def near_duplicates(documents: DataFrame, shingle_words: int = SHINGLE_WORDS,
                    max_bits: int = MAX_BITS, blocks: int = BLOCKS, leaf_rows: int = LEAF_ROWS,
                    tile_rows: int = TILE_ROWS) -> DataFrame:
    """doc_id, fp (signed) and component_id of every row of ``documents``.

    Defined cases: NULL text is empty; texts without words have fingerprint zero and link with each
    other and with whatever is within reach; repeated rows are rows of their own in one component;
    a NULL doc_id names no component, so component_id is NULL only if all ids in reach are; an empty
    table gives an empty result; further columns are ignored.
    """
    marked, classes = _classes(documents, shingle_words, max_bits, blocks, leaf_rows, tile_rows)
    return marked.join(classes, "fp").select("doc_id", "fp", "component_id")


def fingerprints_and_components(documents: DataFrame) -> DataFrame:
    """doc_id, fingerprint as 16 hex digits, component_id."""
    return near_duplicates(documents).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(documents: DataFrame, shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS,
             blocks: int = BLOCKS, leaf_rows: int = LEAF_ROWS,
             tile_rows: int = TILE_ROWS) -> DataFrame:
    """One row of every component, that of the smallest doc_id, with all its columns.

    Of repeated rows with that id and text one stays; of a doc_id with several texts every
    component keeps a row of its own; where all ids of a component are NULL, one of its rows stays.
    """
    _, classes = _classes(documents, shingle_words, max_bits, blocks, leaf_rows, tile_rows)
    chosen = classes.select(F.col("component_id").alias("doc_id"),
                            F.col("first_row").alias("row_hash")).distinct()
    # Rows travel as one struct, so that no column of theirs can clash with another one.
    rows = documents.select(
        F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row"), "doc_id", _row_hash())
    matches = rows.doc_id.eqNullSafe(chosen.doc_id) & (rows.row_hash == chosen.row_hash)
    kept = rows.join(chosen, matches, "left_semi").groupBy("doc_id", "row_hash").agg(
        F.first("row").alias("row"))
    return kept.select(*[F.col("row").getField(c).alias(c) for c in documents.columns])
