import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tallymart.llm import simhash
from tests.llm.frames import awkward_documents, collected, documents


def plain_fingerprint(text, k=4):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words, word = [], ""
    for c in lowered + " ":
        if c in " \t\n\x0b\x0c\r":
            words += [word] if word else []
            word = ""
        else:
            word += c
    if not words:
        return 0
    shingles = [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(values):
    """Component numbers of all pairs within four bits."""
    label = list(range(len(values)))
    for i, a in enumerate(values):
        for j in range(i):
            if bin(a ^ values[j]).count("1") <= 4 and label[i] != label[j]:
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    return label


@pytest.mark.parametrize("text", [
    None, "", " \t\n", "one", "One two THREE", "a b c d", "a  b\tc\nd\x0be", "É é   x y z w",
    "repeat " * 50, "x y " * 70_000])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == plain_fingerprint(text)


def planted(rng, n, copies, bits):
    base = rng.integers(0, 1 << 63, n, dtype=np.uint64)
    near = []
    for value in base[:copies]:
        flips = rng.choice(64, bits, replace=False)
        near.append(value ^ np.uint64(sum(1 << int(f) for f in flips)))
    return np.unique(np.concatenate([base, np.array(near, dtype=np.uint64)]))


@pytest.mark.parametrize("leaf_rows, tile_rows", [(16, 64), (64, 8), (10_000, 10_000)])
def test_vantage_point_trees_find_every_pair(spark, leaf_rows, tile_rows):
    """Random fingerprints, pairs at every distance up to five, and one dense group."""
    rng = np.random.default_rng(leaf_rows)
    values = np.concatenate([planted(rng, 120, 40, bits) for bits in (1, 2, 3, 4, 5)])
    dense = np.uint64(rng.integers(0, 1 << 63)) ^ (np.uint64(1) << np.arange(40, dtype=np.uint64))
    values = np.unique(np.concatenate([values, dense]))
    distinct = spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "fp long")
    found = simhash.near_links(distinct, leaf_rows=leaf_rows, tile_rows=tile_rows)
    position = {int(v): i for i, v in enumerate(values.view(np.int64))}
    label = list(range(len(values)))
    for a, b in {(r["a"], r["b"]) for r in found.collect()}:
        old, new = label[position[a]], label[position[b]]
        label = [new if x == old else x for x in label]
    expected = plain_components([int(v) for v in values])
    groups = lambda labels: sorted(sorted(i for i, x in enumerate(labels) if x == g)
                                   for g in set(labels))
    assert groups(label) == groups(expected)


def test_routes_hold_every_near_pair():
    """Whatever lies within the radius of a resident visits its leaf."""
    rng = np.random.default_rng(1)
    values = planted(rng, 300, 200, 1)
    mask = simhash.block_masks(3)[0]
    points = simhash.vantage_points(5, 3)[0]
    row, leaf, resident = simhash.route(values, points, np.full(5, 10), mask, 1)
    homes = dict(zip(row[resident].tolist(), leaf[resident].tolist()))
    visits = set(zip(row.tolist(), leaf.tolist()))
    for i, a in enumerate(values):
        near = np.flatnonzero(np.bitwise_count((values ^ a) & np.uint64(mask)) <= 1)
        assert all((int(j), homes[i]) in visits for j in near)


@pytest.mark.parametrize("levels", [0, 1, 6, 24])
def test_visits_are_the_leaves_within_one_bit(levels):
    """Every leaf in which a value within one bit would live, once, and no other leaf."""
    values = np.random.default_rng(levels).integers(0, 1 << 64, 200, dtype=np.uint64)
    for tree, mask in enumerate(simhash.block_masks(3)):
        points = simhash.vantage_points(levels, 3)[tree]
        splits = np.full(levels, bin(mask).count("1") // 2)
        flips = [1 << b for b in range(64) if mask >> b & 1]
        around = np.array([[int(v) ^ f for f in (0, *flips)] for v in values], dtype=np.uint64)
        _, homes, _ = simhash.route(around.reshape(-1), points, splits, mask, 0)
        expected = {(i, leaf) for i, leaves in enumerate(homes.reshape(around.shape).tolist())
                    for leaf in leaves}
        row, leaf, resident = simhash.route(values, points, splits, mask, 1)
        assert len(row) <= len(values) * (len(flips) + 1)
        assert set(zip(row.tolist(), leaf.tolist())) == expected
        home = dict(zip(row[resident].tolist(), leaf[resident].tolist()))
        assert home == dict(enumerate(homes.reshape(around.shape)[:, 0].tolist()))


@pytest.mark.parametrize("blocks", [1, 2, 5])
def test_every_number_of_blocks_finds_every_pair(spark, blocks):
    """Radius 4, 2 and 0 in a block."""
    values = planted(np.random.default_rng(blocks), 150, 60, 4)
    distinct = spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "fp long")
    links = simhash.near_links(distinct, blocks=blocks, leaf_rows=16, tile_rows=64).collect()
    found = {frozenset((r["a"], r["b"])) for r in links}
    near = {frozenset((int(a), int(b))) for a in values.view(np.int64) for b in values.view(np.int64)
            if a != b and int(a ^ b) % (1 << 64) and bin(int(a ^ b) % (1 << 64)).count("1") <= 4}
    assert len(near) >= 60 and found == near


def test_whole_corpus_against_all_pairs(spark, sf_medium):
    docs = spark.read.parquet(f"{sf_medium}/documents.parquet")
    rows = sorted(simhash.fingerprints_and_components(docs).collect())
    texts = {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}
    assert len(rows) == len(texts)
    prints = [int(r["fingerprint"], 16) for r in rows]
    assert prints == [simhash.fingerprint(texts[r["doc_id"]]) for r in rows]
    assert all(prints[i] == plain_fingerprint(texts[rows[i]["doc_id"]]) for i in range(0, 50))
    label = plain_components(prints)
    smallest = {}
    for r, g in zip(rows, label):
        smallest[g] = min(smallest.get(g, r["doc_id"]), r["doc_id"])
    assert [r["component_id"] for r in rows] == [smallest[g] for g in label]


def test_awkward_rows(spark):
    docs = awkward_documents(spark)
    rows = collected(simhash.near_duplicates(docs), "doc_id", "component_id")
    found = dict(rows)
    assert len(rows) == docs.count()
    assert found[2] == found[3] == found[4] == 2  # no words: fingerprint zero
    assert found[1] == found[9] == 1
    assert found[None] is None
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == [1, 2, 5, 6, 7, 8] and ids.count(None) == 1
    assert simhash.keep_one(docs.limit(0)).count() == 0
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def test_rows_without_ids_are_told_apart_by_fingerprint(spark):
    docs = documents(spark, [(None, "alpha beta gamma delta epsilon"),
                             (None, "alpha beta gamma delta epsilon"),
                             (None, "something else altogether in here")])
    assert simhash.keep_one(docs).count() == 2


def test_a_reused_id_loses_no_component(spark):
    one, two = "alpha beta gamma delta epsilon", "quite another text that nobody else has"
    docs = documents(spark, [(1, one), (1, two), (2, two), (3, one), (1, one)])
    kept = collected(simhash.keep_one(docs), "doc_id", "text")
    assert kept == [(1, one), (1, two)]


def test_clashing_columns_keep_their_values(spark):
    docs = documents(spark, [(1, "alpha beta"), (2, "gamma delta")])
    for name in ("_fp", "_root", "fp", "row", "row_hash", "root", "component_id", "a.b"):
        docs = docs.withColumn(name, F.concat(F.lit(name), F.col("doc_id").cast("string")))
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(map(tuple, kept.collect())) == sorted(map(tuple, docs.collect()))
