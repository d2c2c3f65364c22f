"""Hilbert shards, Poisson mixing and packing."""

import random
import unicodedata
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallymart.llm import hilbert, packing, poisson, registry
from tallymart.llm.ranks import with_positions
from tests.llm.frames import awkward_documents, documents

# --- positions and Hilbert shards ----------------------------------------------------------------


@pytest.mark.parametrize("dimensions, bits", [(2, 1), (2, 3), (3, 2), (3, 5), (4, 2)])
def test_the_curve_visits_every_cell_in_unit_steps(spark, dimensions, bits):
    cells = {r["h"]: r["cell"] for r in hilbert.curve(spark, dimensions, bits).collect()}
    assert sorted(cells) == list(range(1 << (dimensions * bits)))
    mask = (1 << bits) - 1
    points = [[cells[h] >> (bits * i) & mask for i in range(dimensions)] for h in range(len(cells))]
    assert all(sum(abs(a - b) for a, b in zip(p, q)) == 1 for p, q in zip(points, points[1:]))


def test_positions_are_gapless_and_sorted(spark):
    df = spark.range(1000).select((F.col("id") * 7 % 100).alias("x"), "id")
    placed, total = with_positions(df, ["x", "id"], 6, "test")
    rows = sorted(placed.collect(), key=lambda r: r["position"])
    assert total == 1000 and [r["position"] for r in rows] == list(range(1000))
    assert [(r["x"], r["id"]) for r in rows] == sorted((r["x"], r["id"]) for r in rows)


@pytest.mark.parametrize("n", [0, 1, 23, 24, 25, 1000])
def test_shards_are_even_and_slots_gapless(spark, n):
    docs = documents(spark, [(i, "x" * (i % 50), "en", f"src{i % 3}", i % 50) for i in range(n)])
    rows = hilbert.shard(docs).collect()
    assert len(rows) == n
    sizes = Counter(r["shard"] for r in rows)
    assert set(sizes) <= set(range(24))
    assert max([sizes[s] for s in range(24)]) - min([sizes[s] for s in range(24)]) <= 1
    for s in sizes:
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(sizes[s]))


def test_shards_of_awkward_rows(spark):
    docs = awkward_documents(spark)
    got = sorted((str(r["doc_id"]), r["size"], r["text_crc32"]) for r in
                 hilbert.shard(docs).collect())
    expected = sorted(
        (str(r["doc_id"]), 8 + len((r["text"] or "").encode()),
         zlib.crc32((r["text"] or "").encode())) for r in docs.collect())
    assert got == expected


def test_a_filter_on_a_dimension_prunes_shards(spark, sf_medium):
    docs = spark.read.parquet(f"{sf_medium}/documents.parquet")
    shards = hilbert.shard(docs).join(docs, "doc_id")
    for column, value in (("source", "src3"), ("lang", "es")):
        hit = shards.where(F.col(column) == value).select("shard").distinct().count()
        assert hit <= 14


def test_the_whole_order_against_brute_force(spark, sf_small):
    """Quantile cells, place on the curve, ties and cuts, over plain lists."""
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    rows = [(r["lang"], r["source"], 8 + len((r["text"] or "").encode()), r["doc_id"],
             zlib.crc32((r["text"] or "").encode())) for r in docs.collect()]
    n, cell = len(rows), [0] * len(rows)
    for dimension in range(3):
        ordered = sorted(r[dimension] for r in rows)
        # Quantile i is the smallest value that i / 32 of the rows do not exceed.
        edges = {ordered[-(-i * n // 32) - 1] for i in range(1, 32)}
        step = 32 // (len(edges) + 1)
        for i, r in enumerate(rows):
            cell[i] = cell[i] * 32 + sum(r[dimension] >= e for e in edges) * step
    place = {r["cell"]: r["h"] for r in hilbert.curve(spark, 3, 5).collect()}
    ordered = sorted((place[c], r[4], r[3], r[2]) for c, r in zip(cell, rows))
    cuts = [s * n // 24 for s in range(25)]
    expected = {(doc, s, at - cuts[s]) for s in range(24)
                for at, (_, _, doc, _) in enumerate(ordered[cuts[s]:cuts[s + 1]], cuts[s])}
    found = {(r["doc_id"], r["shard"], r["slot"]) for r in hilbert.shard(docs).collect()}
    assert len(rows) == len(found) and found == expected


@pytest.mark.parametrize("prefix", ["common_crawl_", "https://www.example.org/feed/"])
def test_sources_of_one_prefix_are_kept_apart(spark, monkeypatch, prefix):
    monkeypatch.setattr(hilbert, "RUN", 6)
    docs = documents(spark, [(i, "x" * (i * 37 % 101), "en", f"{prefix}{i % 20:02d}", 1)
                             for i in range(4000)])
    plain = docs.withColumn("source", F.substring("source", len(prefix) + 1, 2))
    for number in ("03", "11"):
        hits = [hilbert.shard(d).join(docs, "doc_id").where(F.col("source") == prefix + number)
                .select("shard").distinct().count() for d in (docs, plain)]
        assert hits[0] == hits[1] <= 8


def test_hilbert_shards_run_without_python(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    plan = hilbert.shard(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


# --- Poisson mixing ------------------------------------------------------------------------------


@pytest.mark.parametrize("mean", [0.0, 0.01, 0.7, 3.0, 40.0, 2000.0])
def test_inverse_poisson(spark, mean):
    from math import exp, lgamma, log
    u = [0.0001, 0.2, 0.5, 0.9, 0.999999]
    df = spark.createDataFrame([(x, mean) for x in u], "u double, mean double")
    got = [r["k"] for r in df.select(
        "u", poisson.inverse_poisson(F.col("u"), F.col("mean")).alias("k")).orderBy("u").collect()]
    for x, k in zip(u, got):
        def cdf(n):
            return sum(exp(i * log(mean) - mean - lgamma(i + 1)) for i in range(n + 1))
        assert (k == 0 if mean == 0 else cdf(k) >= x - 1e-9 and (k == 0 or cdf(k - 1) < x + 1e-9))


def test_rows_per_source_follow_the_weights(spark):
    docs = documents(spark, [(i, "t", "en", "big" if i % 10 else "small", 1)
                             for i in range(20_000)])
    mixed = poisson.mix(docs, {"big": 1.0, "small": 1.0}, total=30_000)
    counts = {r["source"]: r["count"] for r in mixed.groupBy("source").count().collect()}
    assert abs(counts["big"] - 15_000) < 700 and abs(counts["small"] - 15_000) < 700


def test_the_draw_does_not_depend_on_partitions(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    one = sorted((r["doc_id"], r["copy"]) for r in poisson.mix(docs).collect())
    other = sorted((r["doc_id"], r["copy"]) for r in
                   poisson.mix(docs.repartition(7, "n_chars")).collect())
    assert one == other
    order = [r["doc_id"] for r in poisson.mix(docs).collect()]
    assert order != sorted(order)


def test_mixing_keeps_the_values_of_the_caller_s_columns(spark):
    docs = documents(spark, [(i, f"text {i}") for i in range(30)])
    for name in ("rate", "copy", "copies", "shuffle_key", "_source", "doc", "row", "_place",
                 "position", "a.b"):
        docs = docs.withColumn(name, F.concat(F.lit(name), F.col("doc_id").cast("string")))
    own = {r["doc_id"]: tuple(r) for r in docs.collect()}
    mixed = poisson.mixed(docs, total=90)
    assert mixed.columns == docs.columns
    rows = mixed.collect()
    assert rows and all(tuple(r) == own[r["doc_id"]] for r in rows)


def test_rows_without_ids_are_mixed_by_rate(spark):
    rows = [(None, f"text {i}", "en", f"src{i % 2}", 1) for i in range(1000)]
    for seed in (17, 18, 19):
        counts = Counter(r["source"] for r in poisson.mix(
            documents(spark, rows), {"src0": 1.0, "src1": 1.0}, total=1000, seed=seed).collect())
        assert all(abs(counts[s] - 500) < 4 * 500 ** 0.5 for s in ("src0", "src1"))


def test_mixing_awkward_rows(spark):
    docs = awkward_documents(spark)
    mixed = poisson.mix(docs, total=1000).collect()
    by_source = Counter(r["source"] for r in mixed)
    assert set(by_source) == {"src0", None}
    per_row = Counter((r["doc_id"], r["text"] is None) for r in mixed)
    assert per_row[(1, False)] % 2 == 0  # the repeated row draws as its copy does
    only = poisson.mixed(docs, {"src0": 1.0}, total=1000)
    assert only.columns == docs.columns and only.where("source IS NULL").count() == 0
    assert poisson.mix(docs.limit(0)).count() == 0
    assert poisson.mix(docs, {}).count() == 0
    assert poisson.mix(docs, {"src0": 0.0}).count() == 0


def test_many_sources_need_no_broadcast(spark, monkeypatch):
    docs = documents(spark, [(i, "t", "en", f"s{i % 30}", 1) for i in range(300)])
    few = sorted((r["doc_id"], r["copy"]) for r in poisson.mix(docs).collect())
    monkeypatch.setattr(poisson, "BROADCAST_SOURCES", 5)
    assert sorted((r["doc_id"], r["copy"]) for r in poisson.mix(docs).collect()) == few


# --- packing -------------------------------------------------------------------------------------


def plain_ids(texts):
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(registry.tokenizer_path())
    return [tokenizer.encode(t or "", add_special_tokens=False).ids + [2] for t in texts]


TEXTS = [None, "", " \n", "Hello, World!", "it's don't we'll 'tis O'Neil's", "ΟΔΟΣ Σ ς İi",
         "é é ﬁ ½ ² Ⅳ 中文字 　   x y", "a\x1cb\x0bc\x0cd\x85e", "<|endoftext|> x",
         "… ... …. word…. (a) [b]{c} 3.14 1,000 x2y", "\U0001f600\U0001f600! ok?!", "A" * 300,
         "don’t “quoted” –dash—", "ab́. q́! ́ .̸ ≮"]


def test_ids_equal_the_tokenizer_s():
    encoder = packing.WordEncoder(registry.tokenizer_path())
    for _ in range(2):  # the second time from the cache
        got = [np.frombuffer(b, "<u4").tolist() for b in encoder.encode(TEXTS)]
        assert got == [ids[:-1] for ids in plain_ids(TEXTS)]


def test_every_letter_before_and_after_punctuation():
    encoder = packing.WordEncoder(registry.tokenizer_path())
    marks = [chr(c) for c in range(33, 127) if not chr(c).isalnum()]
    known = [chr(c) for c in range(128, 0x3000)
             if unicodedata.category(chr(c))[0] in "LM"] + list("aZ")
    texts = [f"ab{c}{m}{c}b {m}{c}{m}" for i, c in enumerate(known)
             for m in (marks[i % len(marks)], ".", "<", "'", "_")]
    got = [np.frombuffer(b, "<u4").tolist() for b in encoder.encode(texts)]
    assert got == [ids[:-1] for ids in plain_ids(texts)]


def test_added_tokens_in_any_case():
    encoder = packing.WordEncoder(registry.tokenizer_path())
    texts = ["a<|endoftext|>b", "<|ENDOFTEXT|>", "x <|EndOfText|>, y", "<|startoftext|> <|", "<|end",
             "AB <|startoftext|><|endoftext|>.", "one <|STARTOFTEXT|>two"]
    got = [np.frombuffer(b, "<u4").tolist() for b in encoder.encode(texts)]
    assert got == [ids[:-1] for ids in plain_ids(texts)]


def test_random_texts_equal_the_tokenizer_s():
    rng = random.Random(12)
    letters = "abcXYZ àéßİıſ য়ড়क़ख़ਸ਼ଡ଼གྷ中文か\u0301\u0307 .,;!?<|>'_-\"()\n\t\u00a0\u200d0129"
    texts = ["".join(rng.choices(letters, k=rng.randint(0, 25))) for _ in range(30_000)]
    encoder = packing.WordEncoder(registry.tokenizer_path())
    got = [np.frombuffer(b, "<u4").tolist() for b in encoder.encode(texts)]
    assert got == [ids[:-1] for ids in plain_ids(texts)]


def test_ids_do_not_depend_on_the_cache(monkeypatch):
    monkeypatch.setattr(packing, "CACHE_WORDS", 4)
    encoder = packing.WordEncoder(registry.tokenizer_path())
    for _ in range(2):
        for text in TEXTS:  # words leave the cache and come back
            [got] = encoder.encode([text])
            assert np.frombuffer(got, "<u4").tolist() == plain_ids([text])[0][:-1]


@pytest.mark.parametrize("histogram", [
    {}, {1: 1}, {4095: 3}, {2048: 5}, {100: 10_007}, {n: 4096 - n for n in range(1, 4096)},
    {3000: 10, 1096: 10}, {4000: 7, 96: 7, 1: 5}])
def test_plan_holds_the_histogram(histogram):
    patterns = packing.plan(histogram, 4096)
    placed = Counter()
    for pattern, count in patterns:
        assert sum(pattern) <= 4096 and count > 0
        for length in pattern:
            placed[length] += count
    assert placed == histogram
    tokens = sum(k * v for k, v in histogram.items())
    sequences = sum(count for _, count in patterns)
    if histogram and set(histogram) != {4095}:
        assert sequences <= 1.05 * tokens / 4096 + 1


def check_packing(rows, ids, sequence):
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
    for doc_id, parts in by_doc.items():
        expected = ids[doc_id]
        at = 0
        for r in sorted(parts, key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(expected)
            piece = np.array(expected[at:at + r["length"]], "<u4").tobytes()
            assert zlib.crc32(piece) == r["ids_crc32"]
            at += r["length"]
        assert at == len(expected)
    assert set(by_doc) == set(ids)
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert sorted(sequences) == list(range(len(sequences)))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= sequence
    return sum(len(v) for v in ids.values()) / (sequence * max(1, len(sequences)))


@pytest.mark.parametrize("sequence", [8, 64])
def test_packing_small_texts(spark, sequence):
    texts = TEXTS + ["many words in a text " * n for n in range(1, 40)]
    docs = documents(spark, list(enumerate(texts)))
    rows = packing.pack(docs, registry.tokenizer_path(), sequence=sequence).collect()
    fill = check_packing(rows, dict(enumerate(plain_ids(texts))), sequence)
    assert fill > 0.9


def test_packing_the_corpus(spark, sf_medium):
    docs = spark.read.parquet(f"{sf_medium}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    rows = registry.queries()["op10_histogram_packing"](spark, sf_medium).collect()
    ids = dict(zip(texts, plain_ids(texts.values())))
    assert check_packing(rows, ids, 4096) > 0.97


def test_packing_awkward_rows(spark):
    docs = awkward_documents(spark)
    rows = packing.pack(docs, registry.tokenizer_path(), keep_ids=True).collect()
    total = sum(len(i) for i in plain_ids([r["text"] for r in docs.collect()]))
    assert sum(r["length"] for r in rows) == total
    assert all(zlib.crc32(bytes(r["ids"])) == r["ids_crc32"] for r in rows)
    taken = sorted((r["sequence_id"], r["offset"], r["offset"] + r["length"]) for r in rows)
    assert all(a[0] != b[0] or a[2] == b[1] for a, b in zip(taken, taken[1:]))
    assert packing.pack(docs.limit(0), registry.tokenizer_path()).count() == 0
