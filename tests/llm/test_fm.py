from dataclasses import replace

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallymart.llm import fm, quality, registry, toxicity
from tests.llm.frames import awkward_documents, collected, documents, remainder

LABELS = "doc_id long, quality int, toxic int"


def test_sum_of_squares_equals_all_pairs():
    rng = np.random.default_rng(0)
    model = fm.FmModel(fm.FmConfig(), np.zeros(1), [], np.array([]), 0.3, rng.normal(size=9),
                       rng.normal(size=(9, 4)))
    rows = np.array([1, 4, 7, 8])
    pairs = sum(model.factors[a] @ model.factors[b]
                for i, a in enumerate(rows) for b in rows[i + 1:])
    logit = 0.3 + model.linear[rows].sum() + pairs
    assert model.score_rows(rows) == pytest.approx(1 / (1 + np.exp(-logit)))


def test_a_pair_of_terms_is_learnt_that_no_sum_expresses():
    """Either word alone, but not both: no weights of single words can say that."""
    config = fm.FmConfig(hash_bits=8, min_z=0.0, min_documents=1, l2_linear=1e-5, l2_factors=1e-5, epochs=800,
                         learning_rate=0.05)
    texts, labels = [], []
    for number in range(400):
        insult, mention = number & 1, number >> 1 & 1
        words = [b"filler"] + [b"insult"] * insult + [b"mention"] * mention
        texts.append(fm.buckets_of(words, config))
        labels.append(insult ^ mention)  # not linearly separable
    model = fm.fit_arrays(np.array(labels), texts, np.zeros((400, 1)), config)
    scores = [model.score_rows(model.rows_of(b, [0.0])) for b in texts]
    assert all((s >= 0.5) == bool(y) for s, y in zip(scores, labels))


@pytest.mark.parametrize("config", [toxicity.CONFIG, quality.CONFIG])
def test_production_parameters_learn_a_pair_without_marginal_difference(config):
    rng = np.random.default_rng(4)
    texts, labels = [], []
    for number in range(2000):
        insult, mention = number & 1, number >> 1 & 1
        words = [b"insult"] * insult + [b"mention"] * mention
        words += [b"noise%dx" % i for i in rng.integers(0, 300, 20)]
        texts.append(fm.buckets_of(words, config))
        labels.append(insult ^ mention)
    y = np.array(labels)
    model = fm.fit_arrays(y[:1600], texts[:1600], np.zeros((1600, 1)), config)
    scores = np.array([model.score_rows(model.rows_of(b, [0.0])) for b in texts[1600:]])
    assert ((scores >= 0.5) == y[1600:]).mean() >= 0.98


def test_production_parameters_keep_rare_terms():
    """1 % toxic texts; each of 20 words is in 5 % of them and in 0.5 % of the others."""
    config, vocabulary, texts = toxicity.CONFIG, [b"w%02d" % i for i in range(20)], []
    for number in range(10_000):
        toxic, place = number < 100, number % 100 if number < 100 else number % 200
        words = [w for i, w in enumerate(vocabulary)
                 if (place // 5 == i if toxic else place == i)]
        texts.append(fm.buckets_of([b"filler", *words], config))
    y = (np.arange(10_000) < 100).astype(int)
    model = fm.fit_arrays(y, texts, np.zeros((10_000, 1)), replace(config, epochs=1))
    assert (model.terms[fm.buckets_of(vocabulary, config)] > 0).all()


def test_words_and_affixes():
    assert fm.words_of("Café, It's 12!".encode()) == ["café".encode(), b"it", b"s", b"12"]
    plain = fm.buckets_of([b"abcdefgh", b"ab"], fm.FmConfig())
    assert len(plain) == 2
    assert len(fm.buckets_of([b"abcdefgh", b"ab"], fm.FmConfig(affix=4))) == 4
    assert len(fm.buckets_of([], fm.FmConfig())) == 0


def test_structure_of_an_empty_text_is_finite():
    assert np.isfinite(quality.structure(b"", [])).all()


@pytest.mark.parametrize("module, column", [(quality, "quality"), (toxicity, "toxic")])
def test_awkward_rows(spark, module, column):
    docs = awkward_documents(spark)
    labels = spark.createDataFrame(
        [(1, 1, 0), (1, 1, 0), (2, 0, 1), (3, None, None), (None, 1, 1), (99, 1, 1)], LABELS)
    rows = module.classify(docs, labels).collect()
    assert len(rows) == docs.count()
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert all(r["predicted"] == int(r["score"] >= module.THRESHOLD) for r in rows)
    for r in rows:
        rest = remainder(r["doc_id"], module.FOLDS)
        assert r["held_out"] == (None if rest is None else rest == module.HELD_OUT)
    first = [r["score"] for r in rows if r["doc_id"] in (1, 9)]
    assert len(set(first)) == 1  # equal texts, equal scores
    assert module.classify(docs.limit(0), labels.limit(0)).count() == 0
    assert module.accept(docs, labels).columns == docs.columns


@pytest.mark.parametrize("module", [quality, toxicity])
def test_only_text_and_length_decide(spark, sf_small, module):
    """Held-out labels, and the other columns, do not change a score."""
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    labels = spark.read.parquet(f"{sf_small}/labels.parquet")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % module.FOLDS == module.HELD_OUT
    flipped = labels.withColumns({c: F.when(held, 1 - F.col(c)).otherwise(F.col(c))
                                  for c in ("quality", "toxic")})
    moved = docs.withColumn("lang", F.lit("xx")).withColumn("source", F.lit("yy"))
    assert collected(module.classify(docs, labels), "doc_id", "score") == collected(
        module.classify(moved, flipped), "doc_id", "score")


@pytest.mark.parametrize("name, column, at_least", [
    ("op1_quality_fm", "quality", 0.95), ("op7_toxicity_fm", "toxic", 0.93)])
def test_held_out_accuracy(spark, name, column, at_least):
    directory = "/root/testdata/sf0.1"
    scored = registry.queries()[name](spark, directory).where("held_out")
    labels = spark.read.parquet(f"{directory}/labels.parquet")
    both = scored.join(labels, "doc_id").select("score", "predicted", column).toPandas()
    assert (both["predicted"] == both[column]).mean() >= at_least
    ones, ranks = both[column] == 1, both["score"].rank()
    auc = (ranks[ones].mean() - (ones.sum() + 1) / 2) / (~ones).sum()
    assert auc >= 0.93


def test_features_of_missing_metadata():
    found = list(fm.features(pd.Series(["a", None]), [pd.Series([None, 3.0])], lambda r, w: [0.0],
                             fm.FmConfig()))
    assert np.isnan(found[0][1][1]) and found[1][1][1] == 3.0 and len(found[1][0]) == 0
