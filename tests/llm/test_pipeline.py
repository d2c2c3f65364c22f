"""The stages one after the other, against brute force on each stage's own input."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tallymart.llm import registry, simhash, toxicity
from tallymart.llm.common import table
from tests.llm.frames import awkward_documents
from tests.llm.test_layout import plain_ids
from tests.llm.test_simhash import plain_components


def test_stages_are_declared():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "quality", "simhash_dedup", "source_mixing", "packing"]
    assert corpus_pipeline.ORACLE_SQL is None


@pytest.fixture(scope="module")
def outputs(spark, tmp_path_factory):
    directory = "/root/testdata/sf0.01"
    folder = tmp_path_factory.mktemp("pipeline")
    docs = table(spark, directory, "documents")
    kept = [docs]
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, directory).write.parquet(f"{folder}/{number}")
        docs = spark.read.parquet(f"{folder}/{number}")
        kept.append(docs)
    return kept


def test_columns_stay(outputs):
    assert all(df.columns == outputs[0].columns for df in outputs[:-1])


def test_filters_drop_what_the_classifier_rejects(spark, outputs):
    directory = "/root/testdata/sf0.01"
    scored = registry.queries()["op7_toxicity_fm"](spark, directory)
    expected = {r["doc_id"] for r in scored.where("predicted = 0").collect()}
    assert {r["doc_id"] for r in outputs[1].collect()} == expected
    labels = table(spark, directory, "labels")
    clean = labels.where("toxic = 0").join(outputs[0], "doc_id").count()
    left = labels.where("toxic = 0").join(outputs[1], "doc_id").count()
    assert left >= 0.98 * clean
    good = labels.where("quality = 1").join(outputs[1], "doc_id").count()
    assert labels.where("quality = 1").join(outputs[2], "doc_id").count() >= 0.97 * good
    bad = labels.where("quality = 0").join(outputs[1], "doc_id").count()
    assert labels.where("quality = 0").join(outputs[2], "doc_id").count() <= 0.2 * bad
    assert toxicity.THRESHOLD == 0.5


def test_one_document_of_each_group_stays(outputs):
    rows = sorted((r["doc_id"], r["text"]) for r in outputs[2].collect())
    label = plain_components([simhash.fingerprint(t) for _, t in rows])
    smallest = {}
    for (doc_id, _), g in zip(rows, label):
        smallest[g] = min(smallest.get(g, doc_id), doc_id)
    assert sorted(r["doc_id"] for r in outputs[3].collect()) == sorted(smallest.values())


def gapless(pieces):
    """Pieces fill their sequences from 0, without gaps and up to 4,096 tokens."""
    sequences = {}
    for r in pieces:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= 4096


def test_copies_and_sequences(outputs):
    before = {r["doc_id"]: r for r in outputs[3].collect()}
    copies = outputs[4].collect()
    assert all(before[r["doc_id"]] == r for r in copies)
    pieces = outputs[5].collect()
    total = sum(map(len, plain_ids([r["text"] for r in copies])))
    assert sum(r["length"] for r in pieces) == total
    first_copy = {r["doc_id"]: 0 for r in copies}
    assert set(first_copy) == {r["doc_id"] for r in pieces}
    gapless(pieces)


def test_stages_take_awkward_rows_and_empty_tables(spark, sf_small):
    """Stages keep rows as they are; one document of each group stays; every token is packed."""
    plain = awkward_documents(spark)
    before = {tuple(r) for r in plain.collect()}
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, plain.limit(0), sf_small).count() == 0
        result = stage(spark, plain, sf_small)
        rows = result.collect()
        if name == "packing":
            texts = [r["text"] for r in plain.collect()]
            assert sum(r["length"] for r in rows) == sum(map(len, plain_ids(texts)))
            gapless(rows)
            continue
        assert result.columns == plain.columns
        assert {tuple(r) for r in rows} <= before
        if name == "simhash_dedup":
            texts = [r["text"] for r in plain.collect()]
            assert len(rows) == len(set(plain_components([simhash.fingerprint(t) for t in texts])))
        elif name != "source_mixing":
            assert len(rows) <= plain.count()


def test_run_equals_its_query(spark, sf_small):
    import __spark_entry__ as entry_module
    rows = entry_module.queries()["pipeline"](spark, sf_small)
    assert rows.where(F.col("sequence_id").isNull()).count() == 0 and rows.count() > 0
