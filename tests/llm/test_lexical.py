"""Ranked lexical search against brute force."""

import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tallymart.llm import lexical
from tallymart.llm.common import share_code
from tests.llm.frames import awkward_documents, documents

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms_of(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return TERM.findall(lowered)


def brute_force(docs, items, top=10):
    """docs and items as lists of (id, text)."""
    counted = [(i, Counter(terms_of(t))) for i, t in docs]
    n_docs = sum(1 for _, c in counted if c)
    n_terms = sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item_id, text in items:
        scored = []
        for doc_id, c in counted:
            n, score = sum(c.values()), 0
            for t in terms_of(text):
                if t in c:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    m = 25 + 75 * n * n_docs // n_terms
                    score += w * (1000000000 * c[t] // (1000 * c[t] + 8 * m))
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        out += [(item_id, rank + 1, s[3], -s[0]) for rank, s in enumerate(sorted(scored)[:top])]
    return out


def key(row):
    return tuple((x is None, x or 0) for x in row)


def check(spark, docs, items, frame=None, top=10):
    share_code(spark)
    table = spark.createDataFrame(items, "item_id long, text string")
    got = lexical.search(frame if frame is not None else documents(spark, docs), table, top)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=key) == sorted(
        brute_force(docs, items, top), key=key)


def corpus(n, seed=5):
    import random

    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    weights = [1 / (i + 1) for i in range(400)]
    return [(i, " ".join(rng.choices(words, weights, k=rng.randint(1, 60)))) for i in range(n)]


def test_common_and_rare_terms(spark):
    docs = corpus(900)
    items = [(i, " ".join(t.split()[:12])) for i, t in corpus(30, seed=9)]
    check(spark, docs, items)


def test_several_blocks_and_bundles(spark, monkeypatch):
    monkeypatch.setattr(lexical, "BLOCK_BITS", 5)
    monkeypatch.setattr(lexical, "BUNDLE_ITEMS", 4)
    docs = corpus(700)
    items = [(i, t) for i, t in corpus(15, seed=2)]
    check(spark, docs, items, documents(spark, docs).repartition(5))


def test_a_third_of_all_rows_tie(spark, monkeypatch):
    monkeypatch.setattr(lexical, "BLOCK_BITS", 4)
    docs = corpus(200) + [(1000 - i, "copy of one text w0 w1") for i in range(100)]
    check(spark, docs, [(1, "one copy"), (2, "w0"), (3, "text text text w399")],
          documents(spark, docs).repartition(7))


def test_one_stage_holds_everything(spark, monkeypatch):
    monkeypatch.setattr(lexical, "STAGE_SHARES", ())
    check(spark, corpus(150), [(i, t) for i, t in corpus(5, seed=4)])


def test_awkward_rows(spark):
    frame = awkward_documents(spark).withColumn("terms", F.lit("x")).withColumn("row", F.lit(1))
    docs = [(r["doc_id"], r["text"]) for r in frame.collect()]
    check(spark, docs, [
        (1, "the cat and the dog"), (1, "the cat and the dog"), (2, None), (3, ""), (4, "!?"),
        (None, "text without"), (5, "word"), (6, "NAÏVE naïve CAFé 中文"), (7, "absent terms")],
        frame)


@pytest.mark.parametrize("docs, items", [([], [(1, "a")]), ([(1, "a b")], []), ([], []),
                                         ([(1, None), (2, "")], [(1, "a")])])
def test_empty_tables(spark, docs, items):
    check(spark, docs, items)
