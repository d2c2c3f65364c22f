"""Byte-level BPE against the tiktoken library."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from tallymart.llm import bpe, registry
from tallymart.llm.common import share_code, table
from tests.llm.frames import awkward_documents, collected, documents

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def codec():
    return bpe.codec(PATH, PATTERN)


@pytest.fixture(scope="module")
def library(codec):
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=codec.ranks, special_tokens={})


def ids_of(codec, text):
    return np.frombuffer(codec.encode(text), "<u4").tolist()


@pytest.mark.parametrize("alphabet", [
    "a", "ab", "the ing", "aA1 \n\t'sre", "=-_*", "é中\U0001f600ab ", "́e  \u0085x", "0123456789"])
def test_random_texts(codec, library, alphabet):
    rng = random.Random(alphabet)
    for n in (0, 1, 2, 3, 7, 40, 600, 5000):
        for _ in range(6):
            text = "".join(rng.choice(alphabet) for _ in range(n))
            assert ids_of(codec, text) == library.encode_ordinary(text)
            assert codec.decode(codec.encode(text)) == text.encode()


def test_ties_leave_from_left_to_right(codec, library):
    for word in ("aaa", "aaaaaaa", "abababab" * 50, "xyxyxyx" * 300, "lllll" * 999):
        assert ids_of(codec, word) == library.encode_ordinary(word)


def test_queue_is_empty_after_a_pre_token(codec):
    codec.merge(b"qwertzuiopasdfghjkl" * 40)
    assert not any(codec.bitmap)


def test_very_long_pre_token(codec, library):
    rng = random.Random(3)
    text = "".join(rng.choice("abcdefgh") for _ in range(300_000))
    assert ids_of(codec, text) == library.encode_ordinary(text)


def test_long_texts_are_split_in_blocks(codec, library, monkeypatch):
    monkeypatch.setattr(bpe, "MATCHES", 7)
    text = "some words, and 12 numbers; \n\n then   more " * 20
    assert ids_of(codec, text) == library.encode_ordinary(text)
    assert codec.decode(codec.encode(text)) == text.encode()


def test_forgetting_changes_nothing(library, codec, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_WORDS", 8)
    small = bpe.Codec(codec.ranks, PATTERN)
    text = " ".join(f"word{i % 23}qz" for i in range(400))
    assert ids_of(small, text) == library.encode_ordinary(text)
    assert len(small.known) <= 4 and len(small.known.older) <= 4


def expected(library, text):
    ids = library.encode_ordinary(text or "")
    raw = np.array(ids, "<u4").tobytes()
    return len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()


def test_awkward_rows(spark, library):
    share_code(spark)
    frame = awkward_documents(spark).withColumn("n_tokens", F.lit("extra"))
    got = bpe.round_trip(frame, PATH, PATTERN)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    want = sorted(((r["doc_id"], *expected(library, r["text"])) for r in frame.collect()),
                  key=lambda r: (r[0] is None, r))
    assert sorted(map(tuple, got.collect()), key=lambda r: (r[0] is None, r)) == want


def test_empty_table(spark):
    share_code(spark)
    assert bpe.round_trip(documents(spark, []), PATH, PATTERN).count() == 0


def test_columns_of_ids_and_bytes(spark, library):
    share_code(spark)
    frame = documents(spark, [(1, "naïve words"), (2, None)])
    rows = frame.withColumn("ids", bpe.encoded(F.col("text"), PATH, PATTERN)).withColumn(
        "bytes", bpe.decoded(F.col("ids"), PATH, PATTERN))
    assert collected(rows.select("doc_id", F.col("bytes").cast("string").alias("b")),
                     "doc_id", "b") == [(1, "naïve words"), (2, "")]


def test_whole_table(spark, sf_small, library):
    texts = {r["doc_id"]: r["text"] for r in table(spark, sf_small, "documents").collect()}
    rows = registry.queries()["op13_rank_queue_bpe"](spark, sf_small).collect()
    assert len(rows) == len(texts)
    for row in rows:
        assert tuple(row)[1:] == expected(library, texts[row["doc_id"]])
