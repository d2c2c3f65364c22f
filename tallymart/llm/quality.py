"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

``classify`` scores every row of a document table. Inputs of a score are the whole text and
``n_chars``; id, language, source and labels never are.

Defined cases: NULL and empty texts have no words and all-zero statistics and are scored like any
other; a NULL ``n_chars`` has a bin of its own; repeated rows get equal scores; an empty table gives
an empty result; further columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymart.llm import fm
from tallymart.llm.common import id_remainder

CONFIG = fm.FmConfig(bins=12, l2_linear=3e-4, l2_factors=3e-3)
METADATA = ("n_chars",)
THRESHOLD = 0.7
FOLDS, HELD_OUT = 4, 2

UPPER = slice(65, 91)
DIGITS = slice(48, 58)
SPACES = (32, 9, 10, 11, 12, 13)
MARKS = (44, 46, 39, 45)  # comma, full stop, apostrophe, hyphen


def structure(raw: bytes, words: list[bytes]) -> list[float]:
    """Structure statistics of a whole text in UTF-8."""
    counts = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256)
    size = max(len(raw), 1)
    letters = int(counts[65:91].sum() + counts[97:123].sum() + counts[128:].sum())
    spaces = int(counts[list(SPACES)].sum())
    digits = int(counts[DIGITS].sum())
    marks = int(counts[list(MARKS)].sum())
    total = max(len(words), 1)
    tokens = raw.split()
    lines = raw.split(b"\n")
    return [
        math.log2(len(words) + 1),
        sum(map(len, words)) / total,
        len(set(words)) / total,
        sum(a == b for a, b in zip(words, words[1:])) / total,
        int(counts[UPPER].sum()) / max(letters, 1),
        marks / size,
        (len(raw) - letters - spaces - digits - marks) / size,  # all other symbols
        len(tokens) / total,
        math.log2(size / len(lines)),
        1 - len(set(lines)) / len(lines),
    ]


def train(documents: DataFrame, labels: DataFrame, config: fm.FmConfig = CONFIG) -> fm.FmModel:
    """Fit on the labelled documents outside the held-out part."""
    learn_from = id_remainder(F.col("doc_id"), FOLDS) != HELD_OUT
    return fm.fit(documents, labels, "quality", learn_from, structure, METADATA, config)


def quality_score(documents: DataFrame, model: fm.FmModel) -> Column:
    """Probability of label 1 for each row."""
    return fm.score(documents, model, structure, METADATA)


def classify(documents: DataFrame, labels: DataFrame, config: fm.FmConfig = CONFIG) -> DataFrame:
    """doc_id, held_out, score and predicted of every row."""
    scored = documents.select(
        "doc_id",
        (id_remainder(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"),
        quality_score(documents, train(documents, labels, config)).alias("score"),
    )
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def accept(documents: DataFrame, labels: DataFrame, config: fm.FmConfig = CONFIG) -> DataFrame:
    """The rows that the classifier does not reject, with their columns."""
    score = quality_score(documents, train(documents, labels, config))
    return documents.where(score >= THRESHOLD)
