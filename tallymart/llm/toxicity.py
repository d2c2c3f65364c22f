"""Toxicity: a factorisation machine over hashed terms.

Pairs of terms, such as an insult with the mention of a group, get weights that a sum over single
terms cannot express. The only inputs of a score are the words of the whole text.

Defined cases: NULL and empty texts have no terms and get the score of the bias; repeated rows get
equal scores; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymart.llm import fm
from tallymart.llm.common import id_remainder

CONFIG = fm.FmConfig(affix=4, epochs=600, l2_linear=1e-5, l2_factors=1e-4, seed=11)
THRESHOLD = 0.5
FOLDS, HELD_OUT = 5, 0


def no_structure(raw: bytes, words: list[bytes]) -> list[float]:
    """One constant, so that a text without known terms still has a feature."""
    return [0.0]


def train(documents: DataFrame, labels: DataFrame, config: fm.FmConfig = CONFIG) -> fm.FmModel:
    """Fit on the labelled documents outside the held-out part."""
    learn_from = id_remainder(F.col("doc_id"), FOLDS) != HELD_OUT
    return fm.fit(documents, labels, "toxic", learn_from, no_structure, (), config)


def toxicity_score(documents: DataFrame, model: fm.FmModel) -> Column:
    """Probability of label 1 for each row."""
    return fm.score(documents, model, no_structure)


def classify(documents: DataFrame, labels: DataFrame, config: fm.FmConfig = CONFIG) -> DataFrame:
    """doc_id, held_out, score and predicted of every row."""
    scored = documents.select(
        "doc_id",
        (id_remainder(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"),
        toxicity_score(documents, train(documents, labels, config)).alias("score"),
    )
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def accept(documents: DataFrame, labels: DataFrame, config: fm.FmConfig = CONFIG) -> DataFrame:
    """The rows that the classifier does not reject, with their columns."""
    score = toxicity_score(documents, train(documents, labels, config))
    return documents.where(score < THRESHOLD)
