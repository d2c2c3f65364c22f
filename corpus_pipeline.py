"""From raw documents to packed training sequences, in five stages.

Each stage reads what the stage before it wrote: toxic documents go, then documents of low quality,
then all but one document of each group of near-duplicates; sources are mixed to their target
weights, and the copies are tokenised and packed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallymart.llm import packing, poisson, quality, simhash, toxicity
from tallymart.llm.common import share_code, table
from tallymart.llm.registry import tokenizer_path
from tallymart.workspace import scratch_dir, write_and_read


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.accept(docs, table(spark, sf_dir, "labels"))


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.accept(docs, table(spark, sf_dir, "labels"))


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return poisson.mixed(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", keep_good),
    ("simhash_dedup", keep_one_of_each),
    ("source_mixing", mix_sources),
    ("packing", pack_sequences),
]

# The two classifiers are fitted models, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a directory; every result is written and read again."""
    share_code(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = write_and_read(stage(spark, docs, sf_dir), scratch_dir(spark, f"pipeline/{name}"))
    return STAGES[-1][1](spark, docs, sf_dir)
