"""The thirteen operators and the corpus pipeline as registered queries, and SQL where it can say them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymart.llm import (
    bitslice,
    bpe,
    extract,
    hilbert,
    lexical,
    packing,
    poisson,
    projections,
    quality,
    simhash,
    toxicity,
    warc,
    whiten,
)
from tallymart.llm.common import share_code, table
from tallymart.llm.counterparts import SQL

TOKENIZER = "word_bpe_49k.json"
RANKS = "byte_bpe_50k.tiktoken"


def tokenizer_path() -> str:
    return public_tokenizers.path(TOKENIZER)


def op1_quality_fm(spark: SparkSession, directory: str) -> DataFrame:
    return quality.classify(table(spark, directory, "documents"),
                            table(spark, directory, "labels"))


def op2_projection_dedup(spark: SparkSession, directory: str) -> DataFrame:
    return projections.near_duplicates(table(spark, directory, "embeddings"))


def op3_bitslice_topk(spark: SparkSession, directory: str) -> DataFrame:
    return bitslice.top_k(table(spark, directory, "embeddings"))


def op4_host_consensus_text(spark: SparkSession, directory: str) -> DataFrame:
    return extract.extract(table(spark, directory, "pages"))


def op5_hilbert_shards(spark: SparkSession, directory: str) -> DataFrame:
    return hilbert.shard(table(spark, directory, "documents"))


def op6_warc_archive(spark: SparkSession, directory: str) -> DataFrame:
    records = warc.write_and_verify(spark, table(spark, directory, "pages"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_toxicity_fm(spark: SparkSession, directory: str) -> DataFrame:
    return toxicity.classify(table(spark, directory, "documents"),
                             table(spark, directory, "labels"))


def op8_poisson_mix(spark: SparkSession, directory: str) -> DataFrame:
    copies = poisson.mix(table(spark, directory, "documents"))
    return copies.withColumn("rate", F.round("rate", 6))


def op9_simhash_vptree(spark: SparkSession, directory: str) -> DataFrame:
    return simhash.fingerprints_and_components(table(spark, directory, "documents"))


def op10_histogram_packing(spark: SparkSession, directory: str) -> DataFrame:
    return packing.pack(table(spark, directory, "documents"), tokenizer_path())


def op11_polynomial_whitening(spark: SparkSession, directory: str) -> DataFrame:
    return whiten.whiten(table(spark, directory, "embeddings"))


def op12_pipelined_search(spark: SparkSession, directory: str) -> DataFrame:
    return lexical.search(table(spark, directory, "documents"),
                          table(spark, directory, "benchmark"))


def op13_rank_queue_bpe(spark: SparkSession, directory: str) -> DataFrame:
    return bpe.round_trip(table(spark, directory, "documents"), public_tokenizers.path(RANKS),
                          public_tokenizers.PATTERN)


Query = Callable[[SparkSession, str], DataFrame]


def _with_code(query: Query) -> Query:
    def run(spark: SparkSession, directory: str) -> DataFrame:
        share_code(spark)
        return query(spark, directory)

    return run


def queries() -> dict[str, Query]:
    return {f.__name__: _with_code(f) for f in (
        op1_quality_fm, op2_projection_dedup, op3_bitslice_topk, op4_host_consensus_text,
        op5_hilbert_shards, op6_warc_archive, op7_toxicity_fm, op8_poisson_mix,
        op9_simhash_vptree, op10_histogram_packing, op11_polynomial_whitening,
        op12_pipelined_search, op13_rank_queue_bpe)}


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
