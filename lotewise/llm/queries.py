"""The registered queries: each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotewise.llm import (
    conversation_trie,
    embedding_dedup,
    line_dedup,
    lm_scoring,
    oracle,
    packing,
    pii,
    quality,
    secrets,
    sentencepiece_codec,
    simhash,
    suffix_dedup,
    toxicity,
    whitening,
)
from lotewise.llm.common import bucket_of, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {
    "op5_embedding_near_dedup": oracle.EMBEDDINGS,
    "op11_conversation_trie": oracle.CONVERSATIONS,
    "op13_suffix_dedup": oracle.REPEATS,
}


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function


@query
def op7_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.find_secrets(table(spark, sf_dir, "documents")))


@query
def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.find_personal_data(table(spark, sf_dir, "documents")))


@query
def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.digest(quality.judged(table(spark, sf_dir, "documents").select("doc_id", "text")))


@query
def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


@query
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = bucket_of(F.col("doc_id"), 3) == 1
    labels = table(spark, sf_dir, "labels").filter(~held_out)
    scored = toxicity.score_documents(table(spark, sf_dir, "documents"), labels)
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted", "toxic_sentences")


@query
def op5_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


@query
def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score_texts(table(spark, sf_dir, "documents"), bucket_of(F.col("doc_id"), 10) == 0)


@query
def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_codec.round_trip(table(spark, sf_dir, "documents"))


@query
def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    talks = conversation_trie.turns(table(spark, sf_dir, "conversations"))
    return conversation_trie.prefix_trie(conversation_trie.with_shared_heads(talks))


@query
def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


@query
def op13_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
