"""Queries of this package: ``opN_<name>`` per operator, over whole tables, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from floe.llm import ann, bpe, chat, embdup, minhash, mixing, pii, spelling, suffix, tokencounts, tokenfiles, toxicity, trie
from floe.sources.tables import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _add(name: str, oracle: str | None = None):
    def wrap(fn):
        QUERIES[name] = fn
        if oracle:
            ORACLES[name] = oracle
        return fn

    return wrap


@_add("op7_mix_sources", mixing.ORACLE_SQL)
def mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.digest(read_table(spark, sf_dir, "documents", ["doc_id", "text", "source"]))


@_add("op10_minhash_near_dedup")
def minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.digest(read_table(spark, sf_dir, "documents", ["doc_id", "text"]))


@_add("op9_embedding_near_dedup")
def embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embdup.digest(read_table(spark, sf_dir, "embeddings", ["vec_id", "embedding", "label"]))


@_add("op1_collision_counting_ann")
def collision_counting_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(read_table(spark, sf_dir, "embeddings", ["vec_id", "embedding"]))


@_add("op5_tree_bpe")
def tree_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digest(read_table(spark, sf_dir, "documents", ["doc_id", "text"]), public_tokenizers.path("byte_bpe_50k.json"))


@_add("op2_packed_token_files")
def packed_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenfiles.digest(read_table(spark, sf_dir, "documents", ["doc_id", "text"]), public_tokenizers.path("word_bpe_49k.json"))


@_add("op3_perspective_chat", chat.ORACLE_SQL)
def perspective_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.perspectives(read_table(spark, sf_dir, "conversations"))


@_add("op4_lexicon_toxicity")
def lexicon_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    return toxicity.digest(docs, read_table(spark, sf_dir, "labels", ["doc_id", "toxic"]))


@_add("op6_boosted_pii")
def boosted_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(read_table(spark, sf_dir, "documents", ["doc_id", "text"]))


@_add("op8_suffix_dedup")
def suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.digest(read_table(spark, sf_dir, "documents", ["doc_id", "text"]))


@_add("op13_token_counts")
def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencounts.digest(read_table(spark, sf_dir, "documents", ["doc_id", "text"]), public_tokenizers.path("word_bpe_49k.json"))


@_add("op11_spelling_variants", spelling.ORACLE_SQL)
def spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.digest(read_table(spark, sf_dir, "documents", ["doc_id", "text"]))


@_add("op12_prefix_trie", trie.ORACLE_SQL)
def prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(read_table(spark, sf_dir, "conversations", ["conv_id", "turn", "role", "text"]))
