"""Corpus pipeline: documents through five operators, each stage written as Parquet and read again.

1. toxicity: documents that the lexicon score rejects go.
2. MinHash near-dedup: one document of each group stays.
3. PII: redactions replace the spans in the text.
4. mixing: sources are taken to their target weights.
5. BPE: token ids, and their decoding's digest.

All but the last stage return the columns of ``documents``; ``n_chars``
follows a changed text.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from floe.llm import bpe, minhash, mixing, pii, toxicity
from floe.llm.common import stored
from floe.sources.tables import read_table

TOKENIZER = "byte_bpe_50k.json"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below 0.5 by a lexicon learned from ``labels``."""
    return toxicity.keep_clean(docs, read_table(spark, sf_dir, "labels", ["doc_id", "toxic"]))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five-word shingles, similarity 0.8) stays."""
    return minhash.keep_one(docs)


def redact_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind in brackets."""
    clean = pii.redact(docs)
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else clean


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows taken by the source mix: dropped, kept or repeated."""
    return mixing.mix_documents(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text (little-endian unsigned 32-bit integers) and the SHA-256 of their decoding."""
    path = public_tokenizers.path(TOKENIZER)
    tokens = bpe.encode(docs, path, decoded=True)
    return tokens.select("doc_id", bpe.token_count().alias("n_tokens"), "ids", F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


STAGES = [
    ("lexicon_toxicity", drop_toxic),
    ("minhash_near_dedup", near_dedup),
    ("boosted_pii", redact_pii),
    ("mix_sources", mix),
    ("tree_bpe", tokenize),
]

#: Learned scores, hash unions and BPE are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
