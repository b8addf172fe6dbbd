"""Text functions: tokenising lines into words (flat-map one line -> n words)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: the tokenizer lower-cases and splits on runs of non-word
# characters (Java regex, ASCII word class), dropping empty tokens.
WORD_SPLIT_PATTERN = r"\W+"


def words(text: Column) -> Column:
    """Array of tokens of ``text`` (may contain empty strings)."""
    return F.split(F.lower(text), WORD_SPLIT_PATTERN)


def tokenize(df: DataFrame, text_col: str = "value", word_col: str = "word") -> DataFrame:
    """One row per non-empty token; stays inside whole-stage codegen (Generate)."""
    return (
        df.select(F.explode(words(F.col(text_col))).alias(word_col))
        .where(F.length(word_col) > 0)
    )
