"""Counting operators: word count, request counts by host / path."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from floe.functions.text import tokenize
from floe.functions.urls import url_host, url_path


def word_count(lines: DataFrame, text_col: str = "value") -> DataFrame:
    """``word, n``: occurrences of every token over all lines.

    Plan: Generate -> partial HashAggregate -> Exchange(word) -> final
    HashAggregate.  The map-side partial aggregate collapses hot words (``the``)
    to one row per task before the shuffle, so a skewed vocabulary costs
    nothing extra in the exchange.
    """
    return tokenize(lines, text_col).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def uri_count(urls: DataFrame, url_col: str = "url", by: str = "host") -> DataFrame:
    """``host|path, n``: request count per host or per path of a URL column."""
    part = url_host(F.col(url_col)) if by == "host" else url_path(F.col(url_col))
    return urls.select(part.alias(by)).groupBy(by).agg(F.count(F.lit(1)).alias("n"))
