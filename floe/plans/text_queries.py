"""Queries over text tables: word counts, URL counts, URL templates."""

from __future__ import annotations

from pyspark.sql import functions as F

from floe.functions.urls import HOST_PATTERN, PATH_PATTERN
from floe.operators.counts import uri_count, word_count
from floe.plans.registry import query
from floe.sources.tables import read_table
from floe.sources.text import text_columns


@query(
    "word_count",
    headline=True,
    oracle="""
    SELECT word, count(*) AS n
    FROM (SELECT unnest(regexp_split_to_array(lower(text), '\\W+')) AS word FROM documents)
    WHERE length(word) > 0
    GROUP BY word
    """,
)
def q_word_count(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents", ["text"], spread_rows=True)
    return word_count(docs, "text")


@query(
    "union_all_word_count",
    oracle="""
    SELECT word, count(*) AS n
    FROM (SELECT unnest(regexp_split_to_array(lower(t), '\\W+')) AS word
          FROM (SELECT text AS t FROM documents UNION ALL SELECT text AS t FROM benchmark))
    WHERE length(word) > 0
    GROUP BY word
    """,
)
def q_union_all_word_count(spark, sf_dir):
    lines = text_columns(
        (read_table(spark, sf_dir, "documents", ["text"], spread_rows=True), "text"),
        (read_table(spark, sf_dir, "benchmark", ["text"], spread_rows=True), "text"),
    )
    return word_count(lines)


@query(
    "uri_count",
    headline=True,
    oracle=f"""
    SELECT regexp_extract(url, '{HOST_PATTERN}', 1) AS host, count(*) AS n
    FROM pages GROUP BY 1
    """,
)
def q_uri_count(spark, sf_dir):
    return uri_count(read_table(spark, sf_dir, "pages", ["url"]), "url", by="host")


@query(
    "uri_path_count",
    oracle=f"""
    SELECT regexp_extract(url, '{PATH_PATTERN}', 1) AS path, count(*) AS n
    FROM pages GROUP BY 1
    """,
)
def q_uri_path_count(spark, sf_dir):
    return uri_count(read_table(spark, sf_dir, "pages", ["url"]), "url", by="path")
