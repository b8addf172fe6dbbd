"""Pack rows into ``{"response": [...]}`` envelope documents per key and page.

The page is an explicit expression over the row (for example a line number
divided by the page size), so a hot key becomes many documents and many
groups, and the result is the same at every input size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from floe.functions.json import pack_envelope


def pack_envelopes(df: DataFrame, key: str, fields: Sequence[str], page: Column) -> DataFrame:
    """``key, page, value``: envelope text per key and page; elements are
    sorted by their fields within a page.  Null keys are a key of their own."""
    element = F.struct(*fields)
    grouped = df.groupBy(key, page.alias("page")).agg(F.sort_array(F.collect_list(element)).alias("_items"))
    return grouped.select(key, "page", pack_envelope(F.col("_items")).alias("value"))


def first_pages(packed: DataFrame, key: str) -> DataFrame:
    """The envelope of each key's lowest page (partially aggregated, one document per key and task)."""
    return packed.groupBy(key).agg(F.min("page").alias("page"), F.min_by("value", "page").alias("value"))
