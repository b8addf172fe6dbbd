"""Integer sequences (both ends inclusive)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def integer_sequence(spark: SparkSession, start: int, end: int, partitions: int | None = None) -> DataFrame:
    """``id BIGINT`` from ``start`` to ``end`` inclusive, generated in
    parallel (no data is read or shipped)."""
    return spark.range(start, end + 1, 1, partitions)
