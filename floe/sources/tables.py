"""Parquet tables of the test-data layout (``<dir>/<name>.parquet``).

Readers always project to the columns an operator needs, so the scan's
``ReadSchema`` stays narrow; filters applied afterwards are pushed into the
parquet scan by Catalyst (through the optional spread as well).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def spread(df: DataFrame) -> DataFrame:
    """Round-robin the rows over the session's cores when the scan has fewer
    splits than that (a file with one row group is one task).

    For CPU-heavy per-row work (tokenising, JSON, regex parsing) this turns
    one busy task into many; on a large input the scan already has more
    splits than cores and nothing is added to the plan.
    """
    try:
        parallelism = df.sparkSession.sparkContext.defaultParallelism
        splits = df.rdd.getNumPartitions()
    except (AttributeError, NotImplementedError):  # no RDD view of the plan (a remote session): leave it as is
        return df
    return df.repartition(parallelism) if splits < parallelism else df


def read_table(
    spark: SparkSession,
    sf_dir: str,
    name: str,
    columns: list[str] | None = None,
    spread_rows: bool = False,
) -> DataFrame:
    df = spark.read.parquet(table_path(sf_dir, name))
    df = df.select(*columns) if columns else df
    return spread(df) if spread_rows else df
