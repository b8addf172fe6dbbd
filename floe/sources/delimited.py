"""Delimited files with a declared schema (never inferred)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from floe.schemas import POINTS, SALES


def read_delimited(
    spark: SparkSession, path: str | list[str], schema: str, sep: str = ",", mode: str = "FAILFAST"
) -> DataFrame:
    """CSV without header; ``mode`` FAILFAST (a bad row fails the job),
    PERMISSIVE or DROPMALFORMED."""
    return spark.read.schema(schema).option("sep", sep).option("header", "false").option(
        "mode", mode
    ).csv(path)


def read_points(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Space-separated ``x y`` regression points."""
    return read_delimited(spark, path, POINTS, sep=" ")


def read_sales(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Comma-separated sales rows ``date,month,category,product,profit``."""
    return read_delimited(spark, path, SALES)
