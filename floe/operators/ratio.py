"""Indicator ratio: ``scale * (rows matching a predicate) / rows``.

The Monte-Carlo circle estimate is the case ``x*x + y*y < 1`` with scale 4.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def indicator(predicate: Column) -> Column:
    return F.when(predicate, F.lit(1)).otherwise(F.lit(0))


def indicator_ratio(df: DataFrame, predicate: Column, scale: float = 1.0) -> DataFrame:
    """One row ``hits, n, ratio`` (a global partial/final aggregate)."""
    return df.agg(
        F.sum(indicator(predicate)).cast("bigint").alias("hits"),
        F.count(F.lit(1)).alias("n"),
    ).select("hits", "n", (F.lit(float(scale)) * F.col("hits") / F.col("n")).alias("ratio"))


def inside_unit_circle(x: Column, y: Column) -> Column:
    return x * x + y * y < 1


def unit_hash(*terms: tuple[Column, int], modulus: int) -> Column:
    """Deterministic point in ``[0, 1)`` from integer columns:
    ``(sum(col * multiplier) mod modulus) / modulus``."""
    acc: Column | None = None
    for col, mult in terms:
        part = col.cast("bigint") * F.lit(mult).cast("bigint")
        acc = part if acc is None else acc + part
    return F.pmod(acc, F.lit(modulus).cast("bigint")) / F.lit(float(modulus))
