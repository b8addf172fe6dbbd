"""Keyed sum/count/average of a money column (per month)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"
MONEY_SUM = "decimal(38,2)"


def keyed_profit(
    df: DataFrame, key: Column, amount: Column, carry: Column, carry_order: Column
) -> DataFrame:
    """``key, profit, n, carried, avg_profit`` per key.

    Money is summed as DECIMAL so the total is exact and order-independent.
    The carried attribute (a struct for several) comes from the row with the
    smallest ``carry_order``.  ``min_by`` over a string buffer would force a sort of
    every input row (SortAggregate), so the carried value is made a grouping
    key of a first, hash-aggregated pass -- (key, carry) -> sum, count,
    min(order) -- and the second pass over those few rows picks the carry.
    """
    first = df.groupBy(key.alias("key"), carry.alias("carried")).agg(
        F.sum(amount.cast(MONEY)).alias("_p"),
        F.count(F.lit(1)).alias("_n"),
        F.min(carry_order).alias("_o"),
    )
    agg = first.groupBy("key").agg(
        F.sum("_p").cast(MONEY_SUM).alias("profit"),
        F.sum("_n").alias("n"),
        F.min_by("carried", "_o").alias("carried"),
    )
    return agg.select(
        "key",
        "profit",
        "n",
        "carried",
        (F.col("profit").cast("double") / F.col("n")).alias("avg_profit"),
    )
