"""Per-item counts per window and the top-N items of each window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from floe.operators.aggregates import count_rows
from floe.operators.windows import windowed


def item_window_counts(
    df: DataFrame,
    ts_col: str,
    item_col: str,
    size: str,
    slide: str | None = None,
    strategy: str = "auto",
) -> DataFrame:
    """``window_end, item_id, view_count``: one row per item and window."""
    counts = windowed(
        df, ts_col, size, [count_rows("view_count")], slide=slide, keys=[item_col], strategy=strategy
    )
    return counts.select("window_end", F.col(item_col).alias("item_id"), "view_count")


def top_n(
    df: DataFrame,
    group_cols: Sequence[str],
    order: Sequence[Column],
    n: int,
    rank_col: str = "rank",
) -> DataFrame:
    """Top ``n`` rows per group with a 0-based rank.

    The filter on ``row_number() <= n`` lets Catalyst insert a partial
    WindowGroupLimit below the exchange: each map task forwards at most ``n``
    rows per group, so a group with millions of candidates (a hot window)
    never reaches one task whole.
    """
    w = Window.partitionBy(*group_cols).orderBy(*order)
    return (
        df.withColumn("_rn", F.row_number().over(w))
        .where(F.col("_rn") <= n)
        .withColumn(rank_col, (F.col("_rn") - 1).cast("int"))
        .drop("_rn")
    )


def top_items(counts: DataFrame, n: int = 3) -> DataFrame:
    """Top ``n`` items of every window by count descending; ties by item id."""
    return top_n(counts, ["window_end"], [F.desc("view_count"), F.asc("item_id")], n)
