"""Change of a window statistic against the previous non-empty window of the
same key, and the large-change alert built on it (batch forms).

The streaming forms run the same operators on each micro-batch and carry the
last window of every key along (``floe.streaming.carry``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from floe.functions.durations import to_micros
from floe.functions.time import ntz_micros
from floe.operators.aggregates import Mergeable, count_rows, max_of, min_of, min_struct
from floe.operators.sequence import with_previous_row
from floe.operators.windows import windowed


def pct_change(current: Column, previous: Column) -> Column:
    """``(cur - prev) / prev * 100``; 0.0 for the first window or prev = 0."""
    return (
        F.when(previous.isNull() | (previous == 0), F.lit(0.0))
        .otherwise((current - previous) / previous * 100)
    )


def exceeds_threshold(current: Column, previous: Column, threshold: float) -> Column:
    """Strict ``abs((cur - prev) / prev) * 100 > threshold`` with prev != 0."""
    return (
        previous.isNotNull()
        & (previous != 0)
        & (F.abs((current - previous) / previous) * 100 > F.lit(float(threshold)))
    )


# Windows per (key, bucket) in the previous-window lookup.
WINDOWS_PER_BUCKET = 1024


def with_previous_window(
    windows: DataFrame,
    keys: Sequence[str],
    value_col: str,
    prev_col: str = "prev_max",
    slide: str | None = None,
    windows_per_bucket: int = WINDOWS_PER_BUCKET,
) -> DataFrame:
    """Adds the previous non-empty window's ``value_col`` per key.

    A key has one row per window -- few for many keys, but a single
    instrument over years has millions (5 min / 15 s windows: 2.1M per year).
    The lag therefore runs per (key, run of ``windows_per_bucket`` window
    starts); the first window of each run takes the last window of the key's
    previous non-empty run (``with_previous_row``).  ``slide`` is the distance
    between window starts (the size for tumbling windows).  The form is the
    same at every size, and null keys are a key of their own.
    """
    start, end = F.col("window_start"), F.col("window_end")
    is_ntz = isinstance(windows.schema["window_start"].dataType, T.TimestampNTZType)
    start_us = ntz_micros(start) if is_ntz else F.unix_micros(start)
    if slide is not None:
        step = F.lit(float(to_micros(slide)))
    else:
        step = ((ntz_micros(end) if is_ntz else F.unix_micros(end)) - start_us).cast("double")
    bucket = F.floor(start_us / (step * F.lit(float(windows_per_bucket))))
    out = with_previous_row(windows, list(keys), ["window_start"], [value_col], bucket, prefix="_prev_")
    return out.withColumnRenamed("_prev_" + value_col, prev_col)


def window_price_stats(
    ticks: DataFrame,
    key: str,
    ts_col: str,
    price_col: str,
    size: str,
    slide: str | None = None,
    id_col: str | None = None,
    strategy: str = "auto",
) -> DataFrame:
    """Per key and window: first/last time, min, max (floored at 0.0, as the
    running maximum starts from 0.0) and the time of the first row reaching
    the maximum (NULL when no price exceeds 0)."""
    price = F.col(price_col)
    ts = F.col(ts_col)
    tie = [F.col(id_col)] if id_col else []
    aggs: list[Mergeable] = [
        min_of(ts, "first_ts"),
        max_of(ts, "last_ts"),
        min_of(price, "min_price"),
        max_of(price, "_raw_max"),
        min_struct("_argmax", -price, ts, *tie),
        count_rows("n_rows"),
    ]
    out = windowed(ticks, ts_col, size, aggs, slide=slide, keys=[key], strategy=strategy)
    max_price = F.greatest(F.lit(0.0), F.col("_raw_max"))
    return out.select(
        key,
        "window_start",
        "window_end",
        "first_ts",
        "last_ts",
        "min_price",
        max_price.alias("max_price"),
        F.when(F.col("_raw_max") > 0, F.col("_argmax").getField("_1")).alias("max_ts"),
        "n_rows",
    )


def track_change(
    ticks: DataFrame,
    key: str,
    ts_col: str,
    price_col: str,
    size: str,
    id_col: str | None = None,
) -> DataFrame:
    """Tumbling window report: first/last time, min, max and % change of the
    max against the previous window of the same key."""
    stats = window_price_stats(ticks, key, ts_col, price_col, size, id_col=id_col)
    return with_previous_window(stats, [key], "max_price", slide=size).select(
        key,
        "window_start",
        "window_end",
        "first_ts",
        "last_ts",
        "min_price",
        "max_price",
        pct_change(F.col("max_price"), F.col("prev_max")).alias("pct_change"),
    )


def large_delta(
    ticks: DataFrame,
    key: str,
    ts_col: str,
    price_col: str,
    size: str,
    slide: str | None,
    threshold: float,
    id_col: str | None = None,
    strategy: str = "auto",
) -> DataFrame:
    """Alerts where the window max moved more than ``threshold`` percent
    against the previous window of the key (previous is updated by every
    window, alerting or not)."""
    stats = window_price_stats(
        ticks, key, ts_col, price_col, size, slide=slide, id_col=id_col, strategy=strategy
    )
    cur, prev = F.col("max_price"), F.col("prev_max")
    return (
        with_previous_window(stats, [key], "max_price", slide=slide or size)
        .where(exceeds_threshold(cur, prev, threshold))
        .select(
            key,
            "window_start",
            "max_price",
            "max_ts",
            "prev_max",
            ((cur - prev) / prev * 100).alias("pct_change"),
        )
    )
