"""Streaming forms of the window-over-window operators.

Input: a streaming frame with event time and a watermark.  The window
aggregate runs in Spark's state store (append mode: a window is emitted once,
when the watermark passes its end).  What follows runs on each micro-batch of closed
windows by the batch operators: ranks need nothing more, and changes against
a key's previous window or row carry the last row of every key along
(``floe.streaming.carry``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from floe.operators.aggregates import Mergeable, count_rows
from floe.operators.change import exceeds_threshold, pct_change, window_price_stats, with_previous_window
from floe.operators.sequence import time_bucket
from floe.operators.signals import orders_from_jumps
from floe.operators.topn import top_items
from floe.operators.windows import windowed
from floe.streaming.carry import last_rows_schema, ordered_rows, previous_rows, run_carried, with_last_rows
from floe.streaming.runner import run_batches

_STATS_COLS = ["window_start", "window_end", "first_ts", "last_ts", "min_price", "max_price", "max_ts"]


def stream_window_change(
    spark: SparkSession,
    stream: DataFrame,
    name: str,
    key: str,
    ts_col: str,
    price_col: str,
    size: str,
    slide: str | None = None,
    id_col: str | None = None,
    threshold: float | None = None,
    location: str | None = None,
) -> DataFrame:
    """Runs ``stream`` to its end; per key and window: stats, previous window's
    max and % change, or, with ``threshold``, only the large-change alerts (the
    previous window advances regardless).

    A micro-batch's windows are compared by the batch operator, together with
    the last window each key had before; a key's windows spread over tasks.
    ``location`` resumes an earlier run.
    """
    stats = window_price_stats(
        stream, key, ts_col, price_col, size, slide=slide, id_col=id_col, strategy="direct"
    ).select(key, *_STATS_COLS)
    order, value = ["window_start"], "max_price"

    def compared(both: DataFrame) -> DataFrame:
        seen = with_previous_window(both, [key], value, slide=slide or size)
        cur, prev = F.col(value), F.col("prev_max")
        seen = seen.withColumn("pct_change", pct_change(cur, prev))
        return seen if threshold is None else seen.where(exceeds_threshold(cur, prev, threshold))

    table = last_rows_schema(stats, key, order, [value])
    sink = run_carried(spark, stats, name, table, with_last_rows(key, order, [value], compared), location=location)
    return spark.read.parquet(sink).drop("batch")


def stream_price_jumps(
    spark: SparkSession,
    stream: DataFrame,
    name: str,
    key: str,
    ts_col: str,
    id_col: str,
    price_col: str,
    threshold: float = 3.0,
    bucket: str = "1 hour",
    location: str | None = None,
) -> DataFrame:
    """Runs ``stream`` to its end; the orders of ``price_jumps`` over its rows in event-time order.

    Rows out of order within the watermark's delay wait in the state store
    (``ordered_rows``); what the watermark releases is compared by the batch
    operator with the last row its key had before.  ``location`` resumes an earlier run.
    """
    order, carry = [ts_col, id_col], [price_col]
    rows = ordered_rows(stream.select(key, ts_col, id_col, price_col), ts_col)
    look_back = previous_rows([key], order, carry, lambda both: time_bucket(both, ts_col, bucket))
    step = with_last_rows(key, order, carry, look_back)

    def jumps(batch: DataFrame, last: DataFrame) -> tuple[DataFrame, DataFrame]:
        out, then = step(batch, last)
        return orders_from_jumps(out, key, id_col, price_col, threshold), then

    sink = run_carried(spark, rows, name, last_rows_schema(rows, key, order, carry), jumps, location=location)
    return spark.read.parquet(sink).drop("batch")


def stream_item_counts(stream: DataFrame, ts_col: str, item_col: str, size: str, slide: str | None = None) -> DataFrame:
    """``window_end, item_id, view_count``: counts per item of every closed window."""
    counts = windowed(
        stream, ts_col, size, [count_rows("view_count")], slide=slide, keys=[item_col], strategy="direct"
    )
    return counts.select("window_end", F.col(item_col).cast("bigint").alias("item_id"), "view_count")


def stream_top_items(
    spark: SparkSession, stream: DataFrame, name: str, ts_col: str, item_col: str, size: str, slide: str | None, n: int
) -> DataFrame:
    """Runs ``stream`` to its end; top ``n`` items per window (count
    descending, ties by item id), read back from the sink.

    In append mode all counts of a window arrive in the micro-batch where the
    watermark passes its end, so each batch is ranked by the batch operator:
    a partial limit per task before the exchange, no Python and no state
    beyond the counts, however many items a window has.
    """
    counts = stream_item_counts(stream, ts_col, item_col, size, slide)
    sink = run_batches(spark, counts, name, output_mode="append", transform=lambda batch: top_items(batch, n))
    return spark.read.parquet(sink).drop("batch")


def chained_top_items(
    stream: DataFrame, ts_col: str, item_col: str, size: str, slide: str | None, n: int, slices: int = 64
) -> DataFrame:
    """``window_end, item_id, view_count, rank`` as one streaming plan in append mode: no ``foreachBatch``.

    Three stateful steps on the same window: counts per item, the best ``n`` of each
    of ``slices`` parts of the items, the best ``n`` of those.  A part's list
    holds the items of a window by ``slices``, so choose them by the widest window.
    """
    counts = windowed_counts(stream, ts_col, item_col, size, slide)
    best = F.array_sort(F.collect_list(F.struct((-F.col("view_count")).alias("minus"), F.col("item_id"))))
    part = F.pmod(F.xxhash64("item_id"), F.lit(slices)).alias("part")
    parts = counts.groupBy("window", part).agg(F.slice(best, 1, n).alias("best"))
    # At most n of each part.
    whole = F.array_sort(F.flatten(F.collect_list("best")))
    tops = parts.groupBy("window").agg(F.slice(whole, 1, n).alias("best"))
    rows = tops.select(F.col("window.end").alias("window_end"), F.posexplode("best").alias("rank", "b"))
    return rows.select("window_end", "b.item_id", (-F.col("b.minus")).alias("view_count"), "rank")


def windowed_counts(stream: DataFrame, ts_col: str, item_col: str, size: str, slide: str | None) -> DataFrame:
    """``window, item_id, view_count`` with the window column itself, which carries the watermark to the next step."""
    win = F.window(ts_col, size, slide) if slide else F.window(ts_col, size)
    counts = stream.groupBy(win.alias("window"), F.col(item_col).cast("bigint").alias("item_id"))
    return counts.agg(F.count(F.lit(1)).alias("view_count"))


def arrival_windows(stream: DataFrame, size: str, keys: list[str], aggs: list[Mergeable]) -> DataFrame:
    """Processing-time windows, each emitted once: windows on the arrival time, with a watermark on it.

    All rows of a micro-batch share one arrival time.  The watermark is a
    second late, so that a clock set back by less drops nothing.  The last window stays open until
    something arrives after its end.
    """
    arrived = stream.withColumn("arrived", F.current_timestamp()).withWatermark("arrived", "1 second")
    return windowed(arrived, "arrived", size, aggs, keys=keys, strategy="direct")
