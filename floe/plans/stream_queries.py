"""Streaming twins of the batch window queries.

Each query replays ``events`` (or ``orders``) as an ordered file stream, runs
the streaming plan to the end of the input with a checkpointed parquet sink
and returns the sink as a batch frame -- comparable with the batch twin's
oracle SQL.
"""

from __future__ import annotations

import datetime as dt
import time

from pyspark.sql import functions as F

from floe.functions.parse import parse_numbers
from floe.functions.time import instant_to_ntz, ntz_to_instant
from floe.operators.aggregates import count_rows, sum_of
from floe.operators.windows import windowed
from floe.plans import window_queries as W
from floe.plans.registry import REGISTRY, query
from floe.plans.standins import FILES_PER_BATCH, arrivals, replay_files
from floe.session import scratch_path
from floe.sources.tables import read_table
from floe.streaming.event_time import guarded_filter, with_event_time
from floe.streaming.operators import arrival_windows, chained_top_items, stream_item_counts, stream_price_jumps, stream_top_items, stream_window_change
from floe.streaming.carry import last_totals, run_carried, running_totals
from floe.streaming.runner import run_available, run_batches, run_to_frame
from floe.streaming.sinks import run_text_stream, tuple_text

REPLAY_CHUNKS = None  # scale with the table (see floe.plans.standins)
FAR_FUTURE = dt.datetime(2200, 1, 1)
PROC_WINDOW = "5 seconds"


def _replayed(spark, df, sentinel):
    src = replay_files(spark, df, "ts", REPLAY_CHUNKS, sentinel)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", FILES_PER_BATCH).parquet(src)


def _ntz(*cols):
    return [instant_to_ntz(F.col(c)).alias(c) for c in cols]


@query("stream_track_change", oracle=REGISTRY["track_change"].oracle)
def q_stream_track_change(spark, sf_dir):
    ev = W.events(spark, sf_dir, "user_id", "ts", "value", "event_id")
    sentinel = {"user_id": -1, "ts": FAR_FUTURE, "value": 0.0, "event_id": -1}
    timed = with_event_time(_replayed(spark, ev, sentinel), "ts")
    out = stream_window_change(spark, timed, "track_change", "user_id", "ts", "value", W.TRACK_SIZE, id_col="event_id")
    return out.where(F.col("user_id") != -1).select(
        "user_id",
        *_ntz("window_start", "window_end", "first_ts", "last_ts"),
        "min_price",
        "max_price",
        "pct_change",
    )


def _stream_alerts(spark, sf_dir, name, size, slide):
    ev = W.events(spark, sf_dir, "event_type", "ts", "value", "event_id")
    sentinel = {"event_type": "__end__", "ts": FAR_FUTURE, "value": 0.0, "event_id": -1}
    timed = with_event_time(_replayed(spark, ev, sentinel), "ts")
    out = stream_window_change(
        spark, timed, name, "event_type", "ts", "value", size, slide=slide, id_col="event_id", threshold=W.DELTA_THRESHOLD
    )
    return out.select(
        "event_type", *_ntz("window_start"), "max_price", *_ntz("max_ts"), "prev_max", "pct_change"
    )


@query("stream_large_delta", oracle=REGISTRY["large_delta"].oracle)
def q_stream_large_delta(spark, sf_dir):
    return _stream_alerts(spark, sf_dir, "large_delta", *W.DELTA_WINDOW)


@query("stream_large_delta_tumbling", oracle=REGISTRY["large_delta_tumbling"].oracle)
def q_stream_large_delta_tumbling(spark, sf_dir):
    return _stream_alerts(spark, sf_dir, "large_delta_tumbling", W.DELTA_TUMBLE, None)


def _guarded_views(spark, sf_dir):
    ev = W.events(spark, sf_dir, "ts", "event_type", "props")
    sentinel = {"ts": FAR_FUTURE, "event_type": "__end__", "props": "{}"}
    timed = with_event_time(_replayed(spark, ev, sentinel), "ts")
    return guarded_filter(timed, F.col("event_type") == W.VIEW, "ts")


@query("stream_topn", oracle=REGISTRY["topn_items"].oracle)
def q_stream_topn(spark, sf_dir):
    views = _guarded_views(spark, sf_dir).select("ts", W.item_of(F.col("props")).alias("item_id"))
    size, slide = W.ITEM_WINDOW
    out = stream_top_items(spark, views, "topn", "ts", "item_id", size, slide, W.TOP_N)
    return out.select(*_ntz("window_end"), "item_id", "view_count", "rank")


@query("stream_item_window_count", oracle=REGISTRY["item_window_count"].oracle)
def q_stream_item_window_count(spark, sf_dir):
    views = _guarded_views(spark, sf_dir).select("ts", W.item_of(F.col("props")).alias("item_id"))
    out = run_to_frame(spark, stream_item_counts(views, "ts", "item_id", *W.ITEM_WINDOW), "item_counts")
    return out.select(*_ntz("window_end"), "item_id", "view_count")


@query("stream_guarded_filter", oracle=REGISTRY["sliding_count"].oracle)
def q_stream_guarded_filter(spark, sf_dir):
    views = _guarded_views(spark, sf_dir)
    size, slide = W.SLIDING_COUNT
    counts = windowed(views, "ts", size, [count_rows("view_count")], slide=slide, strategy="direct")
    out = run_to_frame(spark, counts, "guarded_filter")
    return out.select(*_ntz("window_start", "window_end"), "view_count")


@query(
    "stream_proc_time",
    oracle="""
    SELECT monthname(o_orderdate) AS month, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS profit,
           CAST(count(*) AS BIGINT) AS n
    FROM orders GROUP BY 1
    """,
)
def q_stream_proc_time(spark, sf_dir):
    """Per-month profit in 5 s processing-time windows over replayed orders.

    Update mode emits a window's running totals in every batch; the last batch
    holds its final ones.  Wall-clock windows differ between runs, but their
    sums per month do not.  The watermark on the arrival time lets closed
    windows leave the state."""
    orders = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_totalprice", "o_orderdate"])
    replay_src = orders.withColumnRenamed("o_orderdate", "ts")
    sentinel = {"o_orderkey": -1, "o_totalprice": 0.0, "ts": FAR_FUTURE}
    stream = _replayed(spark, replay_src, sentinel).where(F.col("o_orderkey") >= 0)
    arrived = stream.withColumn("arrived", F.current_timestamp()).withWatermark("arrived", "0 seconds")
    per_window = arrived.groupBy(
        F.window("arrived", PROC_WINDOW).alias("w"),
        F.date_format("ts", "MMMM").alias("month"),
    ).agg(
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("decimal(38,2)").alias("profit"),
        F.count(F.lit(1)).alias("n"),
    )
    sink = run_batches(spark, per_window, "proc_time", output_mode="update")
    updates = spark.read.parquet(sink)
    final = updates.groupBy("w", "month").agg(F.max_by(F.struct("profit", "n"), "batch").alias("t"))
    return final.groupBy("month").agg(
        F.sum("t.profit").cast("decimal(38,2)").alias("profit"), F.sum("t.n").cast("bigint").alias("n")
    )


@query("stream_sliding_sum", oracle=REGISTRY["sliding_sum"].oracle)
def q_stream_sliding_sum(spark, sf_dir):
    ev = W.events(spark, sf_dir, "ts", "props")
    sentinel = {"ts": FAR_FUTURE, "props": '{"k": 0}'}
    timed = with_event_time(_replayed(spark, ev, sentinel), "ts")
    nums = timed.select("ts", F.get_json_object("props", "$.k").cast("int").alias("k"))
    size, slide = W.SLIDING_SUM
    sums = windowed(nums, "ts", size, [sum_of(F.col("k").cast("bigint"), "total")], slide=slide)
    out = run_to_frame(spark, sums, "sliding_sum")
    return out.select(*_ntz("window_start", "window_end"), "total")


# ---- rows that arrive late ---------------------------------------------------
# Rows arrive in batches of five days of event time; every seventh event two batches late.

_LATE_BATCHES = 9
_LATE_BATCH_SQL = "(day(ts) - 1) // 5 + CASE WHEN event_id % 7 = 3 THEN 2 ELSE 0 END"
_LATE_WINDOW = "6 hours"


def _late_arrivals(spark, sf_dir):
    ev = W.events(spark, sf_dir, "event_id", "ts", "value")
    batch = F.floor((F.dayofmonth("ts") - 1) / 5) + F.when(F.col("event_id") % 7 == 3, 2).otherwise(0)
    sentinel = {"event_id": -1, "ts": FAR_FUTURE, "value": 0.0}
    return with_event_time(arrivals(spark, ev, batch, _LATE_BATCHES, sentinel), "ts")


#: Rows with the latest time of the batches that a row's batch is judged by: all but the one right before it.
_LATE_SQL = f"""
    WITH arrived AS (
      SELECT event_id, value, ts, {_LATE_BATCH_SQL} AS batch, time_bucket(INTERVAL '{_LATE_WINDOW}', ts, TIMESTAMP '1970-01-01') AS window_start
      FROM events),
    batches AS (SELECT batch, CAST(count(*) AS BIGINT) AS n_rows, max(ts) AS latest FROM arrived GROUP BY batch),
    reached AS (
      SELECT batch, n_rows, lag(upto) OVER (ORDER BY batch) AS judged_by, date_trunc('millisecond', upto_before) AS watermark
      FROM (SELECT *, max(latest) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS upto_before,
                   max(latest) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS upto FROM batches)),
    judged AS (
      SELECT a.*, r.judged_by IS NOT NULL AND window_start + INTERVAL '{_LATE_WINDOW}' <= date_trunc('millisecond', r.judged_by) AS late
      FROM arrived a JOIN reached r USING (batch))
"""


def _late_counts(spark, sf_dir):
    n_late = [count_rows("n"), sum_of(F.col("event_id"), "ids")]
    return windowed(_late_arrivals(spark, sf_dir), "ts", _LATE_WINDOW, n_late)


@query("stream_late_rows", oracle=_LATE_SQL + "SELECT window_start, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids FROM judged WHERE NOT late GROUP BY 1")
def q_stream_late_rows(spark, sf_dir):
    """Windows over rows of which some come far behind the watermark.

    A row is dropped if its window had ended by the watermark that the batch before it went by.
    """
    out = run_to_frame(spark, _late_counts(spark, sf_dir), "late_rows")
    return out.select(*_ntz("window_start"), "n", "ids")


@query(
    "stream_late_progress",
    oracle=_LATE_SQL
    + """SELECT row_number() OVER (ORDER BY batch) - 1 AS batch, n_rows, watermark, coalesce(bool_or(late), false) AS dropped
    FROM reached JOIN judged USING (batch) GROUP BY batch, n_rows, watermark""",
)
def q_stream_late_progress(spark, sf_dir):
    """The stream's own reports: per micro-batch its rows, its watermark and whether late rows were dropped."""
    reports: list = []
    run_available(spark, _late_counts(spark, sf_dir), "late_progress", progress=reports)
    rows = [
        (p["batchId"], p["numInputRows"], p["eventTime"]["watermark"], any(o["numRowsDroppedByWatermark"] for o in p["stateOperators"]))
        for p in reports
    ]
    frame = spark.createDataFrame(rows, "batch bigint, n_rows bigint, reached string, dropped boolean")
    # The sentinel's batch and the empty one that closes the last window are not the events'.
    events = frame.where("n_rows > 0").where(F.col("batch") < F.lit(max(b for b, n, *_ in rows if n)))
    watermark = instant_to_ntz(F.to_timestamp("reached"))
    return events.select("batch", "n_rows", F.when(F.col("batch") > 0, watermark).alias("watermark"), "dropped")


# ---- text in, text out -----------------------------------------------------------


@query("stream_text_sums", oracle=REGISTRY["sliding_sum"].oracle)
def q_stream_text_sums(spark, sf_dir):
    """Number lines as a text stream, parsed, summed over sliding windows, written as tuple lines and read back by the sink's log."""
    ev = W.events(spark, sf_dir, "ts", "props")
    millis = F.unix_millis(ntz_to_instant(F.col("ts"))).cast("string")
    day = F.floor((F.dayofmonth("ts") - 1) / 5)
    lines = ev.select(F.concat_ws(",", millis, F.get_json_object("props", "$.k")).alias("value"), day.alias("day"))
    stream = _line_stream(spark, lines)
    numbers = with_event_time(stream.select(*parse_numbers(F.col("value"))), "ts", from_ntz=False)
    size, slide = W.SLIDING_SUM
    sums = windowed(numbers, "ts", size, [sum_of(F.col("number").cast("bigint"), "total")], slide=slide)
    sums = sums.select(F.unix_millis("window_start").alias("a"), F.unix_millis("window_end").alias("b"), "total")
    text = run_text_stream(spark, sums, tuple_text("a", "b", "total"), "text_sums")
    fields = F.split(F.regexp_replace("value", "[()]", ""), ",")
    times = [instant_to_ntz(F.timestamp_millis(fields[i].cast("bigint"))).alias(n) for i, n in enumerate(("window_start", "window_end"))]
    return text.select(*times, F.nullif(fields[2], F.lit("null")).cast("bigint").alias("total"))


def _line_stream(spark, lines):
    """Lines as a text stream, one file per five days and a last line far in the future."""
    last = int(FAR_FUTURE.replace(tzinfo=dt.timezone.utc).timestamp() * 1000)
    return arrivals(spark, lines, F.col("day"), 7, {"value": f"{last},0"}, text=True)


# ---- further twins -----------------------------------------------------------------


@query("stream_price_jump", oracle=REGISTRY["price_jump"].oracle)
def q_stream_price_jump(spark, sf_dir):
    """Price jumps between consecutive rows of a stream in which every tenth row comes a batch after its neighbours."""
    ev = W.events(spark, sf_dir, "user_id", "ts", "event_id", "value")
    batch = F.floor((F.dayofmonth("ts") - 1) / 5) + F.when(F.col("event_id") % 10 == 4, 1).otherwise(0)
    sentinel = {"user_id": -1, "ts": FAR_FUTURE, "event_id": -1, "value": 0.0}
    stream = with_event_time(arrivals(spark, ev, batch, 8, sentinel), "ts", "6 days")
    return stream_price_jumps(spark, stream, "price_jump", "user_id", "ts", "event_id", "value", W.JUMP_THRESHOLD)


@query("stream_topn_chained", oracle=REGISTRY["topn_items"].oracle)
def q_stream_topn_chained(spark, sf_dir):
    """Top items by three chained stateful steps in append mode."""
    views = _guarded_views(spark, sf_dir).select("ts", W.item_of(F.col("props")).alias("item_id"))
    size, slide = W.ITEM_WINDOW
    out = run_to_frame(spark, chained_top_items(views, "ts", "item_id", size, slide, W.TOP_N), "topn_chained")
    return out.select(*_ntz("window_end"), "item_id", "view_count", "rank")


@query(
    "stream_union_counts",
    oracle=f"""
    SELECT time_bucket(INTERVAL '{_LATE_WINDOW}', ts, TIMESTAMP '1970-01-01') AS window_start, event_type, count(*) AS n
    FROM events WHERE event_type IN ('view', 'click') GROUP BY ALL
    """,
)
def q_stream_union_counts(spark, sf_dir):
    """Counts over the union of two streams of which one lags: its batches hold two days, the other's five."""
    ev = W.events(spark, sf_dir, "ts", "event_type")

    def one(kind: str, days: int, batches: int):
        sentinel = {"ts": FAR_FUTURE, "event_type": "__end__"}
        batch = F.floor((F.dayofmonth("ts") - 1) / days)
        return with_event_time(arrivals(spark, ev.where(F.col("event_type") == kind), batch, batches, sentinel), "ts")

    both = one("view", 5, 7).union(one("click", 2, 16))
    counts = windowed(both, "ts", _LATE_WINDOW, [count_rows("n")], keys=["event_type"])
    return run_to_frame(spark, counts, "union_counts").select(*_ntz("window_start"), "event_type", "n")


@query("stream_ttl_totals", oracle=REGISTRY["stream_proc_time"].oracle)
def q_stream_ttl_totals(spark, sf_dir):
    """Running profit per month of a stream without a watermark; a month untouched for a day would leave the carried table."""
    orders = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_totalprice", "o_orderdate"])
    stream = arrivals(spark, orders, F.pmod("o_orderkey", F.lit(6)), 6)
    profit = F.col("o_totalprice").cast("decimal(18,2)").cast("decimal(38,2)")
    sales = stream.select(F.date_format("o_orderdate", "MMMM").alias("month"), profit.alias("profit"), F.lit(1).cast("bigint").alias("n"))
    keys, sums = ["month"], ["profit", "n"]
    schema, step = running_totals(keys, sums, "1 DAY")
    sink = run_carried(spark, sales, "ttl_totals", schema(sales), step)
    return last_totals(spark.read.parquet(sink), keys, sums)


@query("stream_proc_time_once", oracle=REGISTRY["stream_proc_time"].oracle)
def q_stream_proc_time_once(spark, sf_dir):
    """Per-month profit in one-second arrival windows, each written once when it has passed.

    The last window is flushed by one more row that arrives after its end.
    """
    orders = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_totalprice", "o_orderdate"])
    source, base = scratch_path(spark, "orders-source"), scratch_path(spark, "stream-once")
    orders.repartitionById(4, F.pmod("o_orderkey", F.lit(4)).cast("int")).write.parquet(source)

    def run():
        stream = spark.readStream.schema(orders.schema).option("maxFilesPerTrigger", 1).parquet(source)
        sales = stream.select("o_orderkey", F.date_format("o_orderdate", "MMMM").alias("month"), F.col("o_totalprice").cast("decimal(18,2)").alias("profit"))
        totals = arrival_windows(sales, "1 second", ["month"], [sum_of(F.col("profit"), "profit"), count_rows("n")])
        return run_available(spark, totals, "proc_time_once", location=base)

    run()
    time.sleep(1.1)
    flush = spark.createDataFrame([(-1, 0.0, None)], orders.schema)
    flush.coalesce(1).write.mode("append").parquet(source)
    once = spark.read.parquet(run())
    twice = once.groupBy("window_start", "month").count().where("count > 1").select(F.raise_error(F.lit("a window was written twice")).alias("month"))
    whole = once.where("month IS NOT NULL").select("month", "profit", "n")
    checked = whole.unionByName(twice.select(F.col("month").cast("string").alias("month"), F.lit(0).alias("profit"), F.lit(0).alias("n")))
    return checked.groupBy("month").agg(F.sum("profit").cast("decimal(38,2)").alias("profit"), F.sum("n").cast("bigint").alias("n"))
