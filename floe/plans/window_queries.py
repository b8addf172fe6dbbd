"""Queries over ``events`` as a timestamped stream stand-in: sliding and
tumbling windows, per-item counts, top-N, previous-window change, alerts and
price-jump signals.

``events`` rows are minutes apart, so window sizes are scaled to the data;
the operators take sizes as parameters (the literal sizes of the original
jobs are unit-tested).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from floe.functions.durations import to_micros
from floe.functions.parse import parse_delimited
from floe.functions.render import render_alert, render_change_report
from floe.functions.time import from_epoch_seconds, instant_to_ntz, ntz_seconds, ntz_to_instant
from floe.operators.aggregates import count_rows, sum_of
from floe.operators.change import large_delta, track_change
from floe.operators.signals import price_jumps
from floe.operators.topn import item_window_counts, top_items
from floe.operators.windows import windowed
from floe.plans.registry import REGISTRY, query
from floe.schemas import CLICKS
from floe.sources.tables import read_table

VIEW = "view"


def events(spark, sf_dir, *cols):
    return read_table(spark, sf_dir, "events", list(cols))


def item_of(props):
    return F.get_json_object(props, "$.k").cast("bigint")


# ---- DuckDB helpers: epoch-aligned window starts over micros --------------


def _tumble(size: str, ts: str = "ts") -> str:
    s = to_micros(size)
    return f"(epoch_us({ts}) // {s}) * {s}"


def _slide_sql(source: str, cols: str, size: str, slide: str, ts: str = "ts") -> str:
    """Rows of ``source`` repeated once per sliding window they fall in, with
    ``ws`` (window start, micros)."""
    s, d = to_micros(size), to_micros(slide)
    k = s // d
    return (
        f"(SELECT {cols}, (epoch_us({ts}) // {d}) * {d} - i * {d} AS ws "
        f"FROM (SELECT {cols}, unnest(range({k})) AS i FROM {source}))"
    )


SLIDING_COUNT = ("5 seconds", "1 second")
SLIDING_SUM = ("4 hours", "2 hours")
ITEM_WINDOW = ("6 hours", "1 hour")
TRACK_SIZE = "1 day"
DELTA_WINDOW = ("2 hours", "30 minutes")
DELTA_TUMBLE = "1 day"
DELTA_THRESHOLD = 5.0
JUMP_THRESHOLD = 3.0
TOP_N = 3


@query(
    "sliding_count",
    headline=True,
    oracle=f"""
    SELECT make_timestamp(ws) AS window_start,
           make_timestamp(ws + {to_micros(SLIDING_COUNT[0])}) AS window_end,
           count(*) AS view_count
    FROM {_slide_sql("(SELECT ts FROM events WHERE event_type = 'view')", "ts", *SLIDING_COUNT)}
    GROUP BY ws
    """,
)
def q_sliding_count(spark, sf_dir):
    views = events(spark, sf_dir, "ts", "event_type").where(F.col("event_type") == VIEW)
    size, slide = SLIDING_COUNT
    return windowed(views, "ts", size, [count_rows("view_count")], slide=slide)


@query(
    "sliding_sum",
    oracle=f"""
    SELECT make_timestamp(ws) AS window_start,
           make_timestamp(ws + {to_micros(SLIDING_SUM[0])}) AS window_end,
           CAST(sum(k) AS BIGINT) AS total
    FROM {_slide_sql("(SELECT ts, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)", "ts, k", *SLIDING_SUM)}
    GROUP BY ws
    """,
)
def q_sliding_sum(spark, sf_dir):
    nums = events(spark, sf_dir, "ts", "props").select(
        "ts", F.get_json_object("props", "$.k").cast("int").alias("k")
    )
    size, slide = SLIDING_SUM
    return windowed(nums, "ts", size, [sum_of(F.col("k").cast("bigint"), "total")], slide=slide)


_ITEM_COUNTS_SQL = f"""
    SELECT make_timestamp(ws + {to_micros(ITEM_WINDOW[0])}) AS window_end, item_id,
           count(*) AS view_count
    FROM {_slide_sql("(SELECT ts, CAST(json_extract_string(props, '$.k') AS BIGINT) AS item_id FROM events WHERE event_type = 'view')", "ts, item_id", *ITEM_WINDOW)}
    GROUP BY ws, item_id
"""


def _item_counts(spark, sf_dir):
    views = (
        events(spark, sf_dir, "ts", "event_type", "props")
        .where(F.col("event_type") == VIEW)
        .select("ts", item_of(F.col("props")).alias("item"))
    )
    size, slide = ITEM_WINDOW
    return item_window_counts(views, "ts", "item", size, slide)


@query("item_window_count", oracle=_ITEM_COUNTS_SQL)
def q_item_window_count(spark, sf_dir):
    return _item_counts(spark, sf_dir)


@query(
    "item_tumbling_count",
    oracle=f"""
    SELECT make_timestamp({_tumble(ITEM_WINDOW[0])} + {to_micros(ITEM_WINDOW[0])}) AS window_end,
           CAST(json_extract_string(props, '$.k') AS BIGINT) AS item_id, count(*) AS view_count
    FROM events WHERE event_type = 'view' GROUP BY 1, 2
    """,
)
def q_item_tumbling_count(spark, sf_dir):
    views = events(spark, sf_dir, "ts", "event_type", "props").where(F.col("event_type") == VIEW)
    return item_window_counts(views.select("ts", item_of(F.col("props")).alias("item")), "ts", "item", ITEM_WINDOW[0], None)


@query(
    "topn_items",
    headline=True,
    oracle=f"""
    SELECT window_end, item_id, view_count,
           CAST(row_number() OVER (PARTITION BY window_end ORDER BY view_count DESC, item_id) - 1 AS INTEGER) AS rank
    FROM ({_ITEM_COUNTS_SQL})
    QUALIFY rank < {TOP_N}
    """,
)
def q_topn_items(spark, sf_dir):
    return top_items(_item_counts(spark, sf_dir), TOP_N)


def _price_windows_sql(key: str, window_sql: str, size: str) -> str:
    """Per key/window stats over ``window_sql`` rows (key, ws, ts, value, event_id)."""
    return f"""
    SELECT {key}, make_timestamp(ws) AS window_start,
           make_timestamp(ws + {to_micros(size)}) AS window_end,
           min(ts) AS first_ts, max(ts) AS last_ts, min(value) AS min_price,
           greatest(0.0::DOUBLE, max(value)) AS max_price,
           CASE WHEN max(value) > 0 THEN first(ts ORDER BY value DESC, ts, event_id) END AS max_ts
    FROM {window_sql}
    GROUP BY {key}, ws
    """


@query(
    "track_change",
    headline=True,
    oracle=f"""
    SELECT user_id, window_start, window_end, first_ts, last_ts, min_price, max_price,
           CASE WHEN prev IS NULL OR prev = 0 THEN 0.0::DOUBLE
                ELSE (max_price - prev) / prev * 100 END AS pct_change
    FROM (SELECT *, lag(max_price) OVER (PARTITION BY user_id ORDER BY window_start) AS prev
          FROM ({_price_windows_sql("user_id", f"(SELECT user_id, ts, value, event_id, {_tumble(TRACK_SIZE)} AS ws FROM events)", TRACK_SIZE)}))
    """,
)
def q_track_change(spark, sf_dir):
    ticks = events(spark, sf_dir, "user_id", "ts", "value", "event_id")
    return track_change(ticks, "user_id", "ts", "value", TRACK_SIZE, id_col="event_id")


def _delta_sql(window_sql: str, size: str) -> str:
    return f"""
    SELECT event_type, window_start, max_price, max_ts, prev_max,
           (max_price - prev_max) / prev_max * 100 AS pct_change
    FROM (SELECT *, lag(max_price) OVER (PARTITION BY event_type ORDER BY window_start) AS prev_max
          FROM ({_price_windows_sql("event_type", window_sql, size)}))
    WHERE prev_max IS NOT NULL AND prev_max <> 0
      AND abs((max_price - prev_max) / prev_max) * 100 > {DELTA_THRESHOLD}
    """


@query(
    "large_delta",
    headline=True,
    oracle=_delta_sql(
        _slide_sql("events", "event_type, ts, value, event_id", *DELTA_WINDOW), DELTA_WINDOW[0]
    ),
)
def q_large_delta(spark, sf_dir):
    ticks = events(spark, sf_dir, "event_type", "ts", "value", "event_id")
    size, slide = DELTA_WINDOW
    return large_delta(
        ticks, "event_type", "ts", "value", size, slide, DELTA_THRESHOLD, id_col="event_id"
    )


@query(
    "large_delta_tumbling",
    oracle=_delta_sql(
        f"(SELECT event_type, ts, value, event_id, {_tumble(DELTA_TUMBLE)} AS ws FROM events)",
        DELTA_TUMBLE,
    ),
)
def q_large_delta_tumbling(spark, sf_dir):
    ticks = events(spark, sf_dir, "event_type", "ts", "value", "event_id")
    return large_delta(
        ticks, "event_type", "ts", "value", DELTA_TUMBLE, None, DELTA_THRESHOLD, id_col="event_id"
    )


@query(
    "price_jump",
    headline=True,
    oracle=f"""
    SELECT user_id, event_id, diff,
           CASE WHEN diff > 0 THEN 'up' ELSE 'down' END AS direction,
           1000 AS parent_order_id, 'Buy' AS action, 1 AS quantity,
           1.0::DOUBLE AS limit_price, 1.0::DOUBLE AS take_profit, 0.5::DOUBLE AS stop_loss
    FROM (SELECT user_id, event_id,
                 value - lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS diff
          FROM events)
    WHERE diff > {JUMP_THRESHOLD} OR diff < -{JUMP_THRESHOLD}
    """,
)
def q_price_jump(spark, sf_dir):
    ticks = events(spark, sf_dir, "user_id", "ts", "event_id", "value")
    return price_jumps(ticks, "user_id", "ts", "event_id", "value", JUMP_THRESHOLD)


# ---- results as the lines of the reports, and event time from epoch seconds ----------------

#: ``%.2f`` rounds the shortest decimal form half up; so does a decimal of that form.
_TWO_DECIMALS = "CAST(round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,18)), 2) AS DECIMAL(38,2))::VARCHAR"


@query(
    "change_report_lines",
    oracle=f"""
    SELECT user_id, strftime(first_ts, '%Y-%m-%d %H:%M:%S') || ' - ' || strftime(last_ts, '%Y-%m-%d %H:%M:%S') || ', '
           || min_price::VARCHAR || ', ' || max_price::VARCHAR || ', ' || {_TWO_DECIMALS.format(x="pct_change")} AS line
    FROM ({REGISTRY["track_change"].oracle})
    """,
)
def q_change_report_lines(spark, sf_dir):
    """The change report, one text line per window."""
    rows = q_track_change(spark, sf_dir)
    line = render_change_report(F.col("first_ts"), F.col("last_ts"), F.col("min_price"), F.col("max_price"), F.col("pct_change"))
    return rows.select("user_id", line.alias("line"))


@query(
    "alert_lines",
    oracle=f"""
    SELECT 'Large Change Detected of ' || {_TWO_DECIMALS.format(x="pct_change")} || '% (' || prev_max::VARCHAR || ' - ' || max_price::VARCHAR
           || ') at  ' || coalesce((epoch_us(max_ts) // 1000)::VARCHAR, '') AS line
    FROM ({REGISTRY["large_delta"].oracle})
    """,
)
def q_alert_lines(spark, sf_dir):
    """The large-change alerts as text lines."""
    rows = q_large_delta(spark, sf_dir)
    line = render_alert(F.col("pct_change"), F.col("prev_max"), F.col("max_price"), ntz_to_instant(F.col("max_ts")))
    return rows.select(line.alias("line"))


@query(
    "click_window_count",
    oracle=f"""
    SELECT make_timestamp(ws) AS window_start, make_timestamp(ws + {to_micros(ITEM_WINDOW[0])}) AS window_end, count(*) AS view_count
    FROM {_slide_sql("(SELECT date_trunc('second', ts) AS ts FROM events WHERE event_type = 'view')", "ts", *ITEM_WINDOW)}
    GROUP BY ws
    """,
)
def q_click_window_count(spark, sf_dir):
    """Click lines ``user,item,category,behavior,seconds``: event time from epoch seconds, page views counted in sliding windows."""
    ev = events(spark, sf_dir, "user_id", "ts", "event_type", "props")
    line = F.concat_ws(",", "user_id", item_of(F.col("props")), F.lit("0"), "event_type", ntz_seconds(F.col("ts")))
    clicks = parse_delimited(ev.select(line.alias("value")), CLICKS).valid
    seconds, behavior = CLICKS.fieldNames()[4], CLICKS.fieldNames()[3]
    views = clicks.where(F.col(behavior) == VIEW).select(from_epoch_seconds(F.col(seconds)).alias("at"))
    size, slide = ITEM_WINDOW
    counts = windowed(views, "at", size, [count_rows("view_count")], slide=slide)
    return counts.select(*[instant_to_ntz(F.col(c)).alias(c) for c in ("window_start", "window_end")], "view_count")
