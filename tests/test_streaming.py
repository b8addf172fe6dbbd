"""Micro-batch semantics of the streaming operators (one list = one batch):
late rows, watermark guard, previous-window state across batches."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from floe.functions.time import from_epoch_seconds
from floe.operators.aggregates import count_rows, max_of, min_of
from floe.operators.windows import windowed
from floe.session import scratch_path
from floe.streaming.event_time import guarded_filter, with_event_time
from floe.streaming.carry import last_totals, run_carried, running_totals
from floe.streaming.operators import chained_top_items, stream_price_jumps, stream_window_change
from floe.streaming.runner import run_available, run_to_frame
from floe.streaming.sinks import run_text_stream, tuple_text

SCHEMA = "ts BIGINT, sym STRING, beh STRING, v DOUBLE"
SENTINEL = [(9999999, "a", "eos", 0.0)]

LATE_BATCHES = [
    [(0, "a", "pv", 10.0), (29, "a", "pv", 12.0)],
    [(31, "a", "pv", 15.0), (5, "a", "pv", 99.0)],
    [(65, "a", "pv", 9.0)],
    [(20, "a", "pv", 500.0), (70, "a", "pv", 7.0)],
    SENTINEL,
]


def micro_batches(spark, batches):
    """Each batch becomes one file, written in order; the source takes one
    file per trigger."""
    src = scratch_path(spark, "batches")
    for rows in batches:
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(src)
    return with_event_time(stream.withColumn("ts", from_epoch_seconds(F.col("ts"))), "ts", from_ntz=False)


def seconds(ts):
    return int(ts.timestamp())


def test_out_of_order_and_late_rows(spark):
    timed = micro_batches(spark, LATE_BATCHES)
    agg = windowed(
        timed, "ts", "30 seconds", [min_of(F.col("v"), "lo"), max_of(F.col("v"), "hi"), count_rows("n")], keys=["sym"]
    )
    got = sorted((seconds(r.window_start), r.lo, r.hi, r.n) for r in run_to_frame(spark, agg, "late").collect())
    assert got == [(0, 10.0, 99.0, 3), (30, 15.0, 15.0, 1), (60, 7.0, 9.0, 2)]


def test_previous_window_change_across_batches(spark):
    timed = micro_batches(spark, LATE_BATCHES)
    changed = stream_window_change(spark, timed, "chg", "sym", "ts", "v", "30 seconds")
    got = sorted((seconds(r.window_start), r.max_price, r.pct_change) for r in changed.collect())
    assert [(s, m) for s, m, _ in got] == [(0, 99.0), (30, 15.0), (60, 9.0)]
    assert got[0][2] == 0.0
    assert got[1][2] == pytest.approx((15 - 99) / 99 * 100)
    assert got[2][2] == pytest.approx(-40.0)


def test_threshold_alerts_keep_state_on_quiet_windows(spark):
    timed = micro_batches(spark, LATE_BATCHES)
    alerts = stream_window_change(spark, timed, "alert", "sym", "ts", "v", "30 seconds", threshold=50.0)
    got = sorted((seconds(r.window_start), r.prev_max) for r in alerts.collect())
    assert got == [(30, 99.0)]  # -84.8 % alerts; -40 % does not


FILTER_BATCHES = [
    [(0, "a", "pv", 1.0)],
    [(100, "a", "buy", 1.0)],
    [(150, "a", "buy", 1.0)],
    [(1, "a", "pv", 1.0)],
    [(200, "a", "buy", 1.0)],
]


def _pv_counts(spark, guarded):
    timed = micro_batches(spark, FILTER_BATCHES)
    pv = F.col("beh") == "pv"
    views = guarded_filter(timed, pv, "ts") if guarded else timed.where(pv)
    agg = windowed(views, "ts", "5 seconds", [count_rows("n")])
    return sorted((seconds(r.window_start), r.n) for r in run_to_frame(spark, agg, "pv").collect())


def test_guarded_filter_lets_the_watermark_advance(spark):
    assert _pv_counts(spark, guarded=True) == [(0, 1)]


def test_plain_filter_stalls_the_watermark(spark):
    assert _pv_counts(spark, guarded=False) == []


def test_restart_from_checkpoint_is_exactly_once(spark):
    """Stop after part of the input, add the rest, restart the same query
    from its checkpoint: the sink holds every window once."""
    src = scratch_path(spark, "restart-src")
    location = scratch_path(spark, "restart")

    def add(rows):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(src)

    def run():
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(src)
        timed = with_event_time(stream.withColumn("ts", from_epoch_seconds(F.col("ts"))), "ts", from_ntz=False)
        return stream_window_change(spark, timed, "restart", "sym", "ts", "v", "30 seconds", location=location)

    for batch in LATE_BATCHES[:2]:
        add(batch)
    first = run().count()
    for batch in LATE_BATCHES[2:]:
        add(batch)
    got = sorted((seconds(r.window_start), r.max_price, r.pct_change) for r in run().collect())
    assert first <= 1
    assert [(s, m) for s, m, _ in got] == [(0, 99.0), (30, 15.0), (60, 9.0)]
    assert got[1][2] == pytest.approx((15 - 99) / 99 * 100)


def test_stream_top_n_ranks_whole_windows(spark):
    """Ranks over all items of a window, ties by item id, in every micro-batch that closes one."""
    from floe.streaming.operators import stream_top_items

    rows = [(t, "a", "pv", float(t % 7)) for t in range(0, 60)] + [(t, "b", "pv", float(t % 3)) for t in range(0, 60, 2)]
    item = lambda v, sym: int(v * 10) + (1 if sym == "a" else 2)
    timed = micro_batches(spark, [sorted(rows)[:40], sorted(rows)[40:], SENTINEL])
    items = timed.select("ts", (F.col("v") * 10 + F.when(F.col("sym") == "a", 1).otherwise(2)).cast("long").alias("item"))
    out = stream_top_items(spark, items, "topn", "ts", "item", "20 seconds", "10 seconds", 3)
    got = sorted((seconds(r.window_end), r.rank, r.item_id, r.view_count) for r in out.collect())
    want = []
    for end in range(10, 80, 10):
        counts = Counter(item(v, sym) for t, sym, _, v in rows if end - 20 <= t < end)
        want += [(end, i, k, c) for i, (k, c) in enumerate(sorted(counts.items(), key=lambda kc: (-kc[1], kc[0]))[:3])]
    assert got == want


def test_window_change_with_null_prices_and_many_windows_of_one_key(spark):
    """Windows whose prices are all null count as 0.0; null keys are a key; many windows of a key close at once."""
    rows = [(t * 30, "a" if t % 2 else None, "pv", None if t % 5 == 0 else float(t)) for t in range(120)]
    timed = micro_batches(spark, [rows[:50], rows[50:], SENTINEL])
    out = stream_window_change(spark, timed, "nulls", "sym", "ts", "v", "30 seconds")
    got = sorted((r.sym or "", seconds(r.window_start), r.max_price, r.pct_change) for r in out.collect())
    want = []
    for sym in ("", "a"):
        prev = None
        for t, s, _, v in rows:
            if (s or "") == sym:
                cur = max(0.0, v if v is not None else 0.0)
                want.append((sym, t, cur, 0.0 if not prev else (cur - prev) / prev * 100))
                prev = cur
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert [g[3] for g in got] == pytest.approx([w[3] for w in want])


def test_carried_steps_use_no_python(spark):
    """The steps between micro-batches are plain DataFrame plans."""
    seen = []

    def step(rows, table):
        from floe.streaming.carry import previous_rows, with_last_rows

        from floe.operators.sequence import time_bucket

        back = previous_rows(["sym"], ["ts"], ["v"], lambda both: time_bucket(both, "ts"))
        out, then = with_last_rows("sym", ["ts"], ["v"], back)(rows, table)
        seen.append(out._jdf.queryExecution().executedPlan().toString() + then._jdf.queryExecution().executedPlan().toString())
        return out, then

    timed = micro_batches(spark, LATE_BATCHES[:1] + [SENTINEL]).select("sym", "ts", "v")
    run_carried(spark, timed, "plans", timed.schema, step)
    assert len(seen) == 2 and not any("Python" in plan or "Pandas" in plan for plan in seen)


def test_price_jumps_restore_the_order(spark):
    batches = [
        [(10, "a", "x", 5.0), (40, "a", "x", 20.0), (20, "b", "x", 1.0)],
        [(30, "a", "x", 6.0), (30, "a", "x", 6.0), (25, "b", "x", 9.0), (60, "a", "x", 19.0)],
        [(50, "a", "x", 19.5), (80, "a", "x", 2.0)],
        [(5, "b", "x", 100.0)],  # behind the watermark: dropped
        [(9999999, "z", "x", 0.0)],
    ]
    src = scratch_path(spark, "batches")
    for k, rows in enumerate(batches):
        numbered = [(*r, 10 * k + i) for i, r in enumerate(rows)]
        spark.createDataFrame(numbered, SCHEMA + ", id BIGINT").coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema(SCHEMA + ", id BIGINT").option("maxFilesPerTrigger", 1).parquet(src)
    timed = with_event_time(stream.withColumn("ts", from_epoch_seconds(F.col("ts"))), "ts", "30 seconds", from_ntz=False)
    out = stream_price_jumps(spark, timed, "jumps", "sym", "ts", "id", "v", 3.0, "20 seconds")
    got = sorted((r.sym, r.id, r["diff"]) for r in out.collect())
    # a: 5 (10 s), 6, 6 (30 s), 20 (40 s), 19.5 (50 s), 19 (60 s), 2 (80 s); b: 1 (20 s), 9 (25 s).
    assert got == [("a", 1, 14.0), ("a", 21, -17.0), ("b", 12, 8.0)]


def test_chained_top_items_equal_the_ranking_per_batch(spark):
    from floe.streaming.operators import stream_top_items

    rows = [(t, "a", "pv", float(t * t % 11)) for t in range(120)]
    make = lambda: micro_batches(spark, [rows[:70], rows[70:], SENTINEL]).select("ts", F.col("v").cast("long").alias("item"))
    chained = run_to_frame(spark, chained_top_items(make(), "ts", "item", "20 seconds", "10 seconds", 3, slices=2), "chained")
    ranked = stream_top_items(spark, make(), "topn", "ts", "item", "20 seconds", "10 seconds", 3)
    cols = ["window_end", "item_id", "view_count", "rank"]
    assert sorted(map(tuple, chained.select(cols).collect())) == sorted(map(tuple, ranked.select(cols).collect())) != []


def test_text_stream_restarts_and_reads_by_the_log(spark):
    src, base = scratch_path(spark, "lines"), scratch_path(spark, "text")

    def run(lines):
        spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("append").text(src)
        from floe.functions.parse import parse_numbers

        stream = spark.readStream.schema("value string").option("maxFilesPerTrigger", 1).text(src)
        numbers = with_event_time(stream.select(*parse_numbers(F.col("value"))), "ts", from_ntz=False)
        agg = windowed(numbers, "ts", "4 seconds", [count_rows("n")], slide="2 seconds")
        return run_text_stream(spark, agg.select(F.unix_millis("window_start").alias("a"), "n"), tuple_text("a", "n"), "text", location=base)

    first = run(["1000,5", "3000,x", "7000,1"])
    once = sorted(r.value for r in first.collect())
    assert once == ["(-2000,1)", "(0,2)", "(2000,1)"]
    # A file that no commit names is not part of the sink.
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{base}/out/part-left-behind.txt")
    out = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(path)
    out.writeBytes("(9,9)")
    out.close()
    assert sorted(r.value for r in run(["99000,2"]).collect()) == sorted([*once, "(4000,1)", "(6000,1)"])


def test_slowest_stream_holds_the_watermark(spark):
    """The union's windows wait for the stream that lags; by the fastest, its rows would be late."""
    quick = [[(t, "q", "pv", 1.0)] for t in (0, 100, 200, 300)] + [SENTINEL]
    slow = [[(t, "s", "pv", 1.0)] for t in (1, 11, 21, 31, 41)] + [SENTINEL]
    both = micro_batches(spark, quick).union(micro_batches(spark, slow))
    agg = windowed(both, "ts", "10 seconds", [count_rows("n")], keys=["sym"])
    got = sorted((r.sym, seconds(r.window_start), r.n) for r in run_to_frame(spark, agg, "union").collect())
    assert got == [("q", t, 1) for t in (0, 100, 200, 300)] + [("s", t, 1) for t in (0, 10, 20, 30, 40)]


def test_running_totals_leave_after_their_time_to_live(spark):
    src = scratch_path(spark, "batches")
    for rows in ([("a", 1), ("b", 2), (None, 4)], [("a", 10)], [("a", 100), ("b", 20), (None, 40)]):
        spark.createDataFrame(rows, "k string, v long").coalesce(1).write.mode("append").parquet(src)

    def totals(ttl):
        stream = spark.readStream.schema("k string, v long").option("maxFilesPerTrigger", 1).parquet(src)
        schema, step = running_totals(["k"], ["v"], ttl)
        base = scratch_path(spark, "ttl")
        out = spark.read.parquet(run_carried(spark, stream, "ttl", schema(stream), step, location=base, keep=3))
        sizes = [spark.read.parquet(f"{base}/table/batch={i}").count() for i in range(3)]
        return {r.k: r.v for r in last_totals(out, ["k"], ["v"]).collect()}, sizes

    assert totals("1 DAY") == ({"a": 111, "b": 22, None: 44}, [3, 3, 3])
    # Every batch comes later than no time at all: only what it touches is held.
    assert totals("0 SECONDS") == ({"a": 100, "b": 20, None: 40}, [3, 1, 3])


def test_carried_tables_of_old_batches_are_removed(spark):
    src, base = scratch_path(spark, "batches"), scratch_path(spark, "kept")
    for i in range(5):
        spark.createDataFrame([("a", i)], "k string, v long").coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema("k string, v long").option("maxFilesPerTrigger", 1).parquet(src)
    schema, step = running_totals(["k"], ["v"], "1 DAY")
    out = spark.read.parquet(run_carried(spark, stream, "kept", schema(stream), step, location=base))
    assert [tuple(r) for r in last_totals(out, ["k"], ["v"]).collect()] == [("a", 10)]
    tables = spark.read.parquet(f"{base}/table")
    assert {r.batch for r in tables.select("batch").distinct().collect()} == {3, 4}
