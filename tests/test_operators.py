"""Operator-level tests: golden values, literal window sizes, edge cases,
equivalence of execution strategies, and brute-force checks."""

import datetime as dt

import pandas as pd
import pytest
from pyspark.sql import functions as F

from floe.functions.json import envelope_schema, explode_envelope, first_of_envelope, parse_envelopes, undeclared_paths, unknown_keys
from floe.functions.parse import parse_delimited, parse_numbers, parse_prices, parse_sales, parse_ticks
from floe.functions.render import render_alert, render_change_report
from floe.functions.urls import fill_template
from floe.operators.change import large_delta, track_change, window_price_stats
from floe.operators.counts import word_count
from floe.operators.ratio import indicator_ratio, inside_unit_circle, unit_hash
from floe.operators.regression import descend, gd_step, gd_step_with_params, round_theta
from floe.operators.signals import price_jumps
from floe.operators.topn import top_items
from floe.operators.windows import windowed
from floe.operators.aggregates import count_rows, sum_of
from floe.schemas import CLICKS, MATCH, MATCH_TREE, fill_defaults
from floe.sources.builtin import default_params, default_points, default_text
from floe.sources.kafka import kafka_options
from floe.streaming.sinks import tuple_text
from tests.conftest import SF001, SF01

T0 = dt.datetime(2021, 10, 14, 10, 0, 0)


def at(seconds):
    return T0 + dt.timedelta(seconds=seconds)


# ---- golden values -----------------------------------------------------------


def test_default_text_word_count(spark):
    counts = {r.word: r.n for r in word_count(default_text(spark)).collect()}
    assert sum(counts.values()) == 287
    assert len(counts) == 170
    assert (counts["the"], counts["of"], counts["to"], counts["and"]) == (22, 15, 15, 12)
    assert (counts["that"], counts["a"], counts["s"], counts["sleep"]) == (7, 5, 5, 5)


def test_default_points_descent(spark):
    row = round_theta(descend(default_points(spark), 10)).first()
    assert (row.theta0, row.theta1) == (0.25132, 1.728727)


def test_descent_equals_literal_per_point_rounds(spark):
    pts = default_points(spark)
    t0, t1 = 0.0, 0.0
    for _ in range(10):
        r = gd_step(pts, F.lit(t0), F.lit(t1)).first()
        t0, t1 = r.theta0, r.theta1
    fast = descend(pts, 10).first()
    assert abs(fast.theta0 - t0) < 1e-12 and abs(fast.theta1 - t1) < 1e-12


def test_params_frame_must_have_one_row(spark):
    pts = default_points(spark)
    one = gd_step_with_params(pts, default_params(spark)).first()
    lit = gd_step(pts, F.lit(0.0), F.lit(0.0)).first()
    assert one == lit
    two = spark.createDataFrame([(0.0, 0.0), (1.0, 1.0)], "theta0 double, theta1 double")
    with pytest.raises(Exception):
        gd_step_with_params(pts, two).collect()


def test_ratio_estimate_over_sequence(spark):
    ids = spark.range(1, 1_000_001).select(F.col("id"))
    x = unit_hash((F.col("id"), 2654435761), modulus=2**32)
    y = unit_hash((F.col("id"), 1442695041), modulus=2**32)
    row = indicator_ratio(ids.select(x.alias("x"), y.alias("y")), inside_unit_circle(F.col("x"), F.col("y")), 4.0).first()
    assert row.n == 1_000_000
    assert row.hits == 785456
    assert row.ratio == pytest.approx(3.141824)


# ---- windows -------------------------------------------------------------------


def _ticks(spark, rows):
    return spark.createDataFrame(
        [(s, at(t), float(p), i) for i, (s, t, p) in enumerate(rows)],
        "sym string, ts timestamp_ntz, price double, id long",
    )


@pytest.mark.parametrize(
    "size,slide",
    [("30 seconds", None), ("5 minutes", "15 seconds"), ("4 seconds", "2 seconds"), ("5 seconds", "1 second")],
)
def test_literal_window_sizes_match_brute_force(spark, size, slide):
    import random

    rnd = random.Random(7)
    rows = [(rnd.choice("ab"), rnd.randint(0, 900), rnd.randint(1, 50)) for _ in range(400)]
    df = _ticks(spark, rows)
    got = {
        (r.sym, r.window_start): (r.n, r.total)
        for r in windowed(
            df, "ts", size, [count_rows("n"), sum_of(F.col("price"), "total")], slide=slide, keys=["sym"]
        ).collect()
    }
    from floe.functions.durations import to_micros

    s_us = to_micros(size) // 1_000_000
    d_us = to_micros(slide) // 1_000_000 if slide else s_us
    epoch = int((T0 - dt.datetime(1970, 1, 1)).total_seconds())
    expect = {}
    for sym, t, p in rows:
        abs_t = epoch + t
        start = abs_t - abs_t % d_us
        while start > abs_t - s_us:
            key = (sym, dt.datetime(1970, 1, 1) + dt.timedelta(seconds=start))
            n, tot = expect.get(key, (0, 0.0))
            expect[key] = (n + 1, tot + p)
            start -= d_us
    assert got == expect


def test_pane_and_direct_strategies_agree(spark):
    ev = spark.read.parquet(f"{SF01}/events.parquet")
    a = window_price_stats(ev, "event_type", "ts", "value", "2 hours", "30 minutes", "event_id", strategy="direct")
    b = window_price_stats(ev, "event_type", "ts", "value", "2 hours", "30 minutes", "event_id", strategy="panes")
    assert a.count() == b.count()
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_change_edge_cases(spark):
    # negative prices never win the max (floor 0.0, no max time); prev = 0
    # gives change 0.0; a single-row window is a normal window.
    rows = [("a", 0, -5), ("a", 10, -1), ("a", 35, 4), ("a", 70, 6), ("b", 5, 3)]
    out = {
        (r.sym, r.window_start.second if r.window_start.minute == 0 else 60 + r.window_start.second): r
        for r in track_change(_ticks(spark, rows), "sym", "ts", "price", "30 seconds", id_col="id").collect()
    }
    w0 = out[("a", 0)]
    assert (w0.min_price, w0.max_price, w0.pct_change) == (-5.0, 0.0, 0.0)
    assert out[("a", 30)].pct_change == 0.0  # previous max is 0
    assert out[("a", 60)].pct_change == pytest.approx((6 - 4) / 4 * 100)
    assert out[("b", 0)].pct_change == 0.0
    stats = {(r.sym, r.window_start): r for r in window_price_stats(_ticks(spark, rows), "sym", "ts", "price", "30 seconds", id_col="id").collect()}
    assert stats[("a", at(0))].max_ts is None
    assert stats[("b", at(0))].max_ts == at(5)


def test_large_delta_strict_threshold_and_argmax_ties(spark):
    rows = [("a", 0, 100), ("a", 30, 105), ("a", 31, 110), ("a", 45, 110), ("a", 60, 110)]
    alerts = large_delta(_ticks(spark, rows), "sym", "ts", "price", "30 seconds", None, 5.0, id_col="id").collect()
    assert len(alerts) == 1  # 100 -> 110 is 10 %; 110 -> 110 is 0 %
    assert alerts[0].max_ts == at(31)  # first row reaching the max
    none = large_delta(_ticks(spark, [("a", 0, 100), ("a", 30, 105)]), "sym", "ts", "price", "30 seconds", None, 5.0).count()
    assert none == 0  # exactly 5 % is not more than 5 %


def test_top_items_ties_by_item_id(spark):
    counts = spark.createDataFrame(
        [(at(5), 9, 3), (at(5), 4, 3), (at(5), 7, 3), (at(5), 1, 1), (at(10), 2, 1)],
        "window_end timestamp_ntz, item_id long, view_count long",
    )
    got = [(r.window_end, r.item_id, r.rank) for r in top_items(counts, 3).orderBy("window_end", "rank").collect()]
    assert got == [(at(5), 4, 0), (at(5), 7, 1), (at(5), 9, 2), (at(10), 2, 0)]


def test_top_n_plan_limits_before_exchange(spark):
    counts = spark.read.parquet(f"{SF01}/events.parquet").groupBy(
        F.col("ts").alias("window_end"), F.col("user_id").alias("item_id")
    ).agg(F.count(F.lit(1)).alias("view_count"))
    plan = top_items(counts, 3)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


@pytest.mark.parametrize("bucket", ["minute", "hour", "day"])
def test_bucketed_previous_row_equals_plain_lag(spark, bucket):
    ev = spark.read.parquet(f"{SF01}/events.parquet")
    got = price_jumps(ev, "user_id", "ts", "event_id", "value", 3.0, bucket=F.date_trunc(bucket, "ts"))
    pdf = ev.select("user_id", "ts", "event_id", "value").toPandas().sort_values(["user_id", "ts", "event_id"])
    pdf["diff"] = pdf["value"] - pdf.groupby("user_id")["value"].shift(1)
    expect = pdf[(pdf["diff"] > 3) | (pdf["diff"] < -3)]
    assert sorted(zip(expect.event_id, expect["diff"])) == sorted((r.event_id, r.diff) for r in got.collect())


# ---- parsing ---------------------------------------------------------------------


def test_line_parsers(spark):
    df = spark.createDataFrame(
        [("FTNT,1634200000000,310.25", "1634200000000,61234.5", "1634200000000,42", "01-06-2018,June,Category5,Bat,12")],
        "t string, p string, n string, s string",
    )
    r = df.select(
        F.struct(*parse_ticks(F.col("t"))).alias("t"),
        F.struct(*parse_prices(F.col("p"))).alias("p"),
        F.struct(*parse_numbers(F.col("n"))).alias("n"),
        F.struct(*parse_sales(F.col("s"))).alias("s"),
    ).first()
    assert (r.t.symbol, r.t.price) == ("FTNT", 310.25)
    assert (r.p.price_text, r.p.price) == ("61234.5", 61234.5)
    assert r.n.number == 42
    assert (r.s.month, r.s.category, r.s.product, r.s.profit, r.s.n) == ("June", "Category5", "Bat", 12, 1)


def test_permissive_parse_quarantines_and_strict_fails(spark):
    lines = spark.createDataFrame(
        [("1,2,3,pv,1511658000",), ("1,2,x,pv,1511658000",), ("1,2,3,pv",), ("1,2,3,pv,5,6",)], "value string"
    )
    parsed = parse_delimited(lines, CLICKS)
    assert parsed.valid.count() == 1
    reasons = sorted(r.reason for r in parsed.quarantine.collect())
    assert reasons == ["bad_value", "wrong_arity", "wrong_arity"]
    strict = parse_delimited(lines.limit(2), CLICKS, mode="strict")
    with pytest.raises(Exception):
        strict.valid.collect()


# ---- JSON -----------------------------------------------------------------------

ENVELOPES = [
    '{"response":[{"fixture":{"id":7,"status":{"long":"Match Finished"}},"teams":{"home":{"id":1,"winner":null}},"zzz":1},{"fixture":{"id":8}}]}',
    '{"response":[]}',
    "{}",
    "not json",
]


def test_envelope_defaults(spark):
    df = spark.createDataFrame([(i, e) for i, e in enumerate(ENVELOPES)], "doc long, value string")
    rows = explode_envelope(df, "value", MATCH, keep=["doc"])
    filled = rows.select("doc", "pos", fill_defaults(F.col("item"), MATCH_TREE).alias("m")).orderBy("doc", "pos").collect()
    assert [(r.doc, r.pos) for r in filled] == [(0, 0), (0, 1)]
    a, b = filled[0].m, filled[1].m
    assert (a.fixture.id, a.fixture.status.long, a.fixture.status.elapsed) == (7, "Match Finished", -1)
    assert (a.teams.home.id, a.teams.home.winner, a.teams.away.name) == (1, False, "unknown")
    assert (b.fixture.id, b.fixture.referee, b.goals.home, b.score.penalty.away) == (8, "unknown", 0, 0)
    firsts = {r.doc: r.item for r in first_of_envelope(df, "value", MATCH, keep=["doc"]).collect()}
    assert firsts[0].fixture.id == 7 and firsts[1] is None and firsts[2] is None and firsts[3] is None


def test_envelope_verdicts(spark):
    texts = [
        '{"response":[{"goals":{"home":1}}]}',
        '{"response":[]}',
        '{"response":[{"goals":{"home":1}}',
        '{"response":[{"goals":{"home":"many"}}]}',
        '{"other":1}',
        "",
        None,
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, value string")
    got = {r.i: r for r in parse_envelopes(df, "value", MATCH, keep=["i"]).collect()}
    assert [got[i].bad for i in range(7)] == [False, False, True, True, True, True, True]
    assert got[0]["items"][0].goals.home == 1 and got[1]["items"] == []


def test_undeclared_paths_at_every_level(spark):
    texts = [
        '{"fixture":{"venue":{"id":1,"roof":{"x":1}},"bogus":1},"zzz":null}',
        '{"fixture":null,"goals":{"home":{"a":1}},"teams":[1]}',
        "{}",
        '{"fixture":',
        None,
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, value string")
    got = {r.i: r.p for r in df.select("i", undeclared_paths(F.col("value"), MATCH_TREE).alias("p")).collect()}
    assert got == {0: ["fixture.bogus", "fixture.venue.roof", "zzz"], 1: [], 2: [], 3: None, 4: None}


def test_unknown_keys_strict_mode(spark):
    df = spark.createDataFrame([('{"fixture":{},"zzz":1}',)], "value string")
    assert df.select(unknown_keys(F.col("value"), list(MATCH_TREE)).alias("u")).first().u == ["zzz"]


# ---- small functions ------------------------------------------------------------


def test_templates_renderers_and_options(spark):
    df = spark.createDataFrame([(731652,)], "id long")
    url = df.select(fill_template("u?id=${id}&timezone=${timezone}&d=${date}", {"id": F.col("id"), "timezone": F.lit("Europe/Rome")}).alias("u")).first().u
    assert url == "u?id=731652&timezone=Europe/Rome&d=${date}"
    line = df.select(
        render_alert(F.lit(10.0), F.lit(100.0), F.lit(110.0), F.lit(at(31))).alias("a"),
        render_change_report(F.lit(at(0)), F.lit(at(29)), F.lit(10.0), F.lit(99.0), F.lit(1 / 3)).alias("r"),
        tuple_text("id").alias("t"),
    ).first()
    assert line.a == "Large Change Detected of 10.00% (100.0 - 110.0) at  1634205631000"
    assert line.r == "2021-10-14 10:00:00 - 2021-10-14 10:00:29, 10.0, 99.0, 0.33"
    assert line.t == "(731652)"
    opts = kafka_options("broker:9092", "matches")
    assert "failOnDataLoss" not in opts  # Spark's default: lost offsets fail the query
    assert opts["startingOffsets"] == "earliest" and "kafka.group.id" not in opts


def test_time_conversions_ignore_session_zone(spark):
    from floe.functions.time import instant_to_ntz, ntz_micros, ntz_to_instant
    from floe.session import scoped_conf

    df = spark.sql(
        "SELECT timestamp_ntz'2024-03-10 02:30:00' AS ts UNION ALL "
        "SELECT timestamp_ntz'2024-07-15 12:34:56.789012'"
    )
    with scoped_conf(spark, {"spark.sql.session.timeZone": "America/Los_Angeles"}):
        rows = df.select(
            "ts", ntz_micros(F.col("ts")).alias("us"), instant_to_ntz(ntz_to_instant(F.col("ts"))).alias("back")
        ).collect()
    for r in rows:
        assert r.us == (r.ts - dt.datetime(1970, 1, 1)) // dt.timedelta(microseconds=1)
        assert r.back == r.ts


@pytest.mark.parametrize("name", ["track_change", "large_delta"])
def test_previous_window_across_small_buckets(spark, monkeypatch, name):
    """Force 3 windows per bucket so most previous windows come from the
    hand-off between buckets (including keys with empty stretches)."""
    import floe.operators.change as change
    from floe.plans import REGISTRY
    from tests.oracle import compare

    monkeypatch.setattr(change.with_previous_window, "__defaults__", ("prev_max", None, 3))
    report = compare(REGISTRY[name].build(spark, SF01), REGISTRY[name].oracle, SF01)
    assert report["ok"], report


@pytest.mark.parametrize("bucket", ["1 minute", "1 hour", "30 days"])
def test_price_jump_null_and_hot_keys_at_any_bucket(spark, bucket):
    """Null keys are a key of their own; a hot key is cut into many buckets; the jumps stay those of a plain lag."""
    from pyspark.sql import Window

    from floe.operators.signals import price_jumps

    rows = [(1 if i % 3 else None, dt.datetime(2024, 1, 1) + dt.timedelta(minutes=7 * i), i, float((i * 37) % 50)) for i in range(400)]
    df = spark.createDataFrame(rows, "k long, ts timestamp_ntz, id long, price double")
    got = sorted((r.id, r.diff) for r in price_jumps(df, "k", "ts", "id", "price", bucket=bucket).collect())
    diff = F.col("price") - F.lag("price").over(Window.partitionBy("k").orderBy("ts", "id"))
    want = sorted((r.id, r.diff) for r in df.withColumn("diff", diff).where("abs(diff) > 3").collect())
    assert got == want and len(want) > 200


def test_previous_window_keeps_null_keys(spark):
    from pyspark.sql import Window

    from floe.operators.change import with_previous_window

    rows = [(k, dt.datetime(2024, 1, 1, h), dt.datetime(2024, 1, 1, h + 1), float(h)) for k in (None, "a") for h in range(0, 20, 2)]
    w = spark.createDataFrame(rows, "k string, window_start timestamp_ntz, window_end timestamp_ntz, v double")
    got = with_previous_window(w, ["k"], "v", slide="1 hour", windows_per_bucket=3)
    want = w.withColumn("prev_max", F.lag("v").over(Window.partitionBy("k").orderBy("window_start")))
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty() and got.where("prev_max IS NULL").count() == 2


def test_building_plans_runs_no_job(spark):
    from floe.plans import REGISTRY

    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("plan-only", "building plans")
    for name in ("track_change", "large_delta", "large_delta_tumbling", "price_jump", "envelope_explode", "envelope_first"):
        REGISTRY[name].build(spark, SF01)
    jobs = [j for j in tracker.getJobIdsForGroup("plan-only") if tracker.getJobInfo(j)]
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    # reading a parquet footer for its schema is the only job a reader runs
    assert all(len(tracker.getJobInfo(j).stageIds) == 1 for j in jobs) and len(jobs) <= 6


def test_paged_envelopes_keep_every_row_of_hot_and_null_keys(spark):
    from floe.functions.json import explode_envelope
    from floe.operators.envelopes import first_pages, pack_envelopes
    from pyspark.sql import types as T

    hot = [(1, i, 5.0) for i in range(2500)]
    rest = [(None, i, 1.0) for i in range(5)] + [(k, 1, float(k)) for k in range(2, 40)]
    df = spark.createDataFrame(hot + rest, "k long, line int, qty double")
    packed = pack_envelopes(df, "k", ["line", "qty"], F.floor(F.col("line") / 100).cast("int"))
    element = T.StructType([T.StructField("line", T.IntegerType()), T.StructField("qty", T.DoubleType())])
    rows = explode_envelope(packed, "value", element, keep=["k"]).select("k", "item.line", "item.qty")
    assert rows.exceptAll(df).count() == 0 and df.exceptAll(rows).count() == 0
    assert packed.where("k = 1").count() == 25 and first_pages(packed, "k").count() == 40


def test_urls_that_do_not_parse(spark):
    from floe.functions.urls import url_host

    urls = ["http://a b.com/x", "not a url", "http://[bad", "http://my_host.com/p", "http://u@h.com:80/p"]
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    assert [r.h for r in df.select(url_host(F.col("u")).alias("h")).collect()] == ["a b.com", "", "[bad", "my_host.com", "h.com"]


def test_null_fields_in_tuple_text(spark):
    df = spark.createDataFrame([(1, None, "c")], "a int, b string, c string")
    assert df.select(tuple_text("a", "b", "c").alias("t")).first().t == "(1,null,c)"


def test_empty_parameter_frame_is_an_error(spark):
    from floe.operators.regression import gd_step_with_params

    points = spark.createDataFrame([(1.0, 2.0)], "x double, y double")
    none = spark.createDataFrame([], "theta0 double, theta1 double")
    with pytest.raises(Exception, match="no row"):
        gd_step_with_params(points, none).collect()


def test_replay_order_is_checked():
    from floe.plans.standins import check_order

    class Status:
        def __init__(self, t):
            self.t = t

        def getModificationTime(self):
            return self.t

    class Store:
        def __init__(self, times):
            self.times = times

        def getFileStatus(self, i):
            return Status(self.times[i])

    check_order(Store([1, 2, 3]), [0, 1, 2])
    with pytest.raises(RuntimeError):
        check_order(Store([1, 3, 2]), [0, 1, 2])
