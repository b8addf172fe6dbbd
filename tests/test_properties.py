"""Property-based checks (hypothesis): the pane and direct window strategies
agree, and the bucketed previous-row operator equals a plain ordered lag, on
random inputs including duplicate timestamps and a single hot key."""

import datetime as dt

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from floe.operators.aggregates import count_rows, max_of, min_of, min_struct, sum_of
from floe.operators.sequence import with_previous_row
from floe.operators.windows import windowed

T0 = dt.datetime(2024, 1, 1)

rows_strategy = st.lists(
    st.tuples(
        st.sampled_from(["hot", "hot", "hot", "a", "b"]),  # one key holds most rows
        st.integers(min_value=0, max_value=3 * 3600),  # seconds
        st.integers(min_value=-50, max_value=500),  # price (negatives included)
    ),
    min_size=1,
    max_size=120,
)

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


def frame(spark, rows):
    return spark.createDataFrame(
        [(k, T0 + dt.timedelta(seconds=s), float(p), i) for i, (k, s, p) in enumerate(rows)],
        "k string, ts timestamp_ntz, price double, id long",
    )


@SETTINGS
@given(rows=rows_strategy, fanout=st.sampled_from([2, 4, 6]))
def test_pane_strategy_equals_direct(spark, rows, fanout):
    df = frame(spark, rows)
    aggs = [
        count_rows("n"),
        sum_of(F.col("price"), "total"),
        min_of(F.col("price"), "lo"),
        max_of(F.col("price"), "hi"),
        min_struct("arg", -F.col("price"), F.col("ts"), F.col("id")),
    ]
    size, slide = f"{10 * fanout} minutes", "10 minutes"
    a = windowed(df, "ts", size, aggs, slide=slide, keys=["k"], strategy="direct")
    b = windowed(df, "ts", size, aggs, slide=slide, keys=["k"], strategy="panes")
    assert sorted(a.collect()) == sorted(b.collect())


@SETTINGS
@given(rows=rows_strategy, grain=st.sampled_from(["minute", "hour"]))
def test_bucketed_previous_row_equals_lag(spark, rows, grain):
    df = frame(spark, rows)
    got = with_previous_row(df, ["k"], ["ts", "id"], ["price"], F.date_trunc(grain, "ts"))
    pdf = pd.DataFrame(rows, columns=["k", "s", "price"]).reset_index(names="id")
    pdf = pdf.sort_values(["k", "s", "id"])
    pdf["prev"] = pdf.groupby("k")["price"].shift(1)
    expect = {(r.id, None if pd.isna(r.prev) else float(r.prev)) for r in pdf.itertuples()}
    assert {(r.id, r.prev_price) for r in got.collect()} == expect
