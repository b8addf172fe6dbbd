"""Sources and sinks: delimited reads, text / delimited writes, streaming
text sink, synthetic points, sequences."""

import pytest
from pyspark.sql import functions as F

from floe.functions.render import theta_line
from floe.operators.regression import descend, point_line, round_theta, synthetic_points
from floe.session import scratch_path
from floe.sources.delimited import read_points, read_sales
from floe.sources.sequence import integer_sequence
from floe.sources.text import read_lines, text_columns, union_text
from floe.streaming.sinks import tuple_text, write_console, write_delimited, write_text, write_text_stream


def test_sequence_is_inclusive(spark):
    s = integer_sequence(spark, 1, 10)
    assert s.count() == 10 and s.agg(F.min("id"), F.max("id")).first() == (1, 10)


def test_points_round_trip_as_space_separated_text(spark):
    rows = spark.range(500).select(F.col("id").alias("k"))
    pts = synthetic_points(rows, seed=3)
    path = scratch_path(spark, "points")
    write_text(pts, point_line(F.col("x"), F.col("y")), path)
    back = read_points(spark, path)
    assert back.count() == 500
    assert back.exceptAll(pts).count() == 0
    theta = round_theta(descend(back, 500, rate=0.1)).first()
    assert theta.theta1 == pytest.approx(2.0, abs=0.05)
    line = back.limit(1).select(theta_line(F.lit(0.5), F.lit(1.25)).alias("v")).first().v
    assert line == "0.5 1.25"


def test_word_pairs_as_delimited_text_and_lines_union(spark):
    words = spark.createDataFrame([("to", 2), ("be", 2)], "word string, n bigint")
    path = scratch_path(spark, "wc")
    write_delimited(words, path, sep=" ")
    lines = read_lines(spark, path)
    assert sorted(r.value for r in lines.collect()) == ["be 2", "to 2"]
    both = union_text(lines, lines)
    assert both.count() == 4  # union keeps duplicates
    assert text_columns((words, "word"), (words, "word")).count() == 4


def test_sales_reader_with_declared_schema(spark):
    path = scratch_path(spark, "sales")
    spark.createDataFrame(
        [("01-06-2018,June,Category5,Bat,12",), ("02-06-2018,June,Category4,Perfume,10",)], "value string"
    ).coalesce(1).write.text(path)
    sales = read_sales(spark, path)
    assert sales.schema["profit"].dataType.simpleString() == "int"
    assert sales.groupBy("month").agg(F.sum("profit").alias("p")).first().p == 22


def test_streaming_text_sink_appends_tuple_lines(spark):
    src = scratch_path(spark, "src")
    spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string").write.parquet(src)
    stream = spark.readStream.schema("k int, v string").parquet(src)
    out, ckpt = scratch_path(spark, "txt"), scratch_path(spark, "ckpt")
    q = write_text_stream(stream, tuple_text("k", "v"), out, ckpt, single_writer=True, available_now=True)
    q.awaitTermination(120)
    assert sorted(r.value for r in spark.read.text(out).collect()) == ["(1,a)", "(2,b)"]
    console = write_console(stream, scratch_path(spark, "console"), available_now=True)
    console.awaitTermination(120)
    assert console.exception() is None


def test_whole_json_document_file_to_rows(spark):
    """A multi-line envelope document read as one value, then exploded."""
    from floe.functions.json import explode_envelope
    from floe.schemas import MATCH
    from floe.sources.text import read_whole_files

    path = scratch_path(spark, "doc")
    doc = '{\n "response": [\n  {"fixture": {"id": 1}},\n  {"fixture": {"id": 2}}\n ]\n}\n'
    spark.createDataFrame([(doc,)], "value string").coalesce(1).write.text(path)
    rows = explode_envelope(read_whole_files(spark, path), "value", MATCH)
    assert sorted((r.pos, r.item.fixture.id) for r in rows.collect()) == [(0, 1), (1, 2)]


def test_top_n_report_line(spark):
    import datetime as dt

    from floe.functions.render import render_top_n

    df = spark.createDataFrame([(dt.datetime(2021, 10, 14, 10, 0, 5), 0, 12224, 2413)], "e timestamp_ntz, r int, i long, n long")
    line = df.select(render_top_n(F.col("e"), F.col("r"), F.col("i"), F.col("n")).alias("v")).first().v
    assert line == "2021-10-14 10:00:05 No0: item=12224 views=2413"


def test_cluster_session_needs_a_shared_checkpoint_dir():
    """Without spark.checkpoint.dir a cluster session must not fall back to
    a machine-local folder."""
    from types import SimpleNamespace

    from floe.session import checkpoint_root

    ctx = SimpleNamespace(master="spark://cluster:7077", getCheckpointDir=lambda: None)
    fake = SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: default), sparkContext=ctx)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_root(fake)
    shared = SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default=None: "hdfs://nn/ckpt/"), sparkContext=ctx
    )
    assert checkpoint_root(shared) == "hdfs://nn/ckpt"
