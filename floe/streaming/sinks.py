"""Sinks: row-format text files, record-to-text encodings, delimited text,
console, and a single-writer option."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from floe.session import scratch_path
from floe.streaming.runner import finish, scoped_start


def tuple_text(*cols: str) -> Column:
    """A tuple record's text form: ``(a,b,c)``, a null field as ``null``."""
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in cols]
    return F.concat(F.lit("("), F.concat_ws(",", *fields), F.lit(")"))


def as_text(df: DataFrame, encoded: Column, single_writer: bool = False) -> DataFrame:
    """One ``value`` column for the text sink; optionally one output file
    (``coalesce(1)``: only for small outputs such as reports)."""
    out = df.select(encoded.alias("value"))
    return out.coalesce(1) if single_writer else out


def write_text_stream(
    df: DataFrame,
    encoded: Column,
    path: str,
    checkpoint: str,
    single_writer: bool = False,
    available_now: bool = False,
) -> StreamingQuery:
    """Streaming row-format text files.  Text sinks only take append mode."""
    writer = (
        as_text(df, encoded, single_writer)
        .writeStream.format("text")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def run_text_stream(
    spark: SparkSession, stream: DataFrame, encoded: Column, name: str, location: str | None = None, single_writer: bool = False
) -> DataFrame:
    """Run ``stream`` to its end into text files; returns the committed lines as ``value``.

    The sink's commit log names the files of finished micro-batches, and Spark's
    reader goes by it: a file that a failed attempt left behind is not read.
    ``location`` resumes an earlier run (sink and checkpoint).
    """
    base = location or scratch_path(spark, f"stream-{name}")
    with scoped_start(spark, None):
        query = write_text_stream(stream, encoded, f"{base}/out", f"{base}/_checkpoint", single_writer, available_now=True)
        finish(query, name)
    return spark.read.text(f"{base}/out")


def write_delimited(df: DataFrame, path: str, sep: str = " ", mode: str = "overwrite") -> None:
    """Rows as ``sep``-separated fields, one row per line (no header)."""
    df.write.mode(mode).option("sep", sep).option("header", "false").csv(path)


def write_console(
    df: DataFrame, checkpoint: str | None = None, available_now: bool = False, output_mode: str = "append"
) -> StreamingQuery:
    """Print every micro-batch (demo sink)."""
    writer = df.writeStream.format("console").option("truncate", "false").outputMode(output_mode)
    if checkpoint:
        writer = writer.option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def write_text(df: DataFrame, encoded: Column, path: str, single_writer: bool = False, mode: str = "overwrite") -> None:
    """Batch text files, one line per row."""
    as_text(df, encoded, single_writer).write.mode(mode).text(path)
