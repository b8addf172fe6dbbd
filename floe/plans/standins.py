"""Stand-in input for the streaming queries: a table's rows as an ordered stream of files.

One parallel job writes the files of all micro-batches: by time ranges
(``replay_files``) or by a batch number the caller computes (``arrivals``, for
rows that come late).  The file source takes files oldest first, so the files'
modification times are then set in order through the Hadoop FileSystem API, a
metadata-only step on the driver, and checked.

Structured Streaming has no end-of-input flush: a sentinel row far in the
future, the last to arrive, moves the watermark past every real window.  Files go under
the session's shared checkpoint folder.
"""

from __future__ import annotations

import math
import time

from pyspark.sql import Column, DataFrame, SparkSession

from floe.session import scratch_path

# Rows per micro-batch when no chunk count is given.
ROWS_PER_CHUNK = 2_000_000
MIN_CHUNKS = 3
# Files of a micro-batch of a replay: a batch is one time range, read by as many tasks.
FILES_PER_BATCH = 8


def _order_files(spark: SparkSession, directory: str) -> None:
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(directory)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files = [s.getPath() for s in fs.listStatus(path) if s.isFile() and s.getPath().getName().startswith("part-")]
    ordered = sorted(files, key=lambda p: p.getName())
    base_ms = int(time.time() * 1000) - 1000 * (len(ordered) + 60)
    for i, file in enumerate(ordered):
        fs.setTimes(file, base_ms + 1000 * i, -1)
    check_order(fs, ordered)


def replay_files(
    spark: SparkSession,
    df: DataFrame,
    ts_col: str,
    chunks: int | None = None,
    sentinel: dict | None = None,
) -> str:
    """Write ``df`` (plus the ``sentinel`` row, which sorts last) as
    event-time-ordered parquet files into a fresh directory; returns the
    directory."""
    out = scratch_path(spark, "replay")
    if chunks is None:
        chunks = max(MIN_CHUNKS, math.ceil(df.count() / ROWS_PER_CHUNK))
    if sentinel is not None:
        df = df.unionByName(spark.createDataFrame([sentinel], df.schema))
    (
        df.repartitionByRange(chunks * FILES_PER_BATCH, ts_col)
        .write.option("maxRecordsPerFile", 0)
        .parquet(out)
    )
    _order_files(spark, out)
    return out


def arrivals(spark: SparkSession, df: DataFrame, batch: Column, batches: int, sentinel: dict | None = None, text: bool = False) -> DataFrame:
    """A stream of ``df`` whose micro-batch k holds the rows of ``batch`` k (0 to ``batches`` - 1); the
    ``sentinel`` row is a batch of its own after them.  ``text``: files of lines, from a string column ``value``."""
    out = scratch_path(spark, "arrivals")
    rows = df.repartitionById(batches, batch.cast("int"))
    rows = rows.select("value") if text else rows
    writer = rows.write.option("maxRecordsPerFile", 0)
    writer.text(out) if text else writer.parquet(out)
    _order_files(spark, out)
    if sentinel is not None:
        # Written now, so later than all that was dated back above.
        last = spark.createDataFrame([sentinel], rows.schema).coalesce(1).write.mode("append")
        last.text(out) if text else last.parquet(out)
    reader = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1)
    return reader.text(out) if text else reader.parquet(out)


def check_order(fs, ordered: list) -> None:
    """The file source takes files by modification time; a store that does not
    keep the times set above would replay out of order, so that is an error."""
    times = [fs.getFileStatus(p).getModificationTime() for p in ordered]
    if any(a >= b for a, b in zip(times, times[1:])):
        raise RuntimeError("the file system did not keep the replay files' modification times")
