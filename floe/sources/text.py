"""Line-oriented text sources (one row per line) and unions of several inputs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_lines(spark: SparkSession, *paths: str) -> DataFrame:
    """``value STRING``, one row per line, all files together (duplicates kept)."""
    return spark.read.text(list(paths))


def read_whole_files(spark: SparkSession, *paths: str) -> DataFrame:
    """``value STRING``, one row per file (for whole JSON documents)."""
    return spark.read.text(list(paths), wholetext=True)


def stream_lines(spark: SparkSession, directory: str, max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(directory)


def union_text(*frames: DataFrame, text_col: str = "value") -> DataFrame:
    """UNION ALL of the text column of several frames, renamed to ``value``."""
    parts = [f.select(F.col(text_col).alias("value")) for f in frames]
    return reduce(DataFrame.unionByName, parts)


def text_columns(*pairs: tuple[DataFrame, str]) -> DataFrame:
    """UNION ALL of (frame, text column) pairs as one ``value`` column."""
    return reduce(
        DataFrame.unionByName,
        [frame.select(F.col(col).alias("value")) for frame, col in pairs],
    )


def stream_socket_lines(spark: SparkSession, host: str, port: int) -> DataFrame:
    """``value STRING`` lines from a TCP socket (demo source: not replayable,
    no fault tolerance; use a file or Kafka stream in production)."""
    return spark.readStream.format("socket").option("host", host).option("port", str(port)).load()
