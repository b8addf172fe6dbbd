"""Kafka topic as a stream of UTF-8 text values.

The Kafka connector is not bundled with PySpark; ``read_kafka_text`` needs
the ``spark-sql-kafka`` package on the classpath.  ``kafka_options`` is the
tested part: earliest offsets, value only, no consumer group pinned (Spark
tracks offsets in the checkpoint).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def kafka_options(
    bootstrap_servers: str, topic: str, starting_offsets: str = "earliest", group_id: str | None = None
) -> dict[str, str]:
    opts = {
        "kafka.bootstrap.servers": bootstrap_servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
    }
    if group_id:
        opts["kafka.group.id"] = group_id
    return opts


def read_kafka_text(spark: SparkSession, bootstrap_servers: str, topic: str, **kw) -> DataFrame:
    """``value STRING`` rows from a Kafka topic."""
    reader = spark.readStream.format("kafka")
    for key, value in kafka_options(bootstrap_servers, topic, **kw).items():
        reader = reader.option(key, value)
    return reader.load().select(F.col("value").cast("string").alias("value"))
