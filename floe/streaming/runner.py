"""Run a streaming plan over everything available and read its output back.

The sink is parquet (append) under the shared checkpoint folder with its own
checkpoint, so a restarted driver or lost executor resumes exactly where the
query stopped; ``availableNow`` processes the backlog in bounded batches and
stops.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from floe.session import ROCKSDB_PROVIDER, scoped_conf, scratch_path

# RocksDB state (required by transformWithState) with changelog
# checkpointing: a commit uploads the micro-batch's changes only, and a full
# snapshot is written in the background every few batches.
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # A plan over several streams goes by the slowest of their watermarks: none of its rows is late for another's progress.
    "spark.sql.streaming.multipleWatermarkPolicy": "min",
}


def _start_conf(spark: SparkSession, state_partitions: int | None) -> dict[str, str]:
    """State provider, and the number of state partitions (fixed in the
    checkpoint at first start).  ``None`` keeps the session's setting."""
    conf = dict(STATE_CONF)
    if state_partitions:
        conf["spark.sql.shuffle.partitions"] = str(state_partitions)
    return conf


def scoped_start(spark: SparkSession, state_partitions: int | None = None):
    """The settings a stateful query is started under, restored afterwards."""
    return scoped_conf(spark, _start_conf(spark, state_partitions))


def finish(query, name: str, timeout_s: float | None = None, progress: list | None = None) -> None:
    """Wait until ``query`` has ended, or at most ``timeout_s``; raise its error.

    ``progress`` gets the query's reports, one per micro-batch (the last 100:
    ``spark.sql.streaming.numRecentProgressUpdates``)."""
    try:
        if query.awaitTermination(timeout_s) is False:
            raise TimeoutError(f"stream {name} did not finish in {timeout_s}s")
    finally:
        if progress is not None:
            progress.extend(query.recentProgress)
        if query.isActive:
            query.stop()
    if query.exception() is not None:
        raise query.exception()


def run_available(
    spark: SparkSession,
    stream: DataFrame,
    name: str,
    output_mode: str = "append",
    timeout_s: float | None = None,
    state_partitions: int | None = None,
    location: str | None = None,
    progress: list | None = None,
) -> str:
    """Run ``stream`` to the end of its input; returns the sink directory.

    Waits until the stream has ended, or at most ``timeout_s`` if given.
    ``location`` reuses a sink + checkpoint from an earlier run: the query
    resumes after the last committed micro-batch (exactly-once sink)."""
    base = location or scratch_path(spark, f"stream-{name}")
    sink, ckpt = f"{base}/out", f"{base}/_checkpoint"
    with scoped_start(spark, state_partitions):
        query = (
            stream.writeStream.format("parquet")
            .outputMode(output_mode)
            .option("path", sink)
            .option("checkpointLocation", ckpt)
            .queryName(f"{name}_{base.rsplit('-', 1)[-1]}")
            .trigger(availableNow=True)
            .start()
        )
        finish(query, name, timeout_s, progress)
    return sink


def run_to_frame(
    spark: SparkSession, stream: DataFrame, name: str, schema=None, state_partitions: int | None = None
) -> DataFrame:
    sink = run_available(spark, stream, name, state_partitions=state_partitions)
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(sink)


def run_batches(
    spark: SparkSession,
    stream: DataFrame,
    name: str,
    output_mode: str = "update",
    timeout_s: float | None = None,
    state_partitions: int | None = None,
    transform: Callable[[DataFrame], DataFrame] | None = None,
) -> str:
    """Modes a file sink cannot take (update / complete), and batch steps that
    a stream cannot (``transform``): each micro-batch is
    written by ``foreachBatch`` to its own ``batch=<id>`` folder, overwritten
    on a retry of the same batch id, so replays stay idempotent."""
    base = scratch_path(spark, f"stream-{name}")
    sink, ckpt = f"{base}/out", f"{base}/_checkpoint"

    def write(batch: DataFrame, batch_id: int) -> None:
        out = transform(batch) if transform else batch
        out.write.mode("overwrite").parquet(f"{sink}/batch={batch_id}")

    with scoped_start(spark, state_partitions):
        query = (
            stream.writeStream.outputMode(output_mode)
            .foreachBatch(write)
            .option("checkpointLocation", ckpt)
            .trigger(availableNow=True)
            .start()
        )
        finish(query, name, timeout_s)
    return sink
