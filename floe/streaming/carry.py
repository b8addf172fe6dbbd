"""Streams that carry a table from micro-batch to micro-batch, as DataFrame steps.

Structured Streaming has no window functions over a stream.  Here the rows
that a streaming plan emits are written once per micro-batch; a batch step
then reads them together with a small keyed table (the last row of every key,
running totals, ...) and returns the output rows and the next table.  Output
and tables are Parquet folders named after the batch id and overwritten if the
batch is run again, so a restart, a retry or a lost executor gives the same rows.
No Python runs per row, and no group of rows is held in memory.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from floe.operators.sequence import with_previous_row
from floe.session import scratch_path
from floe.streaming.runner import finish, scoped_start

#: (rows of the micro-batch, carried table) -> (output rows, next table).
Step = Callable[[DataFrame, DataFrame], tuple[DataFrame, DataFrame]]


def run_carried(
    spark: SparkSession,
    stream: DataFrame,
    name: str,
    table: T.StructType,
    step: Step,
    output_mode: str = "append",
    location: str | None = None,
    state_partitions: int | None = None,
    keep: int = 2,
) -> str:
    """Run ``stream`` to the end of its input; returns the sink directory.

    ``table`` is the schema of the carried table, empty before the first
    batch.  ``location`` reuses sink, tables and checkpoint of an earlier run.
    ``keep`` (2 at least: a batch run again reads the table before it) is how many batches' rows and tables
    stay; older ones are removed, so a stream without end holds a bounded number of them.
    """
    base = location or scratch_path(spark, f"stream-{name}")
    jvm = spark.sparkContext._jvm
    fs = jvm.org.apache.hadoop.fs.Path(base).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def write(batch: DataFrame, batch_id: int) -> None:
        # Written first: a second look at the batch would run its stateful plan again.
        rows_path = f"{base}/rows/batch={batch_id}"
        batch.write.mode("overwrite").parquet(rows_path)
        rows = spark.read.schema(batch.schema).parquet(rows_path)
        carried = spark.read.schema(table).parquet(f"{base}/table/batch={batch_id - 1}") if batch_id else spark.createDataFrame([], table)
        out, then = step(rows, carried)
        then.write.mode("overwrite").parquet(f"{base}/table/batch={batch_id}")
        out.write.mode("overwrite").parquet(f"{base}/out/batch={batch_id}")
        for part in ("rows", "table"):
            fs.delete(jvm.org.apache.hadoop.fs.Path(f"{base}/{part}/batch={batch_id - max(keep, 2)}"), True)

    with scoped_start(spark, state_partitions):
        query = (
            stream.writeStream.outputMode(output_mode)
            .foreachBatch(write)
            .option("checkpointLocation", f"{base}/_checkpoint")
            .trigger(availableNow=True)
            .start()
        )
        finish(query, name)
    return f"{base}/out"


def with_last_rows(key: str, order_cols: Sequence[str], carry: Sequence[str], look_back: Callable[[DataFrame], DataFrame]) -> Step:
    """A step that sees, per key, the last row of all earlier batches.

    ``look_back`` gets the batch's rows and those last rows (``is_new``
    false); it returns output rows, of which those of earlier batches are dropped.  The
    carried table holds key, ``order_cols`` and ``carry``: one row per key.
    Rows of a later batch must come later in ``order_cols``, as append mode gives them.
    """
    kept = [*order_cols, *[c for c in carry if c not in order_cols]]

    def step(rows: DataFrame, last: DataFrame) -> tuple[DataFrame, DataFrame]:
        both = rows.withColumn("is_new", F.lit(True)).unionByName(last.withColumn("is_new", F.lit(False)), allowMissingColumns=True)
        out = look_back(both).where("is_new").drop("is_new")
        latest = both.groupBy(key).agg(F.max(F.struct(*kept)).alias("last"))
        return out, latest.select(key, *[F.col(f"last.{c}").alias(c) for c in kept])

    return step


def last_rows_schema(rows: DataFrame, key: str, order_cols: Sequence[str], carry: Sequence[str]) -> T.StructType:
    names = [key, *order_cols, *[c for c in carry if c not in order_cols]]
    return T.StructType([T.StructField(c, rows.schema[c].dataType) for c in names])


def ordered_rows(stream: DataFrame, ts_col: str) -> DataFrame:
    """The stream's rows, each held in the state store until the watermark passes it.

    Rows may come out of order within the watermark's delay; a micro-batch
    gives the rows up to the watermark, and later ones only later rows.
    Repeated rows keep their number; rows behind the watermark are dropped.
    """
    counted = stream.groupBy(*[F.col(c) for c in stream.columns]).agg(F.count(F.lit(1)).alias("_copies"))
    return counted.select(*stream.columns, F.explode(F.array_repeat(F.lit(1), F.col("_copies").cast("int"))).alias("_copy")).drop("_copy")


def previous_rows(keys: Sequence[str], order_cols: Sequence[str], carry: Sequence[str], bucket: Callable[[DataFrame], object]):
    """``look_back`` by ``with_previous_row``."""
    return lambda both: with_previous_row(both, list(keys), list(order_cols), list(carry), bucket(both))


def running_totals(keys: Sequence[str], sums: Sequence[str], ttl: str) -> tuple[Callable[[DataFrame], T.StructType], Step]:
    """Running sums per key for streams without a watermark: the carried table is bounded by a time to live.

    Returns (schema of the carried table from the rows' frame, step).  Rows
    hold ``keys`` and ``sums`` (any number a key); a batch's output is the new total of every key it
    touches.  A key that no batch touches for ``ttl`` of wall-clock time
    leaves the table, and starts anew if it comes back.  Null keys are a key of their own.
    """

    def schema(rows: DataFrame) -> T.StructType:
        kept = [T.StructField(c, rows.schema[c].dataType) for c in [*keys, *sums]]
        return T.StructType([*kept, T.StructField("touched", T.TimestampType())])

    def step(rows: DataFrame, table: DataFrame) -> tuple[DataFrame, DataFrame]:
        now = F.current_timestamp()
        alive = table.where(F.col("touched") >= now - F.expr(f"INTERVAL {ttl}"))
        both = rows.select(*keys, *sums, now.alias("touched"), F.lit(True).alias("is_new")).unionByName(alive.withColumn("is_new", F.lit(False)))
        types = table.schema
        totals = both.groupBy(*keys).agg(
            *[F.sum(c).cast(types[c].dataType).alias(c) for c in sums], F.max("touched").alias("touched"), F.max("is_new").alias("is_new")
        )
        return totals.where("is_new").select(*keys, *sums), totals.select(*types.names)

    return schema, step


def last_totals(outputs: DataFrame, keys: Sequence[str], sums: Sequence[str]) -> DataFrame:
    """Of a sink of running totals, the latest of each key."""
    return outputs.groupBy(*keys).agg(F.max_by(F.struct(*sums), "batch").alias("t")).select(*keys, *[F.col(f"t.{c}").alias(c) for c in sums])
