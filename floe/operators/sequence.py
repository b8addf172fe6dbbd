"""Previous row of the same key in a total order, without sending a whole key
to one task.

``lag(x) OVER (PARTITION BY key ORDER BY ts)`` sorts every key in a single
task; one key holding a third of the data would stall the job.  Here the
order is cut into time buckets: the lag runs per (key, bucket), and the first
row of each bucket takes the last row of the key's previous non-empty bucket,
found among the first and last rows of all buckets.  The input is shuffled
once; a hot key spreads over as many tasks as it has buckets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from floe.functions.durations import to_micros
from floe.functions.time import ntz_micros

_BUCKET = "_bucket"


def time_bucket(df: DataFrame, ts_col: str, width: str = "1 hour") -> Column:
    """Bucket number of a timestamp: pure arithmetic, so building the plan runs no job.

    A (key, bucket) group holds what one key delivers in ``width``, however
    long the history is; pick the width by the busiest key's rate.
    """
    is_ntz = df.schema[ts_col].dataType.typeName() == "timestamp_ntz"
    micros = ntz_micros(F.col(ts_col)) if is_ntz else F.unix_micros(F.col(ts_col))
    return F.floor(micros / F.lit(float(to_micros(width))))


def with_previous_row(
    df: DataFrame,
    keys: Sequence[str],
    order_cols: Sequence[str],
    carry: Sequence[str],
    bucket: Column,
    prefix: str = "prev_",
) -> DataFrame:
    """Adds ``prev_<c>`` for every column in ``carry``: its value on the
    previous row of the same key ordered by ``order_cols``.

    ``bucket`` must be non-decreasing along ``order_cols`` within a key.
    ``order_cols`` should make the order total (append a unique id) so the
    previous row is well defined.  Null keys form a key of their own and null
    buckets come first, as in a plain ``lag``.
    """
    inner = Window.partitionBy(*keys, _BUCKET).orderBy(*order_cols)
    seen = df.withColumn(_BUCKET, bucket).select(
        *df.columns,
        *[F.lag(c).over(inner).alias(prefix + c) for c in carry],
        F.row_number().over(inner).alias("_place"),
        F.lead(F.lit(True)).over(inner).isNull().alias("_is_last"),
    )
    names = [*df.columns, *[prefix + c for c in carry]]
    # Both branches read one exchange by (key, bucket).  The edges are at most two rows of a
    # bucket: a first row's neighbour there is the last row of the key's bucket before.
    across = Window.partitionBy(*keys).orderBy(*order_cols)
    edges = seen.where((F.col("_place") == 1) | F.col("_is_last"))
    edges = edges.select(*df.columns, "_place", *[F.lag(c).over(across).alias(prefix + c) for c in carry])
    return seen.where(F.col("_place") > 1).select(*names).union(edges.where(F.col("_place") == 1).select(*names))
