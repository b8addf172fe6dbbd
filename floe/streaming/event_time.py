"""Event time and watermarks for streams, and the filter guard.

A filter that does not mention the event-time column is pushed below
``withWatermark`` by Catalyst, so rows it removes no longer advance the
watermark: a stream whose newest rows are all filtered out never closes its
windows.  ``guarded_filter`` mentions the event-time column inside the
predicate, which keeps the filter above the watermark -- the watermark is
assigned first, as the job declares.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from floe.functions.time import ntz_to_instant


def with_event_time(
    df: DataFrame, ts_col: str = "ts", delay: str = "0 seconds", from_ntz: bool = True
) -> DataFrame:
    """Event time on ``ts_col`` with a bounded-out-of-orderness watermark
    (``0 seconds`` = ascending / monotonous timestamps)."""
    if from_ntz:
        df = df.withColumn(ts_col, ntz_to_instant(F.col(ts_col)))
    return df.withWatermark(ts_col, delay)


def guarded_filter(df: DataFrame, predicate: Column, ts_col: str = "ts") -> DataFrame:
    """``filter(predicate)`` that stays above the watermark."""
    guarded = F.when(F.col(ts_col).isNotNull(), predicate).otherwise(F.lit(False))
    return df.where(guarded)
