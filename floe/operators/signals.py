"""Trading signals on consecutive prices of one instrument.

A signal compares the newest price with the one before it; every jump larger
than the threshold (strictly, either direction) yields one order row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from floe.operators.sequence import time_bucket, with_previous_row

# Fixed values of the order a jump produces: parent order id, action,
# quantity, limit price, take-profit price, stop-loss price.
ORDER_PARENT_ID = 1000
ORDER_ACTION = "Buy"
ORDER_QUANTITY = 1
ORDER_LIMIT_PRICE = 1.0
ORDER_TAKE_PROFIT = 1.0
ORDER_STOP_LOSS = 0.5


def price_jumps(
    ticks: DataFrame,
    key: str,
    ts_col: str,
    id_col: str,
    price_col: str,
    threshold: float = 3.0,
    bucket: Column | str = "1 hour",
) -> DataFrame:
    """``key, id, diff, direction`` and the order columns, one row per jump.

    The previous price is looked up per (key, bucket) with a hand-over
    between buckets, so a hot key is cut by time: ``bucket`` is a duration, or
    a column that does not decrease with time.

    ``diff = newest - previous``; ``direction`` is ``up`` / ``down``.  Both
    directions emit a Buy order, as the rule is written.
    """
    rows = ticks.select(key, ts_col, id_col, price_col)
    bucket = time_bucket(rows, ts_col, bucket) if isinstance(bucket, str) else bucket
    with_prev = with_previous_row(rows, [key], [ts_col, id_col], [price_col], bucket)
    return orders_from_jumps(with_prev, key, id_col, price_col, threshold)


def orders_from_jumps(with_prev: DataFrame, key: str, id_col: str, price_col: str, threshold: float) -> DataFrame:
    """Order rows of the jumps among rows that hold the previous price."""
    diff = F.col(price_col) - F.col("prev_" + price_col)
    return (
        with_prev.select(key, id_col, diff.alias("diff"))
        .where((F.col("diff") > threshold) | (F.col("diff") < -threshold))
        .select(
            key,
            id_col,
            "diff",
            F.when(F.col("diff") > 0, F.lit("up")).otherwise(F.lit("down")).alias("direction"),
            F.lit(ORDER_PARENT_ID).alias("parent_order_id"),
            F.lit(ORDER_ACTION).alias("action"),
            F.lit(ORDER_QUANTITY).alias("quantity"),
            F.lit(ORDER_LIMIT_PRICE).alias("limit_price"),
            F.lit(ORDER_TAKE_PROFIT).alias("take_profit"),
            F.lit(ORDER_STOP_LOSS).alias("stop_loss"),
        )
    )
