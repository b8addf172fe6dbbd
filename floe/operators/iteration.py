"""Bulk iteration whose rounds each need the data: a one-row state, stored after every round."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from floe.session import scratch_path


def iterate(start: DataFrame, step: Callable[[Column], DataFrame], rounds: int) -> DataFrame:
    """``rounds`` times ``state = step(state)``, from the one-row frame ``start``.

    For updates that are not a function of fixed sums (``regression.descend``
    covers those in one pass).  ``step`` gets the state as a struct column, a scalar
    subquery that every task sees as a constant and that fails on more than
    one row; it returns the next one-row frame with the same columns.  Each round's
    row is written under the checkpoint folder, so a round is computed once and
    a plan never grows with the rounds.
    """
    spark, schema, state = start.sparkSession, start.schema, start
    for _ in range(rounds):
        now = state.select(F.struct(*schema.names)).scalar()
        path = scratch_path(spark, "iterate")
        step(now).select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema]).write.parquet(path)
        state = spark.read.schema(schema).parquet(path)
    return state


def sign_step(points: DataFrame, rate: float, x: str = "x", y: str = "y") -> Callable[[Column], DataFrame]:
    """One round of a line's fit with clipped steps: every point pulls by the sign of its error only.

    theta0 and theta1 move by ``rate`` times the mean of sign(error) and of sign(error) * x.
    """

    def step(theta: Column) -> DataFrame:
        t0, t1 = theta.getField("theta0"), theta.getField("theta1")
        pull = F.signum(F.col(y) - (t0 + t1 * F.col(x)))
        sums = points.agg(F.sum(pull).alias("s0"), F.sum(pull * F.col(x)).alias("s1"), F.count(F.lit(1)).alias("n"))
        move = F.lit(rate) / F.col("n")
        return sums.select((t0 + F.col("s0") * move).alias("theta0"), (t1 + F.col("s1") * move).alias("theta1"))

    return step
