"""Linear regression ``y = theta0 + theta1 * x`` by batch gradient descent.

Every round replaces theta by the mean over all points of
``theta - rate * err * (1, x)`` with ``err = theta0 + theta1 * x - y``.  That
mean only depends on ``mean(x), mean(y), mean(x*x), mean(x*y)``, so the
whole descent is one aggregation pass over the points (partial aggregates
per task, one tiny final row) followed by a fold of ``iterations`` steps on
that single row -- no job per round, no data re-read.

``gd_step`` is the literal per-point form of one round, kept as the check.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Learning rate, default rounds, starting parameters.
LEARNING_RATE = 0.01
DEFAULT_ITERATIONS = 10
INITIAL_THETA = (0.0, 0.0)


def moments(points: DataFrame, x: str = "x", y: str = "y") -> DataFrame:
    """One row: ``n, mx, my, mxx, mxy``."""
    X, Y = F.col(x), F.col(y)
    return points.agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(X).alias("mx"),
        F.avg(Y).alias("my"),
        F.avg(X * X).alias("mxx"),
        F.avg(X * Y).alias("mxy"),
    )


def _step(theta: Column, rate: float) -> Column:
    t0, t1 = theta.getField("theta0"), theta.getField("theta1")
    mx, my, mxx, mxy = F.col("mx"), F.col("my"), F.col("mxx"), F.col("mxy")
    return F.struct(
        (t0 - F.lit(rate) * (t0 + t1 * mx - my)).alias("theta0"),
        (t1 - F.lit(rate) * (t0 * mx + t1 * mxx - mxy)).alias("theta1"),
    )


def descend(
    points: DataFrame,
    iterations: int = DEFAULT_ITERATIONS,
    theta: tuple[float, float] = INITIAL_THETA,
    rate: float = LEARNING_RATE,
    x: str = "x",
    y: str = "y",
) -> DataFrame:
    """``theta0, theta1`` after ``iterations`` rounds (one row)."""
    start = F.struct(F.lit(float(theta[0])).alias("theta0"), F.lit(float(theta[1])).alias("theta1"))
    if iterations <= 0:
        final = start
    else:
        final = F.aggregate(
            F.sequence(F.lit(1), F.lit(int(iterations))), start, lambda acc, _: _step(acc, rate)
        )
    return moments(points, x, y).select(
        final.getField("theta0").alias("theta0"), final.getField("theta1").alias("theta1")
    )


def gd_step(
    points: DataFrame,
    theta0: Column,
    theta1: Column,
    rate: float = LEARNING_RATE,
    x: str = "x",
    y: str = "y",
) -> DataFrame:
    """One round in its literal form: per-point update, then the mean."""
    err = (theta0 + theta1 * F.col(x)) - F.col(y)
    return points.agg(
        F.avg(theta0 - F.lit(rate) * err).alias("theta0"),
        F.avg(theta1 - F.lit(rate) * (err * F.col(x))).alias("theta1"),
    )


def gd_step_with_params(
    points: DataFrame, params: DataFrame, rate: float = LEARNING_RATE, x: str = "x", y: str = "y"
) -> DataFrame:
    """One round with theta read from a parameter frame.

    The parameters enter as scalar subqueries: evaluated once, shipped to
    every task as a constant, and an error if the frame has no row or more
    than one (no cross join, no driver round trip).
    """
    theta = params.select(F.struct("theta0", "theta1")).scalar()
    missing = F.raise_error(F.lit("the parameter frame has no row")).cast("struct<theta0:double,theta1:double>")
    theta = F.when(theta.isNotNull(), theta).otherwise(missing)
    return gd_step(points, theta.getField("theta0"), theta.getField("theta1"), rate, x, y)


def round_theta(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.select(
        F.round("theta0", digits).alias("theta0"), F.round("theta1", digits).alias("theta1")
    )


def synthetic_points(rows: DataFrame, seed: int = 0, slope: float = 2.0, noise: float = 0.01) -> DataFrame:
    """One generated point per input row: ``x ~ N(0,1)``,
    ``y = slope * x + noise * N(0,1)``, both kept to two decimals."""
    gx = F.randn(seed)
    gy = F.randn(seed + 1)
    raw = rows.select(gx.alias("_x"), gy.alias("_e"))
    return raw.select(
        F.round("_x", 2).alias("x"),
        F.round(F.lit(slope) * F.col("_x") + F.lit(noise) * F.col("_e"), 2).alias("y"),
    )


def normal_draw(u1: Column, u2: Column) -> Column:
    """A normal draw from two uniforms of [0, 1)."""
    return F.sqrt(F.lit(-2.0) * F.ln(F.lit(1.0) - u1)) * F.cos(F.lit(2.0) * F.pi() * u2)


def generated_points(rows: DataFrame, gx: Column, ge: Column, slope: float = 2.0, noise: float = 0.01) -> DataFrame:
    """One point per input row from two normal draws: ``x = gx``, ``y = slope * gx + noise * ge``, two decimals each."""
    raw = rows.select(gx.alias("_x"), ge.alias("_e"))
    return raw.select(
        F.round("_x", 2).alias("x"),
        F.round(F.lit(slope) * F.col("_x") + F.lit(noise) * F.col("_e"), 2).alias("y"),
    )


def point_line(x: Column, y: Column) -> Column:
    """``x y`` with two decimals, space separated."""
    return F.concat_ws(" ", F.format_string("%.2f", x), F.format_string("%.2f", y))


def render_points(points: DataFrame) -> DataFrame:
    """Space-separated text lines ``x y`` with two decimals."""
    return points.select(point_line(F.col("x"), F.col("y")).alias("value"))
