"""Regression and ratio-estimate queries over lineitem points."""

from __future__ import annotations

from pyspark.sql import functions as F

from floe.operators.iteration import iterate, sign_step
from floe.operators.ratio import indicator_ratio, inside_unit_circle, unit_hash
from floe.operators.regression import (
    DEFAULT_ITERATIONS,
    LEARNING_RATE,
    descend,
    gd_step,
    gd_step_with_params,
    generated_points,
    normal_draw,
    round_theta,
)
from floe.plans.registry import query
from floe.sources.tables import read_table

# lineitem as regression points: x = quantity / 50, y = extendedprice / 100000
GIVEN_THETA = (0.25, 1.75)
_POINTS_SQL = "(SELECT l_quantity / 50 AS x, l_extendedprice / 100000 AS y FROM lineitem)"


def lineitem_points(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem", ["l_quantity", "l_extendedprice"])
    return li.select(
        (F.col("l_quantity") / 50).alias("x"), (F.col("l_extendedprice") / 100000).alias("y")
    )


def _step_sql(t0: float, t1: float) -> str:
    r = f"{LEARNING_RATE}::DOUBLE"
    err = f"(({t0}::DOUBLE + {t1}::DOUBLE * x) - y)"
    return f"""
    SELECT round(avg({t0}::DOUBLE - {r} * {err}), 6) AS theta0,
           round(avg({t1}::DOUBLE - {r} * ({err} * x)), 6) AS theta1
    FROM {_POINTS_SQL}
    """


@query("gd_step", oracle=_step_sql(*GIVEN_THETA))
def q_gd_step(spark, sf_dir):
    pts = lineitem_points(spark, sf_dir)
    return round_theta(gd_step(pts, F.lit(GIVEN_THETA[0]), F.lit(GIVEN_THETA[1])))


@query("broadcast_params", oracle=_step_sql(*GIVEN_THETA))
def q_broadcast_params(spark, sf_dir):
    pts = lineitem_points(spark, sf_dir)
    params = spark.createDataFrame([GIVEN_THETA], "theta0 double, theta1 double")
    return round_theta(gd_step_with_params(pts, params))


@query(
    "gd_lineitem",
    headline=True,
    oracle=f"""
    WITH RECURSIVE m AS (
        SELECT avg(x) AS mx, avg(y) AS my, avg(x * x) AS mxx, avg(x * y) AS mxy FROM {_POINTS_SQL}),
    it(i, t0, t1) AS (
        SELECT 0, 0.0::DOUBLE, 0.0::DOUBLE
        UNION ALL
        SELECT i + 1,
               t0 - {LEARNING_RATE}::DOUBLE * (t0 + t1 * mx - my),
               t1 - {LEARNING_RATE}::DOUBLE * (t0 * mx + t1 * mxx - mxy)
        FROM it JOIN m ON true WHERE i < {DEFAULT_ITERATIONS})
    SELECT round(t0, 6) AS theta0, round(t1, 6) AS theta1 FROM it WHERE i = {DEFAULT_ITERATIONS}
    """,
)
def q_gd_lineitem(spark, sf_dir):
    return round_theta(descend(lineitem_points(spark, sf_dir), DEFAULT_ITERATIONS))


# ---- indicator ratio (circle estimate) ---------------------------------------
# Points come from the row's integer keys through a multiplicative hash, so
# the estimate is deterministic and reproducible in SQL.

_X_TERMS = (("l_orderkey", 7919), ("l_linenumber", 104729), ("l_partkey", 611953))
_Y_TERMS = (("l_orderkey", 999983), ("l_suppkey", 15773), ("l_linenumber", 27449))
_X_MOD, _Y_MOD = 1000003, 1000033


def _hash_sql(terms, mod):
    s = " + ".join(f"CAST({c} AS BIGINT) * {m}" for c, m in terms)
    return f"(({s}) % {mod}) / {mod}::DOUBLE"


@query(
    "ratio_pi",
    headline=True,
    oracle=f"""
    SELECT CAST(sum(CASE WHEN x * x + y * y < 1 THEN 1 ELSE 0 END) AS BIGINT) AS hits,
           count(*) AS n,
           4.0::DOUBLE * CAST(sum(CASE WHEN x * x + y * y < 1 THEN 1 ELSE 0 END) AS BIGINT) / count(*) AS ratio
    FROM (SELECT {_hash_sql(_X_TERMS, _X_MOD)} AS x, {_hash_sql(_Y_TERMS, _Y_MOD)} AS y FROM lineitem)
    """,
)
def q_ratio_pi(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"])
    x = unit_hash(*[(F.col(c), m) for c, m in _X_TERMS], modulus=_X_MOD)
    y = unit_hash(*[(F.col(c), m) for c, m in _Y_TERMS], modulus=_Y_MOD)
    pts = li.select(x.alias("x"), y.alias("y"))
    return indicator_ratio(pts, inside_unit_circle(F.col("x"), F.col("y")), scale=4.0)




# A second estimate from other key combinations (other seeds of the hash).
_SEEDED_X = (("l_orderkey", 15485863), ("l_suppkey", 32452843), ("l_linenumber", 49979687))
_SEEDED_Y = (("l_partkey", 67867967), ("l_orderkey", 86028121), ("l_linenumber", 104395301))


@query(
    "ratio_seeded",
    oracle=f"""
    SELECT CAST(sum(CASE WHEN x * x + y * y < 1 THEN 1 ELSE 0 END) AS BIGINT) AS hits,
           count(*) AS n,
           4.0::DOUBLE * CAST(sum(CASE WHEN x * x + y * y < 1 THEN 1 ELSE 0 END) AS BIGINT) / count(*) AS ratio
    FROM (SELECT {_hash_sql(_SEEDED_X, _X_MOD)} AS x, {_hash_sql(_SEEDED_Y, _Y_MOD)} AS y FROM lineitem)
    """,
)
def q_ratio_seeded(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"])
    x = unit_hash(*[(F.col(c), m) for c, m in _SEEDED_X], modulus=_X_MOD)
    y = unit_hash(*[(F.col(c), m) for c, m in _SEEDED_Y], modulus=_Y_MOD)
    pts = li.select(x.alias("x"), y.alias("y"))
    return indicator_ratio(pts, inside_unit_circle(F.col("x"), F.col("y")), scale=4.0)


# ---- generated points -----------------------------------------------------------
# Normal draws from two hashed uniforms of the row's keys, rounded to two
# decimals, so the points are the same in every engine.

_U1, _U2 = _hash_sql(_X_TERMS, _X_MOD), _hash_sql(_Y_TERMS, _Y_MOD)
_V1, _V2 = _hash_sql(_SEEDED_X, _X_MOD), _hash_sql(_SEEDED_Y, _Y_MOD)
_GENERATED_SQL = f"""
    (SELECT round(gx, 2) AS x, round(2.0::DOUBLE * gx + 0.01::DOUBLE * ge, 2) AS y
     FROM (SELECT sqrt(-2.0::DOUBLE * ln(1.0::DOUBLE - {_U1})) * cos(2.0::DOUBLE * pi() * {_U2}) AS gx,
                  sqrt(-2.0::DOUBLE * ln(1.0::DOUBLE - {_V1})) * cos(2.0::DOUBLE * pi() * {_V2}) AS ge FROM lineitem))
"""


@query(
    "gd_synthetic",
    oracle=f"""
    WITH RECURSIVE m AS (
        SELECT avg(x) AS mx, avg(y) AS my, avg(x * x) AS mxx, avg(x * y) AS mxy FROM {_GENERATED_SQL}),
    it(i, t0, t1) AS (
        SELECT 0, 0.0::DOUBLE, 0.0::DOUBLE
        UNION ALL
        SELECT i + 1,
               t0 - {LEARNING_RATE}::DOUBLE * (t0 + t1 * mx - my),
               t1 - {LEARNING_RATE}::DOUBLE * (t0 * mx + t1 * mxx - mxy)
        FROM it JOIN m ON true WHERE i < {DEFAULT_ITERATIONS})
    SELECT round(t0, 6) AS theta0, round(t1, 6) AS theta1 FROM it WHERE i = {DEFAULT_ITERATIONS}
    """,
)
def q_gd_synthetic(spark, sf_dir):
    """One generated point per lineitem row, fitted by descent."""
    li = read_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"])

    def uniform(terms, mod):
        return unit_hash(*[(F.col(c), m) for c, m in terms], modulus=mod)

    gx = normal_draw(uniform(_X_TERMS, _X_MOD), uniform(_Y_TERMS, _Y_MOD))
    ge = normal_draw(uniform(_SEEDED_X, _X_MOD), uniform(_SEEDED_Y, _Y_MOD))
    return round_theta(descend(generated_points(li, gx, ge), DEFAULT_ITERATIONS))


# ---- iteration whose update needs the data in every round -------------------------

SIGN_ROUNDS, SIGN_RATE = 8, 0.5


@query(
    "gd_sign_steps",
    oracle=f"""
    WITH RECURSIVE pts AS (SELECT l_quantity::DOUBLE AS x, l_extendedprice::DOUBLE / 1000 AS y FROM lineitem),
    it(i, theta0, theta1) AS (
      SELECT 0, 0.0::DOUBLE, 0.0::DOUBLE
      UNION ALL
      SELECT i + 1, any_value(theta0) + sum(sign(y - (theta0 + theta1 * x))::DOUBLE) * ({SIGN_RATE}::DOUBLE / count(*)),
             any_value(theta1) + sum(sign(y - (theta0 + theta1 * x))::DOUBLE * x) * ({SIGN_RATE}::DOUBLE / count(*))
      FROM it, pts WHERE i < {SIGN_ROUNDS} GROUP BY i)
    SELECT round(theta0, 9) AS theta0, round(theta1, 9) AS theta1 FROM it WHERE i = {SIGN_ROUNDS}
    """,
)
def q_gd_sign_steps(spark, sf_dir):
    """A line through lineitem points, fitted by clipped steps: eight passes over the data."""
    li = read_table(spark, sf_dir, "lineitem", ["l_quantity", "l_extendedprice"])
    pts = li.select(F.col("l_quantity").cast("double").alias("x"), (F.col("l_extendedprice").cast("double") / 1000).alias("y"))
    start = spark.createDataFrame([(0.0, 0.0)], "theta0 double, theta1 double")
    return round_theta(iterate(start, sign_step(pts, SIGN_RATE), SIGN_ROUNDS), 9)
