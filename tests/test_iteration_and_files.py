"""Iteration with stored state, and envelope documents read as VARIANT."""

import pytest
from pyspark.sql import functions as F

from floe.functions.json import envelope_files
from floe.operators.iteration import iterate, sign_step


def test_iterate_equals_a_plain_loop(spark):
    pts = [(float(x), 2.0 * x + (x % 3) - 1) for x in range(40)]
    start = spark.createDataFrame([(0.0, 0.0)], "theta0 double, theta1 double")
    got = iterate(start, sign_step(spark.createDataFrame(pts, "x double, y double"), 0.1), 5).collect()
    t0 = t1 = 0.0
    for _ in range(5):
        pull = [(y > t0 + t1 * x) - (y < t0 + t1 * x) for x, y in pts]
        move = 0.1 / len(pts)
        t0, t1 = t0 + sum(pull) * move, t1 + sum(p * x for p, (x, _) in zip(pull, pts)) * move
    assert [tuple(r) for r in got] == [pytest.approx((t0, t1), abs=1e-12)]


def test_iterate_needs_one_row(spark):
    two = spark.createDataFrame([(0.0, 0.0), (1.0, 1.0)], "theta0 double, theta1 double")
    with pytest.raises(Exception, match="(?i)more than one row|scalar"):
        iterate(two, sign_step(spark.createDataFrame([(1.0, 1.0)], "x double, y double"), 0.1), 1).collect()


def test_envelope_documents(spark):
    docs = [
        (1, '{"response": [{"a": 1, "b": "x"}, {"b": null}, {"a": null, "c": 9}]}'),
        (2, '{"response": []}'),
        (3, '{"response": [{"a": 1}'),
        (4, '{"other": []}'),
        (5, '{"response": [{"a": 1}, {"a": "7"}]}'),
        (6, '{"response": [{"a": [1]}]}'),
        (7, None),
        (8, "[]"),
        (9, '{"response": {"a": 1}}'),
    ]
    df = spark.createDataFrame(docs, "doc int, value string")
    rows, bad = envelope_files(df, {"a": "int", "b": "string"}, keep=("doc",))
    assert sorted(map(tuple, rows.select("doc", "pos", F.coalesce("a", F.lit(-1)), F.coalesce("b", F.lit("-"))).collect())) == [
        (1, 0, 1, "x"), (1, 1, -1, "-"), (1, 2, -1, "-"),
    ]
    want = {3: "not_json", 4: "no_response", 5: "bad_leaf", 6: "bad_leaf", 7: "not_json", 8: "no_response", 9: "no_response"}
    assert {r.doc: r.reason for r in bad.collect()} == want
