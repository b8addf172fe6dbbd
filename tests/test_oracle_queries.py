"""Every registered query with an oracle must equal DuckDB at sf0.01."""

import pytest

from tests.conftest import SF01

import __spark_entry__ as contract
from floe.plans import REGISTRY
from tests.oracle import compare

#: The other package's queries are compared in its own tests.
ORACLES = {name: q.oracle for name, q in REGISTRY.items() if q.oracle}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, name):
    df = REGISTRY[name].build(spark, SF01)
    report = compare(df, ORACLES[name], SF01)
    assert report["ok"], report


def test_every_query_has_a_plan(spark):
    for name, q in REGISTRY.items():
        if not name.startswith("stream_"):
            assert q.build(spark, "/root/testdata/sf0.001").schema.fields, name


def test_entry_smoke(spark):
    df = contract.entry(spark)
    assert df.count() > 0
