"""Named queries: each is a Spark plan over the test-data tables plus, where
the semantics are SQL-expressible, the equivalent DuckDB SQL used as oracle."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    build: QueryFn
    oracle: str | None
    headline: bool


REGISTRY: dict[str, Query] = {}


def query(name: str, oracle: str | None = None, headline: bool = False):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name``."""

    def wrap(fn: QueryFn) -> QueryFn:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, fn, oracle, headline)
        return fn

    return wrap
