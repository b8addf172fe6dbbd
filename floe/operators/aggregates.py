"""Mergeable aggregates.

Each aggregate is described by an expression over raw rows (``partial``) and
how two partial results combine (``merge``).  Spark already splits every
built-in aggregate into partial/final around the shuffle; the explicit merge
is what lets the sliding-window builder pre-aggregate rows into slide-sized
panes once and then combine panes into windows (``operators.windows``).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Mergeable:
    name: str
    partial: Column
    merge: Callable[[Column], Column]


def count_rows(name: str = "n") -> Mergeable:
    return Mergeable(name, F.count(F.lit(1)), F.sum)


def sum_of(expr: Column, name: str) -> Mergeable:
    return Mergeable(name, F.sum(expr), F.sum)


def min_of(expr: Column, name: str) -> Mergeable:
    return Mergeable(name, F.min(expr), F.min)


def max_of(expr: Column, name: str) -> Mergeable:
    return Mergeable(name, F.max(expr), F.max)


def min_struct(name: str, *fields: Column) -> Mergeable:
    """Smallest struct by field order: an exact, mergeable arg-min with ties
    broken by the later fields (arg-max by negating the first field)."""
    return Mergeable(name, F.min(_positional_struct(fields)), F.min)


def _positional_struct(fields) -> Column:
    """Struct with fields named ``_0, _1, ...`` (compared left to right)."""
    return F.struct(*[f.alias(f"_{i}") for i, f in enumerate(fields)])
