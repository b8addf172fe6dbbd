"""Delimited text lines -> typed rows.

Two modes:

* ``strict``: ANSI casts; a malformed line fails the job (the original
  behaviour for a non-number).
* ``permissive``: ``try_cast`` and bounds-safe ``get``; lines that do not
  parse go to a quarantine frame with a reason instead of failing the job.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Parsed:
    valid: DataFrame
    quarantine: DataFrame


def _fields(line: Column, sep: str) -> Column:
    return F.split(line, sep)


def parse_delimited(
    lines: DataFrame,
    schema: T.StructType,
    line_col: str = "value",
    sep: str = ",",
    mode: str = "permissive",
    keep: tuple[str, ...] = (),
) -> Parsed:
    """Split ``line_col`` on ``sep`` (a regex) and type the fields by position.

    In ``permissive`` mode a line is valid when it has exactly ``len(schema)``
    fields and every field casts to its type; ``strict`` mode takes the first
    ``len(schema)`` fields of any line and fails the job on a field that does
    not cast.  ``quarantine`` keeps the raw line and a ``reason``
    (``wrong_arity`` or ``bad_value``).
    """
    arr = _fields(F.col(line_col), sep)
    n = len(schema.fields)
    if mode == "strict":
        typed = [arr.getItem(i).cast(f.dataType).alias(f.name) for i, f in enumerate(schema.fields)]
        valid = lines.select(*keep, *typed)
        empty = lines.where(F.lit(False)).select(*keep, F.col(line_col), F.lit("").alias("reason"))
        return Parsed(valid, empty)

    # Parse once per line into a struct.  The valid/quarantine split is a
    # generator (explode of a 0- or 1-element array) rather than a filter: a
    # filter on the parsed fields would be pushed below the projection with
    # the parse inlined once per predicate, re-splitting every line ~n times.
    typed = [F.get(arr, i).try_cast(f.dataType).alias(f.name) for i, f in enumerate(schema.fields)]
    staged = lines.select(
        *keep, F.col(line_col), F.struct(F.size(arr).alias("_n"), *typed).alias("_r")
    )
    all_typed = F.lit(True)
    for f in schema.fields:
        all_typed = all_typed & F.col("_r").getField(f.name).isNotNull()
    arity_ok = F.col("_r").getField("_n") == n
    record = F.struct(*[F.col("_r").getField(f.name).alias(f.name) for f in schema.fields])
    valid = staged.select(
        *keep,
        F.explode(F.when(arity_ok & all_typed, F.array(record)).otherwise(F.array())).alias("_v"),
    ).select(*keep, *[F.col("_v").getField(f.name).alias(f.name) for f in schema.fields])
    reason = F.when(~arity_ok, F.lit("wrong_arity")).when(~all_typed, F.lit("bad_value"))
    bad_row = F.struct(F.col(line_col).alias(line_col), reason.alias("reason"))
    bad = staged.select(
        *keep,
        F.explode(F.when(reason.isNotNull(), F.array(bad_row)).otherwise(F.array())).alias("_b"),
    ).select(*keep, F.col("_b").getField(line_col).alias(line_col), F.col("_b.reason").alias("reason"))
    return Parsed(valid, bad)


def parse_lines(
    lines: DataFrame, parser: Callable[[Column], list[Column]], arity: int, line_col: str = "value", sep: str = ",", keep: tuple[str, ...] = ()
) -> Parsed:
    """Lines through one of the line parsers below, each line parsed once.

    A line with another number of fields, or with a field that does not parse,
    goes to the quarantine with its reason, like in ``parse_delimited``.
    """
    columns = lines.select(*parser(F.col(line_col))).columns
    staged = lines.select(
        *keep, F.col(line_col), F.struct(F.size(_fields(F.col(line_col), sep)).alias("_n"), *parser(F.col(line_col))).alias("_r")
    )
    whole = F.lit(True)
    for c in columns:
        whole = whole & F.col("_r").getField(c).isNotNull()
    reason = F.when(F.col("_r").getField("_n") != arity, F.lit("wrong_arity")).when(~whole, F.lit("bad_value"))
    record = F.struct(*[F.col("_r").getField(c).alias(c) for c in columns])
    out = F.struct(F.when(reason.isNull(), record).alias("ok"), reason.alias("reason"))
    once = staged.select(*keep, F.col(line_col), F.explode(F.array(out)).alias("_o"))
    valid = once.where("_o.reason IS NULL").select(*keep, *[F.col("_o.ok").getField(c).alias(c) for c in columns])
    bad = once.where("_o.reason IS NOT NULL").select(*keep, F.col(line_col), F.col("_o.reason").alias("reason"))
    return Parsed(valid, bad)


def parse_ticks(line: Column) -> list[Column]:
    """``"sym,millis,price"`` -> symbol, event time, price."""
    arr = _fields(line, ",")
    return [
        F.get(arr, 0).alias("symbol"),
        F.timestamp_millis(F.get(arr, 1).try_cast("bigint")).alias("ts"),
        F.get(arr, 2).try_cast("double").alias("price"),
    ]


def parse_prices(line: Column) -> list[Column]:
    """``"millis,price"`` -> event time, price as text, price."""
    arr = _fields(line, ",")
    return [
        F.timestamp_millis(F.get(arr, 0).try_cast("bigint")).alias("ts"),
        F.get(arr, 1).alias("price_text"),
        F.get(arr, 1).try_cast("double").alias("price"),
    ]


def parse_numbers(line: Column) -> list[Column]:
    """``"millis,int"`` -> event time, number."""
    arr = _fields(line, ",")
    return [
        F.timestamp_millis(F.get(arr, 0).try_cast("bigint")).alias("ts"),
        F.get(arr, 1).try_cast("int").alias("number"),
    ]


def parse_sales(line: Column) -> list[Column]:
    """Sales line ``date,month,category,product,profit``: the date is dropped
    and a count of 1 is appended for the later sum."""
    arr = _fields(line, ",")
    return [
        F.get(arr, 1).alias("month"),
        F.get(arr, 2).alias("category"),
        F.get(arr, 3).alias("product"),
        F.get(arr, 4).try_cast("int").alias("profit"),
        F.lit(1).alias("n"),
    ]
