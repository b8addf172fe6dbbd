"""Spark-vs-DuckDB comparison used by the tests (row count, schema, values)."""

from __future__ import annotations

import decimal
import math

import duckdb
import pandas as pd
from pyspark.sql import types as T

from floe.sources.tables import TABLES, table_path


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{table_path(sf_dir, name)}')"
        )
    return con


def spark_type_name(dt: T.DataType) -> str:
    if isinstance(dt, T.DecimalType):
        return f"DECIMAL({dt.precision},{dt.scale})"
    return {
        T.LongType: "BIGINT",
        T.IntegerType: "INTEGER",
        T.ShortType: "SMALLINT",
        T.DoubleType: "DOUBLE",
        T.FloatType: "FLOAT",
        T.StringType: "VARCHAR",
        T.BooleanType: "BOOLEAN",
        T.TimestampNTZType: "TIMESTAMP",
        T.TimestampType: "TIMESTAMP WITH TIME ZONE",
        T.DateType: "DATE",
    }.get(type(dt), dt.simpleString().upper())


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        if math.isnan(v):
            return (0, "")
        return (1, repr(v))
    if isinstance(v, decimal.Decimal):
        return (1, str(v.normalize()) if v == v else "nan")
    if isinstance(v, pd.Timestamp):
        return (1, v.isoformat())
    if hasattr(v, "isoformat"):
        return (1, pd.Timestamp(v).isoformat())
    if isinstance(v, (bool,)):
        return (1, str(v))
    if hasattr(v, "item"):
        return _norm(v.item())
    return (1, str(v))


def rows_of(pdf: pd.DataFrame, cols: list[str], whole: set[str] = frozenset()) -> list[tuple]:
    """Rows as comparable values; ``whole``: integer columns, which pandas holds as floats if they have nulls."""
    out = []
    for rec in pdf[cols].itertuples(index=False, name=None):
        values = [None if (not isinstance(x, (list, dict)) and pd.isna(x)) else x for x in rec]
        out.append(tuple(_norm(int(x) if c in whole and x is not None else x) for c, x in zip(cols, values)))
    out.sort()
    return out


def compare(spark_df, sql: str, sf_dir: str) -> dict:
    con = duck(sf_dir)
    rel = con.sql(sql)
    duck_types = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    dpdf = rel.df()
    spdf = spark_df.toPandas()
    s_types = {f.name: spark_type_name(f.dataType) for f in spark_df.schema.fields}
    cols = sorted(s_types)
    report = {
        "columns_match": sorted(duck_types) == cols,
        "spark_rows": len(spdf),
        "oracle_rows": len(dpdf),
        "type_mismatch": {
            c: (s_types[c], duck_types.get(c)) for c in cols if s_types[c] != duck_types.get(c)
        },
    }
    if report["columns_match"]:
        whole = {c for c, t in s_types.items() if t in ("BIGINT", "INTEGER")}
        s_rows, d_rows = rows_of(spdf, cols, whole), rows_of(dpdf, cols, whole)
        report["values_match"] = s_rows == d_rows
        if not report["values_match"]:
            diff_s = [r for r in s_rows if r not in set(d_rows)][:5]
            diff_d = [r for r in d_rows if r not in set(s_rows)][:5]
            report["sample_diff"] = {"spark_only": diff_s, "oracle_only": diff_d}
    report["ok"] = (
        report["columns_match"]
        and report["spark_rows"] == report["oracle_rows"]
        and not report["type_mismatch"]
        and report.get("values_match", False)
    )
    return report
