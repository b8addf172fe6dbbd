"""Declared schemas.  Nothing is inferred: every source takes one of these.

The nested match record is declared once as a tree of ``(type, default)``
leaves; both its ``StructType`` and the expression that fills missing or
null leaves with their defaults are generated from that one tree.
"""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- flat record schemas ----------------------------------------------------

CLICKS = T.StructType(
    [
        T.StructField("user_id", T.LongType()),
        T.StructField("item_id", T.LongType()),
        T.StructField("category_id", T.IntegerType()),
        T.StructField("behavior", T.StringType()),
        T.StructField("ts_seconds", T.LongType()),
    ]
)
SALES = "sale_date STRING, month STRING, category STRING, product STRING, profit INT"
POINTS = "x DOUBLE, y DOUBLE"
PARAMS = "theta0 DOUBLE, theta1 DOUBLE"
# --- nested match record ----------------------------------------------------

# Declared defaults of the match record's leaves.
UNKNOWN = "unknown"
_GOALS = {"home": ("int", 0), "away": ("int", 0)}
_TEAM = {
    "id": ("int", 0),
    "name": ("string", UNKNOWN),
    "logo": ("string", UNKNOWN),
    "winner": ("boolean", False),
}
MATCH_TREE: dict[str, Any] = {
    "fixture": {
        "id": ("int", -1),
        "referee": ("string", UNKNOWN),
        "timezone": ("string", UNKNOWN),
        "date": ("string", UNKNOWN),
        "timestamp": ("int", -1),
        "periods": {"first": ("int", -1), "second": ("int", -1)},
        "venue": {"id": ("int", -1), "name": ("string", UNKNOWN), "city": ("string", UNKNOWN)},
        "status": {"long": ("string", UNKNOWN), "short": ("string", UNKNOWN), "elapsed": ("int", -1)},
    },
    "league": {
        "id": ("int", -1),
        "name": ("string", UNKNOWN),
        "country": ("string", UNKNOWN),
        "logo": ("string", UNKNOWN),
        "flag": ("string", UNKNOWN),
        "season": ("int", -1),
        "round": ("string", UNKNOWN),
    },
    "teams": {"home": _TEAM, "away": _TEAM},
    "goals": _GOALS,
    "score": {"halftime": _GOALS, "fulltime": _GOALS, "extratime": _GOALS, "penalty": _GOALS},
}

_LEAF_TYPES = {
    "int": T.IntegerType(),
    "long": T.LongType(),
    "string": T.StringType(),
    "boolean": T.BooleanType(),
    "double": T.DoubleType(),
}


def schema_of(tree: dict[str, Any]) -> T.StructType:
    fields = []
    for name, node in tree.items():
        if isinstance(node, dict):
            fields.append(T.StructField(name, schema_of(node)))
        else:
            fields.append(T.StructField(name, _LEAF_TYPES[node[0]]))
    return T.StructType(fields)


def fill_defaults(col: Column, tree: dict[str, Any]) -> Column:
    """Rebuild the struct ``col`` with every missing or null leaf replaced by
    its declared default; a missing sub-struct becomes all defaults."""
    parts = []
    for name, node in tree.items():
        child = col.getField(name)
        if isinstance(node, dict):
            parts.append(fill_defaults(child, node).alias(name))
        else:
            kind, default = node
            parts.append(F.coalesce(child, F.lit(default).cast(_LEAF_TYPES[kind])).alias(name))
    return F.struct(*parts)


MATCH = schema_of(MATCH_TREE)
