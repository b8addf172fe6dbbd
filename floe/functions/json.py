"""JSON text <-> nested records, and ``{"response": [...]}`` envelopes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ENVELOPE_FIELD = "response"


def parse(text: Column, schema: T.DataType) -> Column:
    """JSON text -> struct.  Unknown fields are ignored, missing ones are
    NULL, and text that is not JSON gives NULL (never an error)."""
    return F.from_json(text, schema)


def render(record: Column) -> Column:
    """Struct -> JSON text (null fields omitted)."""
    return F.to_json(record)


def envelope_schema(element: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(ENVELOPE_FIELD, T.ArrayType(element))])


def pack_envelope(elements: Column) -> Column:
    """Array of structs -> ``{"response": [...]}`` text."""
    return F.to_json(F.struct(elements.alias(ENVELOPE_FIELD)))


def explode_envelope(
    df: DataFrame, text_col: str, element: T.DataType, keep: Sequence[str] = ()
) -> DataFrame:
    """One row per array element, with its 0-based position ``pos`` and the
    element as ``item``.  Empty, absent or unparsable envelopes give no rows."""
    parsed = parse(F.col(text_col), envelope_schema(element)).getField(ENVELOPE_FIELD)
    return df.select(*keep, F.posexplode(parsed).alias("pos", "item"))


def first_of_envelope(
    df: DataFrame, text_col: str, element: T.DataType, keep: Sequence[str] = ()
) -> DataFrame:
    """The first array element as ``item``; NULL when the array is empty."""
    parsed = parse(F.col(text_col), envelope_schema(element)).getField(ENVELOPE_FIELD)
    return df.select(*keep, F.get(parsed, 0).alias("item"))


CORRUPT = "_corrupt"


def parse_envelopes(df: DataFrame, text_col: str, element: T.DataType, keep: Sequence[str] = ()) -> DataFrame:
    """``keep``, the text, ``items`` and ``bad``, parsed once per row.

    ``bad`` marks documents that are missing, are cut off or not JSON, have no
    ``response`` array, or hold a field of another type than declared; they go
    to a quarantine instead of turning into defaults."""
    schema = envelope_schema(element).add(CORRUPT, T.StringType())
    parsed = F.from_json(text_col, schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    once = df.select(*keep, text_col, F.explode(F.array(parsed)).alias("_p"))
    items = F.col(f"_p.{ENVELOPE_FIELD}")
    bad = F.col(f"_p.{CORRUPT}").isNotNull() | items.isNull()
    return once.select(*keep, text_col, items.alias("items"), bad.alias("bad"))


def undeclared_paths(text: Column, tree: dict) -> Column:
    """Paths of the fields, at every level, that the declared tree does not
    have (sorted); empty for a record that strict mode accepts, NULL for text
    that is not JSON.  Objects where the tree has a leaf are not entered."""
    doc = F.try_parse_json(text)

    def walk(node: dict, path: str) -> list[Column]:
        keys = F.map_keys(F.try_variant_get(doc, "$" + "".join(f".{p}" for p in path.split(".") if p), "map<string,variant>"))
        here = F.array_except(keys, F.array(*[F.lit(k) for k in node]))
        prefix = f"{path}." if path else ""
        out = [F.coalesce(F.transform(here, lambda k: F.concat(F.lit(prefix), k)), F.array().cast("array<string>"))]
        for name, child in node.items():
            if isinstance(child, dict):
                out += walk(child, prefix + name)
        return out

    return F.when(doc.isNotNull(), F.array_sort(F.concat(*walk(tree, ""))))


def unknown_keys(text: Column, declared: Sequence[str]) -> Column:
    """Top-level keys of a JSON object that the schema does not declare
    (strict mode: a non-empty result is a rejection)."""
    keys = F.json_object_keys(text)
    return F.array_except(keys, F.array(*[F.lit(k) for k in declared]))


def parse_once(
    df: DataFrame, text_col: str, schema: T.DataType, alias: str, keep: Sequence[str] = ()
) -> DataFrame:
    """``keep`` columns plus the parsed record as ``alias``, parsed once per row.

    Reading many leaves of ``from_json(...)`` lets the optimizer split the
    parse into one pruned ``from_json`` per leaf (dozens of parses of the
    same text).  Producing the record through a one-element generator keeps
    a single parse; later projections read the struct.
    """
    once = F.explode(F.array(parse(F.col(text_col), schema)))
    return df.select(*keep, once.alias(alias))


def envelope_files(whole: DataFrame, leaves: dict[str, str], text_col: str = "value", keep: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Whole ``{"response": [...]}`` documents -> (elements, quarantine), read as VARIANT.

    Only the ``leaves`` (field name -> type) are typed.  Elements: ``keep``,
    ``pos`` and the leaves; a missing leaf is null.  Quarantine: ``keep`` and ``reason`` of the documents
    that are not JSON (``not_json``), have no ``response`` array
    (``no_response``) or hold a leaf of another type (``bad_leaf``); none of
    their elements comes out.
    """
    doc = F.try_parse_json(F.col(text_col))
    # One parse a document: the generator keeps later steps from repeating it.
    parsed = whole.select(*keep, F.explode(F.array(F.struct(doc.alias("doc")))).alias("_d"))
    response = F.try_variant_get("_d.doc", f"$.{ENVELOPE_FIELD}", "array<variant>")
    parsed = parsed.select(*keep, F.col("_d.doc").isNull().alias("_broken"), response.alias("_items"))

    def wrong(item: Column) -> Column:
        bad = F.lit(False)
        for name, kind in leaves.items():
            there = F.try_variant_get(item, f"$.{name}", "variant")
            typed = F.try_variant_get(item, f"$.{name}", kind)
            # A text that happens to read as a number is still a text.
            as_text = F.schema_of_variant(there) == "STRING" if kind != "string" else F.lit(False)
            bad = bad | (there.isNotNull() & ~F.is_variant_null(there) & (typed.isNull() | as_text))
        return F.coalesce(bad, F.lit(False))

    reason = F.when(F.col("_broken"), F.lit("not_json")).when(F.col("_items").isNull(), F.lit("no_response"))
    reason = reason.when(F.exists("_items", wrong), F.lit("bad_leaf"))
    judged = parsed.withColumn("reason", reason)
    rows = judged.where("reason IS NULL").select(*keep, F.posexplode("_items").alias("pos", "_item"))
    typed = [F.try_variant_get("_item", f"$.{n}", k).alias(n) for n, k in leaves.items()]
    return rows.select(*keep, "pos", *typed), judged.where("reason IS NOT NULL").select(*keep, "reason")
