"""Mixing sources to target weights by hash-threshold histograms.

Native: DataFrame functions only.

1. Sizes are summed by source; targets are water-filled: every source gets
   its weight's share of the budget, but at most ``cap`` times its size.
2. A target is ``copies`` whole passes over the source plus a rest.  Every
   document has a fixed hash; the rest is filled in hash order.  Sizes are
   summed by (source, top hash bits); running sums over the buckets find the
   bucket where the rest ends, and only that bucket is summed again by its
   next bits, until the hash is used up.  Thresholds for growing budgets nest.
3. A document is taken ``copies`` times, once more if its hash is below the
   source's threshold.  Documents are filtered, never sorted; the tables that
   windows run over hold at most 4,096 rows a source.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from floe.llm.common import WORD_PATTERN, stored

#: Hash bits in all, and bits a refinement step resolves.
HASH_BITS, STEP_BITS = 60, 12


def word_count(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text; null: 0."""
    return F.regexp_count(F.coalesce(text.cast("string"), F.lit("")), F.lit(WORD_PATTERN)).cast("long")


def order_hash(key: Column, text: Column, seed: str) -> Column:
    """60 bits of md5 over seed, key (null: the text ``null``) and the md5 of the text (null: empty), as a non-negative long.

    The text parts rows without id and rows that share one."""
    of_text = F.md5(F.coalesce(text.cast("string"), F.lit("")).cast("binary"))
    named = F.concat(F.lit(seed + ":"), F.coalesce(key.cast("string"), F.lit("null")), F.lit(":"), of_text)
    return F.conv(F.substring(F.md5(named), 1, HASH_BITS // 4), 16, 10).cast("long")


@dataclass(frozen=True)
class Mix:
    """``sizes``: id, source, size, hash of each row; ``plan``: per source
    source_size, target, copies (whole passes) and threshold."""

    sizes: DataFrame
    plan: DataFrame


def targets(sources: DataFrame, weights: tuple[float, ...], share: float, cap: float) -> DataFrame:
    """``(source, source_size)`` -> with ``target``.

    Sources in code-point order (null last) take the weights in turn.  With
    sources sorted by size / weight, the first k are capped and the others
    share the rest by weight; k is the first for which no other exceeds its
    cap.  The windows run over one row per source.
    """
    n = len(weights)
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.pmod(F.row_number().over(by_name) - 1, F.lit(n)) + 1
    w = sources.withColumn("weight", F.element_at(F.array(*[F.lit(float(x)) for x in weights]), turn))
    by_fill = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    every = by_fill.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = by_fill.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_fill.rowsBetween(0, Window.unboundedFollowing)
    w = w.select(
        "*",
        (F.sum("source_size").over(every) * F.lit(float(share))).alias("budget"),
        (F.coalesce(F.sum("source_size").over(before), F.lit(0)) * F.lit(float(cap))).alias("capped_before"),
        F.sum("weight").over(onward).alias("open_weight"),
        F.row_number().over(by_fill).alias("k"),
    )
    level = (F.col("budget") - F.col("capped_before")) / F.col("open_weight")
    fits = F.col("weight") * level <= F.col("source_size") * F.lit(float(cap))
    w = w.withColumn("level", level).withColumn("first_open", F.min(F.when(fits, F.col("k"))).over(every))
    w = w.withColumn("level", F.max(F.when(F.col("k") == F.col("first_open"), F.col("level"))).over(every))
    open_ = F.col("k") >= F.col("first_open")
    target = F.when(open_, F.col("weight") * F.col("level")).otherwise(F.col("source_size") * F.lit(float(cap)))
    return w.select("source", "source_size", target.alias("target"))


def plan_mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
    size: Column | None = None,
    weights: tuple[float, ...] = (3.0, 1.0, 2.0),
    share: float = 1.5,
    cap: float = 2.0,
    seed: str = "mix",
) -> Mix:
    """Sizes and per-source thresholds of a mix of ``docs``.

    Texts are read once: a narrow (id, source, size, hash) table is written to
    the shared folder.  Null texts have size 0, a null source is a source of
    its own, repeated rows count as often as they occur (rows equal in id
    and text share one hash, so they are taken together).  Empty input: empty tables.  Other
    columns are never looked at.
    """
    size = word_count(F.col(f"`{text_col}`")) if size is None else size
    sizes = stored(
        docs.select(
            F.col(id_col).alias("id"),
            F.col(source_col).alias("source"),
            size.cast("long").alias("size"),
            order_hash(F.col(id_col), F.col(f"`{text_col}`"), seed).alias("hash"),
        ),
        "mix-sizes",
    )
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    want = targets(per_source, weights, share, cap)
    copies = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    want = want.withColumn("copies", copies.cast("long"))
    state = stored(
        want.withColumn("rest", F.col("target") - F.col("copies") * F.col("source_size"))
        .withColumn("prefix", F.lit(0).cast("long"))
        # Whole passes only: nothing is taken once more, empty texts neither.
        .withColumn("done", (F.col("copies") > 0) & (F.col("rest") <= 0)),
        "mix-state",
    )
    for used in range(STEP_BITS, HASH_BITS + 1, STEP_BITS):
        state = stored(_refine(sizes, state, used), "mix-state")
        if used < HASH_BITS and state.where(~F.col("done")).isEmpty():
            break
    threshold = F.when(F.col("done"), F.col("prefix")).otherwise(F.lit(1).cast("long"))
    return Mix(sizes, state.select("source", "source_size", "target", "copies", threshold.alias("threshold")))


def _refine(sizes: DataFrame, state: DataFrame, used: int) -> DataFrame:
    """One histogram step.  ``prefix`` is the hash prefix (``used - STEP_BITS``
    bits) in which the rest ends; sum that bucket by its next bits and move
    on.  A source is done when its bucket has no more than one hash value
    left, with ``prefix`` then the full threshold."""
    left = HASH_BITS - used
    at = F.shiftright("hash", left + STEP_BITS)
    open_ = state.where(~F.col("done")).select(F.col("source").alias("s"), "prefix", "rest")
    inside = sizes.join(open_, sizes["source"].eqNullSafe(F.col("s")) & (at == F.col("prefix")))
    hist = inside.groupBy("source", F.shiftright("hash", left).alias("bucket")).agg(
        F.sum("size").alias("n"), F.first("rest").alias("rest"), F.min("hash").alias("lo"), F.max("hash").alias("hi")
    )
    upto = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    cum = F.sum("n").over(upto)
    ends = hist.select("*", cum.alias("cum")).where(F.col("cum") > F.col("rest"))
    edge = ends.groupBy("source").agg(F.min_by(F.struct("bucket", "n", "cum", "lo", "hi"), "bucket").alias("e"))
    st = state.alias("st").join(edge.alias("ed"), F.col("st.source").eqNullSafe(F.col("ed.source")), "left")
    rest = F.col("rest") - (F.col("e.cum") - F.col("e.n"))
    single = F.col("e.lo") == F.col("e.hi")
    # The last document is in if that ends nearer to the target.
    within = F.when(F.col("e.n") / 2 < rest, F.col("e.hi") + 1).otherwise(F.col("e.hi"))
    prefix = (
        F.when(F.col("done"), F.col("prefix"))
        .when(F.col("e").isNull(), F.lit(1 << HASH_BITS).cast("long"))
        .when(single, within)
        .otherwise(F.col("e.bucket"))
    )
    return st.select(
        F.col("st.source").alias("source"),
        "source_size",
        "target",
        "copies",
        F.when(F.col("done") | F.col("e").isNull(), F.col("rest")).otherwise(rest).alias("rest"),
        prefix.alias("prefix"),
        (F.col("done") | F.col("e").isNull() | single).alias("done"),
    )


def times_taken(hash_col: Column, copies: Column, threshold: Column) -> Column:
    return copies + F.when(hash_col < threshold, F.lit(1).cast("long")).otherwise(F.lit(0).cast("long"))


def taken(mix: Mix) -> DataFrame:
    """Per row of the input: id, source, size, source_size, target, times (how often the mix takes it)."""
    p = mix.plan.withColumnRenamed("source", "s")
    joined = mix.sizes.join(p, mix.sizes["source"].eqNullSafe(p["s"]))
    return joined.select(
        "id", "source", "size", "source_size", "target", times_taken(F.col("hash"), F.col("copies"), F.col("threshold")).alias("times")
    )


def mix_documents(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` as the mix takes them: dropped, kept, or repeated, all columns as they were."""
    id_col, source_col, text_col = (options.get(f"{c}_col", d) for c, d in (("id", "doc_id"), ("source", "source"), ("text", "text")))
    # One struct holds the row, so that no column meets a name used here.
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    hashed = order_hash(F.col(f"`{id_col}`"), F.col(f"`{text_col}`"), options.get("seed", "mix"))
    rows = docs.select(row, F.col(f"`{source_col}`").alias("of"), hashed.alias("hash"))
    rows = rows.join(plan_mix(docs, **options).plan, F.col("of").eqNullSafe(F.col("source")))
    n = times_taken(F.col("hash"), F.col("copies"), F.col("threshold")).cast("int")
    copied = rows.select("row", F.explode(F.array_repeat(F.lit(True), n)))
    return copied.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


def digest(docs: DataFrame) -> DataFrame:
    """The contract's columns for the whole documents table."""
    return taken(plan_mix(docs)).select(
        F.col("id").alias("doc_id"), "size", "source_size", "target", (F.col("size") * F.col("times")).alias("taken")
    )


ORACLE_SQL = r"""
WITH sizes AS (
  SELECT doc_id, source,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         ('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, 'null') || ':' || md5(coalesce(text, ''))), 1, 15))::BIGINT AS hash
  FROM documents),
per_source AS (SELECT source, sum(size)::BIGINT AS source_size FROM sizes GROUP BY source),
weighted AS (
  SELECT *, [3.0::DOUBLE, 1.0::DOUBLE, 2.0::DOUBLE][((row_number() OVER (ORDER BY source NULLS LAST)) - 1) % 3 + 1] AS weight
  FROM per_source),
filled AS (
  SELECT *, (sum(source_size) OVER ()) * 1.5::DOUBLE AS budget,
         coalesce(sum(source_size) OVER (f ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) * 2.0::DOUBLE AS capped_before,
         sum(weight) OVER (f ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_weight,
         row_number() OVER f AS k
  FROM weighted WINDOW f AS (ORDER BY source_size / weight, source NULLS LAST)),
leveled AS (
  SELECT *, (budget - capped_before) / open_weight AS level,
         min(CASE WHEN weight * ((budget - capped_before) / open_weight) <= source_size * 2.0::DOUBLE THEN k END) OVER () AS first_open
  FROM filled),
aimed AS (
  SELECT source, source_size,
         CASE WHEN k >= first_open THEN weight * max(CASE WHEN k = first_open THEN level END) OVER ()
              ELSE source_size * 2.0::DOUBLE END AS target
  FROM leveled),
planned AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS copies FROM aimed),
ordered AS (
  SELECT s.doc_id, s.size, p.source_size, p.target, p.copies,
         p.target - p.copies * p.source_size AS rest,
         sum(s.size) OVER (PARTITION BY s.source ORDER BY s.hash) AS upto,
         sum(s.size) OVER (PARTITION BY s.source, s.hash) AS same
  FROM sizes s JOIN planned p ON s.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, source_size, target::DOUBLE AS target,
       (size * (copies + CASE WHEN upto - same / 2 < rest OR upto <= rest THEN 1 ELSE 0 END))::BIGINT AS taken
FROM ordered
"""
