"""Helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from floe.session import scoped_conf, scratch_path

#: ASCII white space of the word rule: space and \t \n \v \f \r (``bytes.split()`` cuts at exactly these).
WORD_PATTERN = r"[^\x20\x09-\x0D]+"

#: Rows a Python worker is handed at once: texts are long, and workers stay while later stages run.
BATCH_ROWS = "1000"

#: Bits of a bitmap (fixed by ``bitmap_construct_agg``), bitmaps of a sieve at most (32 MB in all), bits a key.
BITMAP, BITMAPS, SPARE = 32_768, 8_192, 16


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back.

    Cuts the lineage with files that outlive any executor, so a table that is
    read several times is computed once.
    """
    spark = df.sparkSession
    path = scratch_path(spark, purpose)
    with scoped_conf(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": BATCH_ROWS}):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def sieved(rows: DataFrame, keys: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """``rows`` in two parts, without a shuffle of them: those whose ``key`` may be among ``keys``, and those whose key surely is not.

    A bitmap of key hashes, in blocks of ``BITMAP`` bits, goes to every task.
    Every row with one of the keys is in the first part, with about one in
    ``SPARE`` of the others (more beyond ``BITMAPS * BITMAP / SPARE`` keys), so
    only that part of a wide table has to be dealt for a join.  A null key
    counts as a value.  ``keys`` is read twice, ``rows`` once a part.
    """
    blocks = min(BITMAPS, max(1, -(-keys.count() * SPARE // BITMAP)))
    bit = F.pmod(F.xxhash64(f"`{key}`"), F.lit(blocks * BITMAP))
    block, place = F.floor(bit / F.lit(BITMAP)).cast("int"), F.pmod(bit, F.lit(BITMAP)).cast("int")
    bits = F.call_function("bitmap_construct_agg", F.col("_place").cast("long"))
    bitmaps = stored(keys.select(block.alias("_block"), place.alias("_place")).groupBy("_block").agg(bits.alias("_bits")), "sieve")
    byte = F.conv(F.hex(F.substring("_bits", F.floor(place / F.lit(8)).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    found = (block == F.col("_block")) & (F.getbit(byte, F.pmod(place, F.lit(8))) == 1)
    return tuple(rows.join(F.broadcast(bitmaps), found, how) for how in ("left_semi", "left_anti"))


def free_name(base: str, columns: Iterable[str]) -> str:
    """``base``, with underscores added until it is no column's name (Spark's names ignore case)."""
    taken = {c.lower() for c in columns}
    while base.lower() in taken:
        base += "_"
    return base


def map_groups(
    df: DataFrame,
    keys: list[str],
    fn: Callable[[pd.DataFrame], pd.DataFrame | None],
    schema: str,
    order: list[str] | None = None,
    tasks: int | None = None,
) -> DataFrame:
    """``fn`` on the rows of each key, for very many small groups.

    Rows are dealt by key and sorted, then every task walks its sorted batches
    and cuts them at key changes: one Python call per group but no Arrow
    message per group.  Memory is one batch plus one group, so callers bound
    their groups (they split hot keys into cells first).  Keys must not be
    null.  ``tasks``: how many tasks share the groups, for work that small
    rows do not show; adaptive execution merges tasks by bytes otherwise.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []

        def flush() -> Iterator[pd.DataFrame]:
            if held:
                out = fn(held[0] if len(held) == 1 else pd.concat(held, ignore_index=True))
                held.clear()
                if out is not None and len(out):
                    yield out

        for batch in batches:
            if not len(batch):
                continue
            k = batch[keys]
            new = (k != k.shift()).any(axis=1).to_numpy()
            new[0] = not held or tuple(held[-1][keys].iloc[-1]) != tuple(k.iloc[0])
            cuts = [*new.nonzero()[0].tolist(), len(batch)]
            if cuts[0] > 0:
                held.append(batch.iloc[: cuts[0]].reset_index(drop=True))
            for a, b in zip(cuts, cuts[1:]):
                yield from flush()
                held.append(batch.iloc[a:b].reset_index(drop=True))
        yield from flush()

    dealt = (df.repartition(tasks, *keys) if tasks else df.repartition(*keys)).sortWithinPartitions(*keys, *(order or []))
    return dealt.mapInPandas(run, schema)


def usable_vectors(rows: DataFrame, id_col: str, vec_col: str, *more: str) -> DataFrame:
    """``(id long, v array<double>, *more)`` of the vectors that take part: id and vector not null,
    no null or non-finite component, not all zero.  Of rows that repeat an
    id, the smallest (``more``, vector) counts."""
    d = rows.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v"), *more)
    d = d.where(
        F.col("id").isNotNull()
        & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
        & F.exists("v", lambda x: x != 0.0)
    )
    one = d.groupBy("id").agg(F.min(F.struct(*more, "v")).alias("r"))
    return one.select("id", "r.v", *[f"r.{c}" for c in more])


def cells(df: DataFrame, member: str, count: str, chunk: int) -> DataFrame:
    """Cut groups (of ``count`` members, a column) into chunks of about ``chunk`` and
    give every row the cells of its group that it takes part in: a cell (``_i``, ``_j``) holds chunks i and j, so
    every pair of members meets in exactly one cell with i < j, or in the
    cells of its own chunk (i = j).  No pair of rows is ever emitted; no cell
    is larger than two chunks.
    """
    n = F.ceil(F.col(count) / F.lit(chunk)).cast("int")
    mine = F.pmod(F.xxhash64(F.lit(17), F.col(member)), n.cast("long")).cast("int")
    d = df.withColumn("_n", n).withColumn("_c", mine)
    d = d.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)))
    return (
        d.withColumn("_i", F.least("_c", "_other"))
        .withColumn("_j", F.greatest("_c", "_other"))
        .drop("_n", "_other", count)
    )
