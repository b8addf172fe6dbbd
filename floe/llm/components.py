"""Connected components by alternating large-star and small-star.

Each round is two groupings and two joins over an edge table written to the
shared folder; nothing is collected but one (count, checksum) row per round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from floe.llm.common import stored


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    # Written first, so that both sides of the join are plain shuffles, which may be split at a hot node.
    least = stored(least, "cc-least")
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v")))


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``(node, component)`` for every node of an edge; component = smallest node reachable.

    Edges may repeat, run either way, or be loops (loops and nulls are
    dropped: a node with loops only is its own component and not listed).  A
    hot node costs one partially aggregated minimum and a join that adaptive
    execution can split.  No edges: no rows.
    """
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    e = stored(e.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") != F.col("v"))).distinct(), "cc")
    state = None
    while True:
        now = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if not now["n"] or now == state:
            return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
                e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            )
        state = now
        e = stored(_small_star(_large_star(e).distinct()).distinct(), "cc")
