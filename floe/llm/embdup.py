"""Near-duplicate vectors by Euclidean p-stable hashing, confirmed by exact cosine.

A pair of unit vectors with cosine c lies sqrt(2 - 2c) apart.  ``floor((a.u +
b) / width)`` with Gaussian a keeps near vectors together; a table's bucket is
``k`` such values, and there are enough tables that a pair exactly at the
threshold meets in one of them with probability ``recall``.

1. Equal vectors (of one label) become one class with a multiplicity.
2. Bucket keys of every class are computed once and written; narrow (label,
   table, key) counts leave only buckets with company.
3. Members of a bucket meet in cells of at most two chunks; a cell multiplies
   two dense blocks.  A pair is counted in the first table in which its keys
   meet, so counts add up without listing pairs; for the components a cell
   returns at most one edge per member.  Vectors travel as they came, without
   their keys.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from floe.llm.common import cells, map_groups, stored, usable_vectors
from floe.llm.components import connected_components
from floe.llm.shingles import mix64

#: Bucket width, in unit-vector distances.
WIDTH = 2.0
#: Vectors per chunk; a cell holds two.  Vectors hashed at once.
CHUNK, AT_ONCE = 512, 16


def _meet(distance: float, width: float = WIDTH) -> float:
    """Probability that one quantised projection is equal for two vectors ``distance`` apart."""
    t = width / max(distance, 1e-12)
    tail = 0.5 * math.erfc(t / math.sqrt(2))
    return 1 - 2 * tail - 2 / (math.sqrt(2 * math.pi) * t) * (1 - math.exp(-t * t / 2))


def plan_tables(rows: int, threshold: float, recall: float) -> tuple[int, int]:
    """(values per key, tables): keys long enough that unrelated (orthogonal) vectors
    of ``rows`` rarely meet, tables enough for ``recall`` at the threshold."""
    near, far = _meet(math.sqrt(2 - 2 * threshold)), _meet(math.sqrt(2))
    k = max(4, math.ceil(math.log(max(rows, 2)) / -math.log(far)))
    return k, math.ceil(math.log(1 - recall) / math.log(1 - near**k))


def _unit(a: np.ndarray) -> np.ndarray:
    a = a / np.abs(a).max()
    return a / np.sqrt(a @ a)


@lru_cache(maxsize=8)
def _planes(dim: int, values: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng([seed, dim])
    return rng.standard_normal((dim, values)), rng.uniform(0, WIDTH, values)


def _keys(units: np.ndarray, k: int, tables: int, seed: int) -> np.ndarray:
    """One 32-bit key per unit vector (of one length) and table.

    Always in products of one shape, so that a vector has the same keys
    wherever they are computed."""
    n, dim = units.shape
    a, b = _planes(dim, tables * k, seed)
    keys = np.empty((n, tables), np.int32)
    for at in range(0, n, AT_ONCE):
        part = np.zeros((AT_ONCE, dim))
        rows = min(AT_ONCE, n - at)
        part[:rows] = units[at : at + rows]
        q = np.floor((part @ a + b) / WIDTH).astype(np.int64).reshape(AT_ONCE, tables, k)
        h = np.full((AT_ONCE, tables), dim, np.uint64)
        with np.errstate(over="ignore"):
            for i in range(k):
                h = mix64(h * np.uint64(0x9E3779B97F4A7C15) + q[:, :, i].astype(np.uint64))
        keys[at : at + rows] = (h >> np.uint64(32)).astype(np.uint32).view(np.int32)[:rows]
    return keys


def _packed(v: np.ndarray) -> bytes:
    """The vector itself, as single-precision numbers where these are the same."""
    short = v.astype("<f4")
    return b"f" + short.tobytes() if (short.astype(float) == v).all() else b"d" + v.astype("<f8").tobytes()


def _unpacked(x: bytes) -> np.ndarray:
    return np.frombuffer(x, "<f4" if x[:1] == b"f" else "<f8", offset=1).astype(float)


def _hash(classes: DataFrame, k: int, tables: int, seed: int) -> DataFrame:
    """rep, label, copies, the vector (``_packed``) and one 32-bit key per table."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            keys = np.empty((len(pdf), tables), np.int32)
            vectors = [np.asarray(v, float) for v in pdf["v"]]
            dims = np.array([len(v) for v in vectors])
            for d in np.unique(dims):
                rows = np.flatnonzero(dims == d)
                keys[rows] = _keys(np.stack([_unit(vectors[i]) for i in rows]), k, tables, seed)
            yield pd.DataFrame(
                {
                    "rep": pdf["rep"].to_numpy(),
                    "label": pdf["label"].to_numpy(),
                    "copies": pdf["copies"].to_numpy(),
                    "x": [_packed(v) for v in vectors],
                    "keys": list(keys),
                }
            )

    return classes.mapInPandas(run, "rep long, label long, copies long, x binary, keys array<int>")


def _link_cell(threshold: float, k: int, tables: int, seed: int):
    def link(g: pd.DataFrame) -> pd.DataFrame | None:
        t, i0, j0 = int(g["t"].iloc[0]), g["_i"].iloc[0], g["_j"].iloc[0]
        units = [_unit(_unpacked(x)) for x in g["x"]]
        size = np.array([len(u) for u in units])
        if (size != size[0]).any():  # keys of vectors of different lengths may meet by accident
            parts = [link(p) for _, p in g.groupby(size)]
            parts = [p for p in parts if p is not None]
            return pd.concat(parts) if parts else None
        chunk = g["_c"].to_numpy()
        left = np.flatnonzero(chunk == i0)
        right = left if i0 == j0 else np.flatnonzero(chunk == j0)
        if not len(left) or not len(right):
            return None
        u = np.stack(units)
        near = u[left] @ u[right].T >= threshold
        if i0 == j0:
            near &= np.triu(np.ones(near.shape, bool), 1)
        a, b = np.nonzero(near)
        if not len(a):
            return None
        a, b = left[a], right[b]
        # Keys do not travel: those of linked vectors are computed again.
        some = np.zeros(len(g), bool)
        some[a] = some[b] = True
        keys = np.empty((len(g), t), np.int32)
        if t:
            keys[some] = _keys(u[some], k, tables, seed)[:, :t]
        copies = g["copies"].to_numpy()
        first = np.ones(len(a), bool)
        for s in range(0, len(a), 65536):
            first[s : s + 65536] = ~(keys[a[s : s + 65536]] == keys[b[s : s + 65536]]).any(axis=1)
        n = np.bincount(a[first], copies[b[first]], len(g)) + np.bincount(b[first], copies[a[first]], len(g))
        root = _roots(a, b, len(g))
        rep = g["rep"].to_numpy()
        return pd.DataFrame({"rep": rep[some], "n": n[some].astype(np.int64), "to": rep[root[some]]})

    return link


def _roots(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """A common index for the members of each component of the links a-b (minimum labels spread, with jumps)."""
    root = np.arange(n)
    while True:
        was = root.copy()
        low = np.minimum(root[a], root[b])
        np.minimum.at(root, a, low)
        np.minimum.at(root, b, low)
        np.minimum.at(root, was[a], low)
        np.minimum.at(root, was[b], low)
        root = root[root]
        if (root == was).all():
            return root


def near_vectors(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    label_col: str = "label",
    threshold: float = 0.93,
    recall: float = 0.999,
    seed: int = 9,
) -> DataFrame:
    """``(id, n_links, component)`` per distinct non-null id.

    Vectors with equal non-null labels and cosine (in double precision, on
    equal lengths) at or above ``threshold`` link.  Null or zero vectors and
    those with null or non-finite components link with nothing, as do null
    labels.  Rows without an id are left out; of usable rows that repeat an id
    the smallest (label, vector) counts.  Empty table: empty result.  Other
    columns are never looked at.
    """
    ids = vectors.select(F.col(id_col).cast("long").alias("id")).where("id IS NOT NULL").distinct()
    named = vectors.select(id_col, vec_col, F.col(label_col).cast("long").alias("label")).where("label IS NOT NULL")
    rows = stored(usable_vectors(named, id_col, vec_col, "label"), "vectors")
    # Equal vectors meet by value; the count is partial per task, so a hot vector is a few rows.
    classes = rows.groupBy("label", "v").agg(F.min("id").alias("rep"), F.count("*").alias("copies"))
    most = rows.groupBy("label").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    k, tables = plan_tables(most, threshold, recall)
    hashed = stored(_hash(classes.select("rep", "label", "copies", "v"), k, tables, seed), "vector-keys")
    repeated = stored(classes.where("copies > 1"), "vector-repeated")
    members = stored(rows.join(repeated, ["label", "v"]).select("id", "rep", "copies"), "vector-copies")

    keys = hashed.select("rep", "label", F.posexplode("keys").alias("t", "key"))
    counts = keys.groupBy("label", "t", "key").agg(F.count("*").alias("size")).where("size > 1")
    shared = stored(counts, "vector-buckets")
    dealt = cells(keys.join(shared, ["label", "t", "key"]), "rep", "size", CHUNK).drop("label")
    dealt = dealt.join(hashed.select("rep", "label", "copies", "x"), "rep")
    link = _link_cell(threshold, k, tables, seed)
    found = stored(map_groups(dealt, ["label", "t", "key", "_i", "_j"], link, "rep long, n long, to long"), "vector-links")

    per_class = found.groupBy("rep").agg(F.sum("n").alias("n"))
    of_copy = members.join(per_class, "rep", "left").select("id", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n"))
    singles = per_class.withColumnRenamed("rep", "id").join(members.select("id"), "id", "left_anti").select("id", "n")
    links = of_copy.union(singles)
    edges = found.select("rep", "to").distinct().union(members.select("id", "rep"))
    comps = connected_components(edges, "rep", "to")
    return (
        ids.join(links, "id", "left")
        .join(comps.withColumnRenamed("node", "id"), "id", "left")
        .select("id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component", "id").alias("component"))
    )


def digest(vectors: DataFrame) -> DataFrame:
    """The contract's columns."""
    return near_vectors(vectors).select(
        F.col("id").alias("vec_id"), "n_links", F.col("component").alias("component_id"), (F.col("id") == F.col("component")).alias("kept")
    )
