"""Near-duplicate documents by MinHash.

1. Per document: distinct word shingles, 125 universal hash minima, 25 band
   keys of 5 minima each, a signature of the minima's low bytes and a 128-bit
   fingerprint of the shingle set.  Written once; texts do not travel.
2. Documents with equal sets form a class; only its smallest id goes on, so
   a hot text is one row from here.
3. Banding: in every bucket of a band, members are paired with the bucket's
   smallest id (a star, never all pairs).  Pairs whose signatures disagree are
   dropped; the others are confirmed on full shingle sets, texts being joined
   to pairs and dealt by star in bounded parts.
4. Connected components of the confirmed links.  Buckets that now lie in one
   component are settled.  In the others, members outside the largest
   component are compared with all by signature, in cells of at most two
   chunks.  Everyone's likeliest partner in another component is confirmed in
   the same way, and components are found again.
5. In buckets that are still unsettled, everyone with a likely partner in
   another component is compared by full sets, again in cells.  A cell returns
   a spanning forest of its links, so no link between different texts is lost
   and no group is expanded into pairs.  Components again.

A pair at similarity 0.8 shares a band with probability 1 - (1 - 0.8**5)**25 =
0.99995; a pair above it more surely.  A true pair's signature (125 bytes, 0.8
expected equal) falls below the bar of 0.65 with probability 2e-5.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from floe.llm.common import free_name, map_groups, sieved, stored
from floe.llm.components import connected_components
from floe.llm.shingles import MinHasher, chunks, mix64, shingle_hashes, shingle_sets

ROWS, BANDS = 5, 25
#: Share of equal signature bytes below which a pair cannot well reach 0.8.
SIGNATURE_BAR = 0.65
#: Members that are held at once with their texts, and with their signatures only.
PART, CELL = 256, 1024


def signatures(docs: DataFrame, words: int) -> DataFrame:
    """id, n_shingles, f1, f2 (set fingerprint), bands, sig.  Null ids are left out."""
    hasher = MinHasher(ROWS * BANDS)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            ids = pdf["id"].to_numpy()
            for first, part in chunks(pdf["text"].tolist()):
                h, n = shingle_hashes(part, words)
                low = hasher.minima(h, n)
                end = np.cumsum(n)
                sets = [np.unique(h[a:b]) for a, b in zip(end - n, end)]
                with np.errstate(over="ignore"):
                    f1 = [int(np.sum(mix64(s), dtype=np.uint64).view(np.int64)) for s in sets]
                    f2 = [int(np.sum(mix64(s ^ np.uint64(0x1234567)), dtype=np.uint64).view(np.int64)) for s in sets]
                keys = np.tile(np.arange(1, BANDS + 1, dtype=np.uint64), (len(n), 1))
                grouped = low.reshape(len(n), BANDS, ROWS).astype(np.uint64)
                for r in range(ROWS):
                    keys = mix64(keys * np.uint64(0x9E3779B97F4A7C15) + grouped[:, :, r])
                yield pd.DataFrame(
                    {
                        "id": ids[first : first + len(n)],
                        "n_shingles": [len(s) for s in sets],
                        "f1": f1,
                        "f2": f2,
                        "bands": list(keys.view(np.int64)),
                        "sig": [x.tobytes() for x in low.astype(np.uint8)],
                    }
                )

    rows = docs.where("id IS NOT NULL")
    return rows.mapInPandas(run, "id long, n_shingles long, f1 long, f2 long, bands array<long>, sig binary")


def _similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both) and both > 0


def _star_links(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """The (pivot, member) pairs that hold on full sets.  Stars are dealt in parts of about ``PART`` members."""
    parts = pairs.groupBy("pivot").agg(F.ceil(F.count("*") / F.lit(PART)).cast("int").alias("parts"))
    mine = F.pmod(F.xxhash64("member"), F.col("parts").cast("long")).cast("int")
    members = pairs.join(parts, "pivot").select("pivot", mine.alias("part"), F.col("member").alias("id"))
    centres = parts.select("pivot", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.col("pivot").alias("id"))
    some, _ = sieved(texts, pairs.select(F.explode(F.array("pivot", "member")).alias("id")), "id")
    rows = members.union(centres).join(some, "id")

    def confirm(g: pd.DataFrame) -> pd.DataFrame | None:
        sets = list(shingle_sets(g["text"].tolist(), words))
        centre = (g["id"] == g["pivot"]).to_numpy()
        hubs = [s for s, c in zip(sets, centre) if c]
        ok = [not c and any(_similar(h, s, percent) for h in hubs) for s, c in zip(sets, centre)]
        return pd.DataFrame({"a": g["pivot"][ok], "b": g["id"][ok]})

    return map_groups(rows, ["pivot", "part"], confirm, "a long, b long")


def _forest(links: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Rows of ``links`` (index pairs) that join so far separate groups."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    keep = []
    for k, (i, j) in enumerate(links):
        a, b = find(int(group[i])), find(int(group[j]))
        if a != b:
            parent[a] = b
            keep.append(k)
    return links[keep]


def _agreeing(g: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (minor, any) of a cell that lie in different components and
    whose signatures agree, and the shares that agree."""
    sig = np.frombuffer(b"".join(g["sig"]), np.uint8).reshape(len(g), -1)
    comp, minor = g["comp"].to_numpy(), g["minor"].to_numpy()
    right = np.flatnonzero(~minor)
    pairs, shares = [np.empty((0, 2), int)], [np.empty(0)]
    for i in np.flatnonzero(minor):
        cand = right[comp[right] != comp[i]]
        if len(cand):
            share = (sig[cand] == sig[i]).mean(axis=1)
            ok = share >= SIGNATURE_BAR
            pairs.append(np.stack([np.full(ok.sum(), i), cand[ok]], axis=1))
            shares.append(share[ok])
    return np.concatenate(pairs), np.concatenate(shares)


def _unsettled(bucket_rows: DataFrame, comps: DataFrame, sigs: DataFrame) -> DataFrame:
    """Members, with signatures, of the cells of buckets that hold more than one component.

    In such a bucket the members outside its largest component (the minors)
    have to meet everyone.  Chunks of minors cross chunks of all members: a
    cell (``_i``, ``_j``) holds one of each, so it is bounded, and a bucket
    whose members are nearly all of one component is passed through once.
    """
    rows = bucket_rows.join(comps, "rep")
    parts = rows.groupBy("key", "comp").agg(F.count("*").alias("n"), F.sum(F.xxhash64("rep").cast("decimal(38,0)")).alias("who"))
    spread = parts.groupBy("key").agg(
        F.sum("n").alias("n"), F.max("n").alias("top"), F.max_by("comp", "n").alias("main"), F.count("*").alias("comps"), F.sum("who").alias("who")
    )
    # The same members meet in many bands: one of the equal buckets will do.
    spread = spread.where("comps > 1").groupBy("n", "who").agg(F.min_by(F.struct("key", "main", "top"), "key").alias("k"))
    chunks_of = (F.ceil(F.col("n") / F.lit(CELL)).cast("int"), F.ceil((F.col("n") - F.col("k.top")) / F.lit(CELL)).cast("int"))
    keys = stored(spread.select("k.key", "k.main", chunks_of[0].alias("all_parts"), chunks_of[1].alias("minor_parts")), "minhash-unsettled")
    rows = rows.join(keys, "key")

    def chunk(parts: str):
        return F.pmod(F.xxhash64(F.lit(17), F.col("rep")), F.col(parts).cast("long")).cast("int")

    def every(parts: str):
        return F.explode(F.sequence(F.lit(0), F.col(parts) - 1))

    left = rows.where("comp != main").select("key", chunk("minor_parts").alias("_i"), every("all_parts").alias("_j"), "rep", "comp", F.lit(True).alias("minor"))
    right = rows.select("key", every("minor_parts").alias("_i"), chunk("all_parts").alias("_j"), "rep", "comp", F.lit(False).alias("minor"))
    return stored(left.union(right).join(sigs, "rep"), "minhash-cells")


def _best_pairs(members: DataFrame) -> DataFrame:
    """For every minor of a cell its likeliest partner in another component: at most one pair a row."""

    def best(g: pd.DataFrame) -> pd.DataFrame | None:
        pairs, share = _agreeing(g)
        if not len(pairs):
            return None
        pairs = pairs[np.lexsort((-share, pairs[:, 0]))]
        top = pairs[np.diff(pairs[:, 0], prepend=-1) != 0]
        rep = g["rep"].to_numpy()[top]
        return pd.DataFrame({"pivot": rep.min(axis=1), "member": rep.max(axis=1)})

    return map_groups(members, ["key", "_i", "_j"], best, "pivot long, member long").distinct()


def _rest_links(members: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """All links between different components inside the cells, as a spanning forest of each part of a cell."""

    def likely(g: pd.DataFrame) -> pd.DataFrame | None:
        """Rows with a likely partner, in parts of at most ``PART`` of either side that hold such a pair."""
        pairs, _ = _agreeing(g)
        if not len(pairs):
            return None
        order = np.cumsum(g["minor"].to_numpy()), np.cumsum(~g["minor"].to_numpy())
        a, b = order[0][pairs[:, 0]] // PART, order[1][pairs[:, 1]] // PART
        rows = np.unique(np.concatenate([np.stack([x, a, b], axis=1) for x in pairs.T]), axis=0)
        out = g.iloc[rows[:, 0]][["key", "_i", "_j", "rep", "comp", "minor", "sig"]]
        return out.assign(_a=rows[:, 1], _b=rows[:, 2])

    some = map_groups(members, ["key", "_i", "_j"], likely, "key long, _i int, _j int, rep long, comp long, minor boolean, sig binary, _a int, _b int")
    full = some.join(texts.withColumnRenamed("id", "rep"), "rep")

    def confirm(g: pd.DataFrame) -> pd.DataFrame | None:
        pairs, _ = _agreeing(g)
        sets = list(shingle_sets(g["text"].tolist(), words))
        pairs = pairs[[_similar(sets[i], sets[j], percent) for i, j in pairs]] if len(pairs) else pairs
        pairs = _forest(pairs, g["comp"].to_numpy())
        rep = g["rep"].to_numpy()
        return pd.DataFrame({"a": rep[pairs[:, 0]], "b": rep[pairs[:, 1]]}) if len(pairs) else None

    return map_groups(full, ["key", "_i", "_j", "_a", "_b"], confirm, "a long, b long")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 80
) -> DataFrame:
    """``(id, n_shingles, component)`` per distinct non-null id.

    Words are ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z.  Documents link
    if their shingle sets' Jaccard similarity is ``percent`` / 100 or more;
    component is the smallest id reachable.  Null or wordless texts have
    0 shingles and link with nothing.  Rows without an id are left out.  A
    repeated id is one document: linked if any of its texts is, with the
    largest of their n_shingles.  An empty table gives an empty result; other
    columns are never looked at.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    table = stored(signatures(texts, words), "minhash-signatures")
    filled = table.where("n_shingles > 0")
    classes = filled.groupBy("f1", "f2").agg(F.min("id").alias("rep"), F.max("id").alias("top")).where("rep < top")
    copies = stored(classes.select("f1", "f2", "rep"), "minhash-copies")
    copy_of = stored(filled.select("id", "f1", "f2").join(copies, ["f1", "f2"]), "minhash-copy-of")
    others = copy_of.where("id != rep")
    some, single = sieved(filled, others.select("id"), "id")
    reps = single.union(some.join(others, ["id", "f1", "f2"], "left_anti").select(*filled.columns))
    reps = reps.select(F.col("id").alias("rep"), "bands", "sig")

    keys = reps.select("rep", F.explode("bands").alias("key"))
    buckets = keys.groupBy("key").agg(F.min("rep").alias("pivot"), F.max("rep").alias("top")).where("pivot < top")
    buckets = stored(buckets.select("key", "pivot"), "minhash-shared")
    some, _ = sieved(keys, buckets.select("key"), "key")
    bucket_rows = stored(some.join(buckets, "key"), "minhash-buckets")
    wanted = stored(bucket_rows.select("rep").distinct(), "minhash-wanted")
    sigs = stored(reps.select("rep", "sig").join(wanted, "rep", "left_semi"), "minhash-wanted-signatures")
    # A few texts more than are wanted: no join below looks at them.
    texts = stored(sieved(texts, wanted.withColumnRenamed("rep", "id"), "id")[0], "minhash-wanted-texts")
    pairs = bucket_rows.where("pivot != rep").select("pivot", F.col("rep").alias("member")).distinct()
    agree = _sig_agreement(F.col("sa"), F.col("sb"))
    likely = (
        pairs.join(sigs.select(F.col("rep").alias("pivot"), F.col("sig").alias("sa")), "pivot")
        .join(sigs.select(F.col("rep").alias("member"), F.col("sig").alias("sb")), "member")
        .where(agree >= F.lit(SIGNATURE_BAR))
        .select("pivot", "member")
    )
    links = stored(_star_links(stored(likely, "minhash-pairs"), texts, words, percent), "minhash-links")
    edges = links.union(copy_of.select("id", "rep"))

    def component_table() -> tuple[DataFrame, DataFrame]:
        found = connected_components(edges, "a", "b")
        comps = wanted.join(found.select(F.col("node").alias("rep"), "component"), "rep", "left")
        return found, stored(comps.select("rep", F.coalesce("component", "rep").alias("comp")), "minhash-components")

    bucket_rows = bucket_rows.select("key", "rep")
    found, comps = component_table()
    best = stored(_best_pairs(_unsettled(bucket_rows, comps, sigs)), "minhash-best")
    if not best.isEmpty():
        edges = edges.union(stored(_star_links(best, texts, words, percent), "minhash-best-links"))
        found, comps = component_table()
        rest = stored(_rest_links(_unsettled(bucket_rows, comps, sigs), texts, words, percent), "minhash-rest")
        found = found if rest.isEmpty() else connected_components(edges.union(rest), "a", "b")
    sizes = table.groupBy("id").agg(F.max("n_shingles").alias("n_shingles"))
    return sizes.join(found.withColumnRenamed("node", "id"), "id", "left").select(
        "id", "n_shingles", F.coalesce("component", "id").alias("component")
    )


@F.pandas_udf(T.DoubleType())
def _sig_agreement(a: pd.Series, b: pd.Series) -> pd.Series:
    n = ROWS * BANDS
    x = np.frombuffer(b"".join(a), np.uint8).reshape(-1, n)
    y = np.frombuffer(b"".join(b), np.uint8).reshape(-1, n)
    return pd.Series((x == y).mean(axis=1))


def keep_one(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without near duplicates: of each group one row stays, all columns as they were.

    Groups are of rows, by their own texts: a key per row is generated, and
    ids play no part in what links.  Of a group the row with the smallest id
    stays (null last; ties: the smallest SHA-256 of the text, then any).  Rows
    with unrelated texts all stay, whether their ids repeat or are null; so do
    rows without words.
    """
    key = free_name("row", docs.columns)
    rows = stored(docs.withColumn(key, F.monotonically_increasing_id()), "minhash-rows")
    id_, text = F.col(f"`{id_col}`").cast("long"), F.col(f"`{text_col}`").cast("string")
    found = near_duplicates(rows.select(F.col(key).alias("k"), text.alias("t")), "k", "t", words, percent)
    linked = stored(found.where("id != component").select("id", "component"), "minhash-linked")
    # The component's own row is a member too.
    members = stored(linked.union(linked.select(F.col("component").alias("id"), "component").distinct()), "minhash-grouped")
    # Only rows that may be in a group are dealt; the others stay where they are.
    some, single = sieved(rows, members.select(F.col("id").alias(key)), key)
    order = some.select(F.col(key).alias("id"), id_.isNull().alias("unnamed"), id_.alias("doc"), F.sha2(text.cast("binary"), 256).alias("sha"))
    members = stored(members.join(order, "id"), "minhash-members")
    stays = members.groupBy("component").agg(F.min(F.struct("unnamed", "doc", "sha", "id")).alias("first")).select(F.col("first.id").alias("id"))
    gone = members.join(stays, "id", "left_anti").select(F.col("id").alias(key))
    names = [F.col(f"`{c}`") for c in docs.columns]
    return single.select(*names).union(some.join(gone, key, "left_anti").select(*names))


def digest(docs: DataFrame) -> DataFrame:
    """The contract's columns: 4-word shingles, similarity 0.8."""
    found = near_duplicates(docs, words=4, percent=80)
    return found.select(
        F.col("id").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"), (F.col("id") == F.col("component")).alias("kept")
    )
