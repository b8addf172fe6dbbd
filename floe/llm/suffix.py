"""Removing repeated passages with a distributed difference-cover suffix sort.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts in a
document with a smaller id.

1. Equal texts are one document from here on (the smallest id): their copies
   are covered whole.
2. Every start of a string belongs to the string's minimizer, the least hashed
   ``GRAM``-byte piece in it; equal strings have equal minimizers.  Runs of
   starts with one minimizer are narrow rows, dealt once by minimizer; only
   runs whose minimizer occurs in two documents go on.  Rows that a task already
   sees in two documents are dealt evenly, with one of them for the others.
3. Their texts (contexts) are grouped by content with their smallest and largest
   document, counted partially, so a passage in a third of all documents is one row.
4. Two contexts with a common string agree in ``SIDE`` bytes before or after the
   minimizer, and only contexts that agree so with another one are sorted, dealt
   by these bytes.  In each part, a difference-cover sort
   (modulo 3) orders the suffixes: sampled triples are sorted and named, names
   are sorted again until they cover ``LENGTH`` bytes, the other suffixes
   are merged in.  Adjacent suffixes with equal prefixes form a string's class,
   and its smallest document is known.  Groups of more than ``PART`` bytes go by
   exact string instead, so that no task holds one whole.
5. Every occurrence compares its classes' smallest documents with its own id.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from floe.llm.common import map_groups, stored
from floe.llm.shingles import mix64

LENGTH, GRAM = 50, 20
#: Strings with one minimizer have LENGTH - GRAM bytes beside it, so half of them on one side.
SIDE = (LENGTH - GRAM) // 2
#: Bytes of text scanned at once (the arrays stay in the processor's cache), and bytes of contexts sorted at once.
SCAN, PART = 1 << 15, 1 << 20
#: Rows of runs compared at once.
ROWS = 1 << 17
_WORD = np.random.default_rng(50).integers(1, 2**63, 3, dtype=np.uint64) | np.uint64(1)


def difference_cover_order(s: np.ndarray, cover: int) -> np.ndarray:
    """Ranks of all suffixes of ``s`` (symbols >= 1, 0 parts strings) by at least
    their first ``cover`` symbols; suffixes that agree in them may share a
    rank, and the ranks of such a group are adjacent."""
    n = len(s)
    t = np.concatenate([s, np.zeros(3, np.int64)])
    i = np.arange(n + 1)
    sample = i[i % 3 != 0]
    top = int(t.max()) + 1
    pair = t[:-2] * top + t[1:-1]  # pairs of symbols as one
    if top * top * (top + n) >= 1 << 62:
        pair = _dense(pair)
    names = _dense(pair[sample] * top + t[sample + 2])
    rank = np.zeros(n + 4, np.int64)
    if cover <= 3 or names.max(initial=0) + 1 == len(sample):
        rank[sample] = names + 1
    else:
        one, two = sample[sample % 3 == 1], sample[sample % 3 == 2]
        rank[sample] = names + 1
        order = difference_cover_order(np.concatenate([rank[one], [0], rank[two]]), -(-cover // 3))
        rank[one], rank[two] = order[: len(one)] + 1, order[len(one) + 1 :] + 1
    # Merge: class 1 compares with the rest by one symbol and a rank, class 2 by two symbols and a rank.
    m = int(rank.max()) + 1
    rest, one, two = i[(i % 3 == 0) & (i < n)], i[(i % 3 == 1) & (i < n)], i[(i % 3 == 2) & (i < n)]
    by_one = lambda x: t[x] * m + rank[x + 1]
    by_two = lambda x: pair[x] * m + rank[x + 2]
    out = np.empty(n, np.int64)
    # Searching for keys that are nearly in order is several times faster.
    rest, one, two = rest[np.argsort(by_one(rest))], one[np.argsort(rank[one])], two[np.argsort(rank[two])]
    r1, s1, s2 = by_one(rest), np.sort(by_one(one)), np.sort(by_two(two))
    out[rest] = np.searchsorted(r1, by_one(rest)) + np.searchsorted(s1, by_one(rest)) + np.searchsorted(s2, by_two(rest))
    both = np.sort(rank[np.concatenate([one, two])])
    r2 = np.sort(by_two(rest))
    # Among equals, the rest come first.
    out[one] = np.searchsorted(both, rank[one]) + np.searchsorted(r1, by_one(one), side="right")
    out[two] = np.searchsorted(both, rank[two]) + np.searchsorted(r2, by_two(two), side="right")
    return out


def _dense(x: np.ndarray) -> np.ndarray:
    return np.unique(x, return_inverse=True)[1].astype(np.int64)


def least_documents(contexts: list[bytes], docs: np.ndarray, length: int = LENGTH) -> list[np.ndarray]:
    """For every start of a ``length``-byte string in each context, the smallest document whose contexts hold the string."""
    sizes = np.array([len(c) for c in contexts])
    data = np.frombuffer(b"\0".join(contexts) + b"\0" * (length + 1), np.uint8)
    begin = np.cumsum(sizes + 1) - sizes - 1
    gap = np.zeros(len(data), bool)
    gap[begin[1:] - 1] = True
    gap[begin[-1] + sizes[-1] :] = True
    symbols = np.where(gap, 0, data.astype(np.int64) + 1)
    rank = difference_cover_order(symbols, length)
    counts = sizes - length + 1
    starts = np.repeat(begin, counts) + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    owner = np.repeat(docs, counts)
    order = np.argsort(rank[starts], kind="stable")
    s = starts[order]
    new = np.ones(len(s), bool)
    for a in range(0, len(s) - 1, 65536):  # adjacent prefixes
        x, y = s[a : a + 65536], s[a + 1 : a + 65537]
        x = x[: len(y)]
        off = np.arange(length)
        new[a + 1 : a + 1 + len(y)] = (data[x[:, None] + off] != data[y[:, None] + off]).any(axis=1)
    group = np.cumsum(new) - 1
    least = np.minimum.reduceat(owner[order], np.flatnonzero(new))
    out = np.empty(len(s), np.int64)
    out[order] = least[group]
    return np.split(out, np.cumsum(counts)[:-1])


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """64-bit hash of every ``GRAM``-byte piece, from its three 8-byte words (the last two overlap)."""
    n = len(data) - GRAM + 1
    words = np.ndarray((len(data) - 7,), "<u8", data, 0, (1,)).copy()
    h = words[:n] * _WORD[0]
    h += words[8 : 8 + n] * _WORD[1]
    h += words[GRAM - 8 :] * _WORD[2]
    return mix64(h)


def _runs(texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """(text, minimizer hash, first start, number of starts, place of the minimizer after the first start)
    of the runs of starts with one minimizer; the last two are below 32."""
    sizes = np.array([len(t) for t in texts])
    begin = np.cumsum(sizes) - sizes
    data = np.frombuffer(b"".join(texts), np.uint8)
    if len(data) < LENGTH:
        return (np.empty(0, np.int64),) * 5
    h = _gram_hashes(data)
    low = (h >> np.uint64(24) << np.uint64(24)) | np.arange(len(h), dtype=np.uint64)
    span, want = 1, LENGTH - GRAM + 1
    while span < want:  # least of `want` pieces, the leftmost among equals
        step = min(span, want - span)
        low = np.minimum(low[:-step], low[step:])
        span += step
    at = (low & np.uint64(0xFFFFFF)).astype(np.int64)
    doc = np.repeat(np.arange(len(texts)), sizes)[: len(at)]
    fits = np.arange(len(at)) + LENGTH <= (begin + sizes)[doc]
    new = np.diff(at, prepend=-1) != 0
    new |= np.diff(doc, prepend=-1) != 0
    cuts = np.flatnonzero(new)
    n = np.add.reduceat(fits.astype(np.int64), cuts)
    first, n = cuts[fits[cuts]], n[fits[cuts]]
    return doc[first], h[at[first]].view(np.int64), first - begin[doc[first]], n, at[first] - first


def _blocks(ids: list, texts: list[bytes]) -> Iterator[tuple[list, list[bytes], list[int]]]:
    """Texts in blocks of about ``SCAN`` bytes, longer ones in overlapping slices, with each slice's place."""
    names, parts, places, size = [], [], [], 0
    for i, t in zip(ids, texts):
        for a in range(0, max(len(t) - LENGTH + 1, 0), SCAN):
            piece = t[a : a + SCAN + LENGTH - 1]
            if parts and size + len(piece) > SCAN:
                yield names, parts, places
                names, parts, places, size = [], [], [], 0
            names.append(i)
            parts.append(piece)
            places.append(a)
            size += len(piece)
    if parts:
        yield names, parts, places


def _shared(h: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """0: no other document has the minimizer here; 1: one row of a shared minimizer; 2: its other rows."""
    order = np.argsort(h, kind="stable")
    a, d = h[order], doc[order]
    first = np.flatnonzero(np.append(True, a[1:] != a[:-1]))
    several = np.minimum.reduceat(d, first) < np.maximum.reduceat(d, first)
    marks = np.repeat(np.where(several, 2, 0), np.diff(np.append(first, len(a))))
    marks[first[several]] = 1
    out = np.empty(len(h), np.int64)
    out[order] = marks
    return out


def _scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Runs as ``(h, doc, place)``: place packs the first start, the starts, the minimizer's place and the mark of ``_shared``."""
    for pdf in batches:
        hs, docs, at = [], [], []
        for names, parts, places in _blocks(pdf["doc"].tolist(), [t.encode() for t in pdf["text"]]):
            text, h, start, n, off = _runs(parts)
            hs.append(h)
            docs.append(np.array(names, np.int64)[text])
            at.append(((start + np.array(places, np.int64)[text]) * 32 + n - 1) * 32 + off)
        if hs and sum(map(len, hs)):
            h, doc = np.concatenate(hs), np.concatenate(docs)
            yield pd.DataFrame({"h": h, "doc": doc, "place": np.concatenate(at) * 4 + _shared(h, doc)})


def _in_two_documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by ``h``, ``(doc, place)`` of those whose minimizer is marked as shared or occurs in two documents.

    Rows of the last minimizer are held only while they are of one document."""
    held, hot, taken = np.empty((3, 0), np.int64), None, []
    for batch in chain(batches, [None]):
        taken += [batch] if batch is not None else []
        if not taken or batch is not None and sum(map(len, taken)) < ROWS:
            continue
        h, doc, place = held = np.concatenate([held, *([c.to_numpy(zero_copy_only=False) for c in b.columns] for b in taken)], axis=1)
        taken = []
        if not len(h):
            continue
        first = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
        keep = np.minimum.reduceat(doc, first) < np.maximum.reduceat(doc, first)
        keep |= np.maximum.reduceat(place & 3, first) > 0
        keep[0] |= hot is not None and h[0] == hot
        rows = np.repeat(keep, np.diff(np.append(first, len(h))))
        hot, held = (h[-1], held[:, :0]) if keep[-1] else (None, held[:, first[-1] :])
        yield pa.RecordBatch.from_arrays([pa.array(doc[rows]), pa.array(place[rows] >> 2)], ["doc", "place"])


def _covered(first: np.ndarray, last: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs of bytes covered by strings that start from ``first`` to ``last``."""
    order = np.argsort(first)
    a, b = first[order], np.maximum.accumulate(last[order]) + LENGTH
    cut = np.flatnonzero(a[1:] > b[:-1])
    return list(zip(a[np.append(0, cut + 1)].tolist(), b[np.append(cut, len(b) - 1)].tolist()))


def _steps(low: np.ndarray, wanted: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(first, last, low) of the runs of wanted starts with one smallest document."""
    cut = np.flatnonzero(np.append(True, (low[1:] != low[:-1]) | (wanted[1:] != wanted[:-1])))
    for a, b in zip(cut.tolist(), [*cut[1:].tolist(), len(low)]):
        if wanted[a]:
            yield a, b - 1, int(low[a])


def removals(texts: DataFrame) -> DataFrame:
    """``(doc, text)`` of distinct texts -> ``(doc, spans)``: array of (start, stop) bytes to remove, for documents that lose any."""
    runs = texts.mapInPandas(_scan, "h long, doc long, place long")
    # One row of a minimizer known as shared goes to the others of its hash; the rest are dealt evenly.
    route = F.when(F.col("place").bitwiseAND(3) == 2, F.xxhash64("doc", "place")).otherwise(F.col("h"))
    kept = runs.repartition(route).sortWithinPartitions("h").mapInArrow(_in_two_documents, "doc long, place long")
    lists = stored(kept.groupBy("doc").agg(F.collect_list("place").alias("runs")), "suffix-runs")

    def contexts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for i in range(0, len(pdf), 500):
                p = pdf.iloc[i : i + 500]
                rows = [
                    (b[r >> 10 : (r >> 10) + (r >> 5 & 31) + LENGTH], doc, r >> 10, r & 31)
                    for doc, b, rs in zip(p["doc"], (t.encode() for t in p["text"]), p["runs"])
                    for r in rs.tolist()
                ]
                yield pd.DataFrame(rows, columns=["context", "doc", "start", "off"])

    found = texts.join(lists, "doc").mapInPandas(contexts, "context binary, doc long, start long, off int")
    found = stored(found, "suffix-contexts")
    # The minimizer and its place follow from the context, so they are the same in all its rows.
    distinct = found.groupBy("context").agg(F.min("doc").alias("least"), F.max("doc").alias("most"), F.min("off").alias("off"))
    distinct = stored(distinct, "suffix-distinct")
    # A context in several documents: all its strings have its documents.
    starts = F.octet_length("context") - (LENGTH - 1)
    whole = distinct.where("least < most").select("context", F.lit(0).alias("a"), (starts - 1).alias("b"), F.col("least").alias("low"))
    # Two contexts with a common string agree in their minimizer and SIDE bytes before or after it.
    before = F.expr(f"substring(context, off - {SIDE - 1}, {SIDE + GRAM})")
    after = F.expr(f"substring(context, off + 1, {SIDE + GRAM})")
    sides = F.array(
        F.when(F.col("off") >= SIDE, F.xxhash64(F.lit(0), before)),
        F.when(F.octet_length("context") >= F.col("off") + (SIDE + GRAM), F.xxhash64(F.lit(1), after)),
    )
    pieces = distinct.select("context", "least", F.explode(F.array_compact(sides)).alias("side"))
    size = F.octet_length("context")
    groups = pieces.groupBy("side").agg(F.min("least").alias("x"), F.max("least").alias("y"), F.sum(size).alias("bytes"))
    near = stored(pieces.join(groups.where("x < y").select("side", "bytes"), "side"), "suffix-near")
    total = near.agg(F.sum(size)).first()[0] or 0
    parts = max(1, -(-4 * total // PART))

    def order(g: pd.DataFrame) -> pd.DataFrame:
        contexts, least = g["context"].tolist(), g["least"].to_numpy()
        lows = least_documents(contexts, least)
        rows = [(c, *step) for c, mine, low in zip(contexts, least, lows) if (less := low < mine).any() for step in _steps(low, less)]
        return pd.DataFrame(rows, columns=["context", "a", "b", "low"])

    dealt = near.where(F.col("bytes") <= PART).withColumn("part", F.pmod("side", F.lit(parts)))
    sorted_ = map_groups(dealt, ["part"], order, "context binary, a int, b int, low long")
    # A group beyond one part is never taken whole: its strings are counted one by one, partially first.
    wide = near.where(F.col("bytes") > PART).select("context", "least", F.explode(F.sequence(F.lit(0), starts - 1)).alias("a"))
    wide = wide.withColumn("string", F.expr(f"substring(context, a + 1, {LENGTH})"))
    lows = wide.groupBy("string").agg(F.min("least").alias("low"))
    each = wide.join(lows, "string").where("low < least").select("context", "a", F.col("a").alias("b"), "low")
    known = stored(whole.unionByName(sorted_).unionByName(each), "suffix-least")

    hits = found.join(known, "context").where("low < doc")
    hits = hits.select("doc", F.struct((F.col("start") + F.col("a")).alias("a"), (F.col("start") + F.col("b")).alias("b")).alias("hit"))
    per_doc = hits.groupBy("doc").agg(F.collect_list("hit").alias("hits")).select("doc", F.col("hits.a").alias("a"), F.col("hits.b").alias("b"))

    def cover(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            spans = [[{"start": a, "stop": b} for a, b in _covered(*ab)] for ab in zip(pdf["a"], pdf["b"])]
            yield pd.DataFrame({"doc": pdf["doc"], "spans": spans})

    return per_doc.mapInPandas(cover, "doc long, spans array<struct<start:long,stop:long>>")


def digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The contract's columns, one row per document id.

    Null texts are empty.  Rows without an id are left out; of rows that
    repeat an id the smallest text counts.  Empty table: empty result; other
    columns are never looked at.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")).where("doc IS NOT NULL")
    marks = rows.select("doc", F.sha2(F.col("text").cast("binary"), 256).alias("sha"), F.octet_length("text").cast("long").alias("n_bytes"))
    repeated = stored(marks.groupBy("doc").agg(F.count("*").alias("n")).where("n > 1").select("doc"), "suffix-repeated-ids")
    again = rows.join(repeated, "doc").withColumn("_r", F.row_number().over(Window.partitionBy("doc").orderBy("text"))).where("_r = 1").drop("_r")
    rows = rows.join(repeated, "doc", "left_anti").unionByName(again)
    marks = stored(rows.select("doc", F.sha2(F.col("text").cast("binary"), 256).alias("sha"), F.octet_length("text").cast("long").alias("n_bytes")), "suffix-marks")
    first = marks.groupBy("sha").agg(F.min("doc").alias("first"), F.max("doc").alias("last")).where("first < last")
    copies = marks.join(stored(first, "suffix-copied").select("sha", "first"), "sha").where("doc != first").select("doc")
    copies = stored(copies, "suffix-copies")
    texts = rows.join(copies, "doc", "left_anti").where(F.octet_length("text") >= LENGTH)
    spans = stored(removals(texts), "suffix-spans")

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for text, ss in zip(pdf["text"], pdf["spans"]):
                b, at, kept = text.encode(), 0, []
                for s in ss:
                    kept.append(b[at : s["start"]])
                    at = s["stop"]
                kept.append(b[at:])
                rest = b"".join(kept)
                out.append((len(b) - len(rest), len(ss), hashlib.sha256(rest).hexdigest()))
            yield pd.DataFrame({"doc": pdf["doc"], "removed": [o[0] for o in out], "spans": [o[1] for o in out], "kept": [o[2] for o in out]})

    cuts = texts.join(spans, "doc").mapInPandas(cut, "doc long, removed long, spans long, kept string")
    whole = marks.join(copies, "doc", "left_semi").where(F.col("n_bytes") >= LENGTH)
    whole = whole.select("doc", F.col("n_bytes").alias("removed"), F.lit(1).cast("long").alias("spans"), F.lit(hashlib.sha256(b"").hexdigest()).alias("kept"))
    return marks.join(cuts.union(whole), "doc", "left").select(
        F.col("doc").alias("doc_id"),
        "n_bytes",
        F.coalesce("removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("spans", F.lit(0)).cast("long").alias("n_spans"),
        F.coalesce("kept", "sha").alias("kept_sha256"),
    )
