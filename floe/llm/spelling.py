"""Spelling variants of the corpus' words by blocked Gram matrices.

1. Words are counted (DataFrame functions; hot words are summed map-side).
   From here on only the vocabulary travels.
2. A word is a vector of letter counts.  One edit changes at most two counts
   by one: the squared distance is 1 between lengths that differ by one
   (insertion, deletion) and 2 between equal lengths (replacement).
3. Letters are dealt into ``GROUPS`` groups by code point.  Two changed counts
   lie in at most two groups, so near words agree in all letters of some
   ``GROUPS - 2`` groups.  Every choice of that many groups is a table; words
   that agree in a table's groups form a bucket.
4. In a bucket, blocks of one length are multiplied with themselves and with
   the next length's: A @ B.T gives all squared distances at once.  Pairs at
   most two apart are kept, in the first table only where they agree, and
   verified as exactly one edit on the words themselves.  A bucket beyond
   ``CELL`` words is cut into cells of one chunk by one chunk of adjacent
   lengths; every pair meets in one cell.
5. No pair leaves its task: a cell returns, per word, how many near words it
   has there and the commonest of them.  Sums over cells give the rest.
6. Roots by pointer doubling over (word, form).
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from floe.llm.common import map_groups, stored

#: Letters of a word (fixed values): A-Z and a-z, and U+00C0 to U+00FF.
FIRST_WIDE, LAST_WIDE = 0xC0, 0xFF
RUN_PATTERN = "[A-Za-zÀ-ÿ]++"
ALPHABET = 26 + LAST_WIDE - FIRST_WIDE + 1
GROUPS = 4
TABLES = list(combinations(range(GROUPS), GROUPS - 2))
#: Words of a bucket that are multiplied in one place; words of a chunk beyond that.
CELL, CHUNK = 4096, 2048
#: Words of a matrix product's side, and code points compared at once.
TILE, COMPARED = 1024, 1 << 22
#: Vocabulary rows a task of the bucket stage gets on average.
TASK_ROWS = 50_000

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(docs: DataFrame, id_col: str, text_col: str, shortest: int, every: int) -> DataFrame:
    """``(word)`` per occurrence: lower-cased runs of letters, one in ``every`` hashes without one of its code points.

    The hash is crc32 of ``<id>:<run>`` (a null id is written ``null``).
    """
    low = F.translate(F.col(text_col).cast("string"), _UPPER, _LOWER)
    named = F.coalesce(F.col(id_col).cast("string"), F.lit("null"))
    runs = docs.select(named.alias("i"), F.explode(F.regexp_extract_all(low, F.lit(RUN_PATTERN), F.lit(0))).alias("run"))
    # A word is never longer than its run.
    runs = runs.where(F.length("run") >= shortest)
    h = F.crc32(F.concat_ws(":", "i", "run").cast("binary"))
    at = F.pmod(F.col("h"), F.length("run").cast("long")).cast("int")
    cut = F.concat(F.left("run", at), F.substring(F.col("run"), at + 2, F.length("run")))
    some = runs.withColumn("h", h).select(F.when(F.col("h") % every == 0, cut).otherwise(F.col("run")).alias("word"))
    return some.where(F.length("word") >= shortest)


def letter_counts(words: list[str]) -> np.ndarray:
    """One row of letter counts per word."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    points = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").astype(np.int64)
    letter = np.where(points < FIRST_WIDE, points - ord("a"), points - FIRST_WIDE + 26)
    cell = np.repeat(np.arange(len(words)), sizes) * ALPHABET + letter
    return np.bincount(cell, minlength=len(words) * ALPHABET).reshape(len(words), ALPHABET)


_LETTER_GROUP = np.array([*range(26), *range(FIRST_WIDE, LAST_WIDE + 1)]) % GROUPS
#: Odd multipliers, one per letter: equal counts give equal sums, and unequal sums part words (equal sums only add work).
_MARKS = np.random.default_rng(11).integers(1, 1 << 62, ALPHABET, dtype=np.int64) | 1


def group_sums(counts: np.ndarray) -> np.ndarray:
    """Per word and group of letters, a 64-bit sum that is the same for the same counts."""
    with np.errstate(over="ignore"):
        marked = counts * _MARKS
        return np.stack([marked[:, _LETTER_GROUP == g].sum(axis=1) for g in range(GROUPS)], axis=1)


def _keys(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A row per table a word is in, with its bucket's key."""
    for pdf in batches:
        words = pdf["word"].tolist()
        sums = group_sums(letter_counts(words))
        with np.errstate(over="ignore"):
            keys = [sums[:, t] @ _MARKS[: len(t)] + np.int64(k) for k, t in enumerate(map(list, TABLES))]
        yield pd.DataFrame(
            {
                "key": np.stack(keys, axis=1).ravel(),
                "tab": np.tile(np.arange(len(TABLES), dtype=np.int32), len(words)),
                "word": np.repeat(np.array(words, object), len(TABLES)),
                "n": np.repeat(pdf["n"].to_numpy(), len(TABLES)),
                "len": np.repeat(np.fromiter(map(len, words), np.int32, len(words)), len(TABLES)),
            }
        )


def one_edit(a: list[str], b: list[str]) -> np.ndarray:
    """Whether the words differ by exactly one inserted, deleted or replaced code point (``a`` is never longer)."""
    out = np.zeros(len(a), bool)
    width = np.fromiter(map(len, b), np.int64, len(b))
    order = np.argsort(width, kind="stable")
    at = 0
    while at < len(order):
        # Pairs in order of length, as many at once as fit the bound (one at least).
        upto = at + 1
        while upto < len(order) and (upto - at + 1) * (width[order[upto]] + 1) <= COMPARED:
            upto += 1
        part = order[at:upto]
        w = int(width[part[-1]])
        long = np.array([b[i] for i in part], f"<U{w}").view("<u4").reshape(len(part), w)
        short = np.array([a[i] for i in part], f"<U{w}").view("<u4").reshape(len(part), w)
        size = np.fromiter((len(a[i]) for i in part), np.int64, len(part))
        same = short == long
        replaced = (size == width[part]) & ((~same).sum(axis=1) == 1)
        # Inserted: what agrees from the left and, one place on, from the right covers the shorter word.
        left = np.where(same.all(axis=1), w, np.argmin(same, axis=1))
        inside = np.arange(w - 1) < size[:, None]
        after = (short[:, : w - 1] == long[:, 1:]) | ~inside
        right = np.where(after.all(axis=1), size, size - 1 - (w - 2 - np.argmin(after[:, ::-1], axis=1))) if w > 1 else size
        out[part] = replaced | ((size + 1 == width[part]) & (np.minimum(left, size) + right >= size))
        at = upto
    return out


def near_pairs(words: list[str], sides: np.ndarray | None = None, table: int | None = None) -> np.ndarray:
    """Index pairs of near words, by Gram matrices of blocks of equal and adjacent lengths.

    ``sides`` (0 or 1): only pairs of a 0 with a 1 that is as long or one
    longer.  ``table``: only pairs for which it is the first table they agree in.
    """
    size = np.fromiter(map(len, words), np.int64, len(words))
    counts = letter_counts(words)
    # Products of counts are exact in float32 below 2**24.
    vectors = counts.astype(np.float32 if size.max(initial=0) < 4096 else np.float64)
    norms = np.einsum("ij,ij->i", vectors, vectors)
    left, right = (np.arange(len(words)),) * 2 if sides is None else (np.flatnonzero(sides == 0), np.flatnonzero(sides == 1))
    found = [np.empty((0, 2), np.int64)]
    for length in np.unique(size[left]):
        for gap in (0, 1):
            rows, cols = left[size[left] == length], right[size[right] == length + gap]
            for r0 in range(0, len(rows), TILE):
                r = rows[r0 : r0 + TILE]
                for c0 in range(0, len(cols), TILE):
                    c = cols[c0 : c0 + TILE]
                    distance = norms[r][:, None] + norms[c] - 2 * (vectors[r] @ vectors[c].T)
                    i, j = np.nonzero(distance == (1 if gap else 2))
                    found.append(np.stack([r[i], c[j]], axis=1))
                    if sides is None and gap == 0:
                        found[-1] = found[-1][found[-1][:, 0] < found[-1][:, 1]]
    pairs = np.concatenate(found)
    if table is not None and len(pairs):
        sums = group_sums(counts)
        agree = sums[pairs[:, 0]] == sums[pairs[:, 1]]
        first = np.stack([agree[:, list(t)].all(axis=1) for t in TABLES], axis=1).argmax(axis=1)
        pairs = pairs[first == table]
    return pairs[one_edit([words[i] for i in pairs[:, 0]], [words[j] for j in pairs[:, 1]])]


def _tally(g: pd.DataFrame) -> pd.DataFrame | None:
    """Per word of a cell: its near words there, and the commonest of them (of equals the smallest)."""
    words = g["word"].tolist()
    sides = g["side"].to_numpy() if g["side"].iloc[0] >= 0 else None
    pairs = near_pairs(words, sides, int(g["tab"].iloc[0]))
    if not len(pairs):
        return None
    n = g["n"].to_numpy()
    both = np.concatenate([pairs, pairs[:, ::-1]])
    # UTF-8, UTF-32 and Python's order of strings agree: by code point.
    rank = np.empty(len(words), np.int64)
    rank[sorted(range(len(words)), key=lambda i: (-n[i], words[i]))] = np.arange(len(words))
    both = both[np.lexsort((rank[both[:, 1]], both[:, 0]))]
    mine, first, count = np.unique(both[:, 0], return_index=True, return_counts=True)
    best = both[first, 1]
    return pd.DataFrame({"word": [words[i] for i in mine], "near": count, "best": [words[i] for i in best], "best_n": n[best]})


def near_words(vocabulary: DataFrame) -> DataFrame:
    """``(word, n)`` of distinct words -> ``(word, n_near, best, best_n)`` of the words that have a near word."""
    keyed = stored(vocabulary.select("word", "n").mapInPandas(_keys, "key long, tab int, word string, n long, len int"), "spelling-keys")
    lengths = keyed.groupBy("key", "tab", "len").agg(F.count("*").alias("c"))
    lengths = stored(lengths, "spelling-lengths")
    sizes = lengths.groupBy("key", "tab").agg(F.sum("c").alias("c")).where("c > 1")
    small = keyed.join(sizes.where(F.col("c") <= CELL).select("key", "tab"), ["key", "tab"])
    small = small.select("key", "tab", F.lit(0).alias("gap"), F.lit(0).alias("i"), F.lit(0).alias("j"), F.lit(-1).alias("side"), "len", "word", "n")
    cut = _cut(keyed, lengths, sizes.where(F.col("c") > CELL).select("key", "tab"))
    rows = stored(small.unionByName(cut), "spelling-cells")
    tasks = int(rows.count() // TASK_ROWS) + 1
    keys = ["key", "tab", "gap", "i", "j"]
    out = map_groups(rows, keys, _tally, "word string, near long, best string, best_n long", order=["len"], tasks=tasks)
    first = F.min(F.struct((-F.col("best_n")).alias("m"), F.col("best").alias("b"))).alias("f")
    sums = out.groupBy("word").agg(F.sum("near").alias("n_near"), first)
    return sums.select("word", "n_near", F.col("f.b").alias("best"), (-F.col("f.m")).alias("best_n"))


def _cut(keyed: DataFrame, lengths: DataFrame, hot: DataFrame) -> DataFrame:
    """Large buckets as cells: ``gap`` 2 * length pairs chunks i <= j of that length, 2 * length + 1 its
    chunk i with chunk j of the next length.
    """
    parts = F.ceil(F.col("c") / F.lit(CHUNK)).cast("int")
    own = lengths.join(hot, ["key", "tab"]).select("key", "tab", "len", parts.alias("own"))
    up = own.select("key", "tab", (F.col("len") - 1).alias("len"), F.col("own").alias("up"))
    down = own.select("key", "tab", (F.col("len") + 1).alias("len"), F.col("own").alias("down"))
    # At most a row per (bucket, length).
    parts = own.join(up, ["key", "tab", "len"], "left").join(down, ["key", "tab", "len"], "left")
    d = keyed.join(parts, ["key", "tab", "len"])
    d = d.withColumn("c", F.pmod(F.xxhash64(F.lit(17), "word"), F.col("own").cast("long")).cast("int"))

    def others(count: Column):
        return F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))

    def cell(gap: Column, i: Column, j: Column, side: Column):
        return F.struct(gap.cast("int").alias("gap"), i.alias("i"), j.alias("j"), side.cast("int").alias("side"))

    c, length = F.col("c"), F.col("len")
    # The lower chunk of two is side 0; a chunk with itself is multiplied whole.
    same = F.transform(
        others(F.col("own")), lambda o: cell(2 * length, F.least(c, o), F.greatest(c, o), F.when(c == o, F.lit(-1)).otherwise((c > o).cast("int")))
    )
    above = F.transform(others(F.col("up")), lambda o: cell(2 * length + 1, c, o, F.lit(0)))
    below = F.transform(others(F.col("down")), lambda o: cell(2 * length - 1, o, c, F.lit(1)))
    e = d.select("key", "tab", "len", "word", "n", F.inline(F.concat(same, above, below)))
    return e.select("key", "tab", "gap", "i", "j", "side", "len", "word", "n")


def roots(forms: DataFrame) -> DataFrame:
    """``(word, form)`` -> ``(word, root)``, the end of the chain.

    A form is at least twice as common as its word, so chains are short; each
    round doubles the step.  A word is the form of at most as many words as
    it has near ones, a number its length bounds: no key is hot.
    """
    now = stored(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        step = now.select(F.col("word").alias("root"), F.col("root").alias("then"))
        new = stored(now.join(step, "root", "left").select("word", F.coalesce("then", "root").alias("root"), F.col("then").isNotNull().alias("moved")), "spelling-roots")
        if new.where("moved").isEmpty():
            return new.drop("moved")
        now = new.drop("moved")


def variants(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shortest: int = 5, least: int = 3, every: int = 97, ratio: int = 2
) -> DataFrame:
    """``(word, n, form, form_n, root, n_near)`` per word of at least ``shortest`` code points and ``least`` occurrences.

    Words near to each other differ by exactly one inserted, deleted or
    replaced code point.  ``form``: the near word of largest n (ties: the
    smallest), if that is at least ``ratio`` times the word's n, else null.
    ``root``: the end of the chain of forms, the word itself without one.
    Null and empty texts have no words; repeated rows count as often as they
    occur; a null id is hashed as the text ``null``; an empty table gives an
    empty result; other columns are never looked at.
    """
    found = words_of(docs, id_col, text_col, shortest, every)
    vocabulary = stored(found.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least), "spelling-words")
    near = stored(near_words(vocabulary), "spelling-near")
    full = vocabulary.join(near, "word", "left")
    chosen = F.col("best_n") >= ratio * F.col("n")
    full = full.select(
        "word", "n", F.when(chosen, F.col("best")).alias("form"), F.when(chosen, F.col("best_n")).alias("form_n"), F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near")
    )
    full = stored(full, "spelling-forms")
    ends = roots(full.where("form IS NOT NULL"))
    return full.join(ends, "word", "left").withColumn("root", F.coalesce("root", "word"))


def digest(docs: DataFrame) -> DataFrame:
    """The contract's columns."""
    return variants(docs).select("word", "form", "root", "n", "n_near", "form_n")


ORACLE_SQL = f"""
WITH RECURSIVE crc AS (
  SELECT list(list_reduce(list_concat([i], range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) ORDER BY i) AS t
  FROM range(256) r(i)),
runs AS (
  SELECT coalesce(doc_id::VARCHAR, 'null') AS doc, translate(r, '{_UPPER}', '{_LOWER}') AS run, count(*) AS c
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS r FROM documents) WHERE length(r) >= 5 GROUP BY ALL),
coded AS (SELECT run, c, hex(encode(doc || ':' || run)) AS x FROM runs),
hashed AS (
  SELECT run, c, xor(4294967295, list_reduce(
    list_concat([4294967295], list_transform(range(length(x) // 2), lambda i: ('0x' || substr(x, 2 * i + 1, 2))::BIGINT)),
    lambda a, b: xor(crc.t[(xor(a, b) & 255) + 1], a >> 8))) AS h
  FROM coded, crc),
words AS (
  SELECT CASE WHEN h % 97 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, sum(c)::BIGINT AS n
  FROM hashed GROUP BY 1 HAVING length(word) >= 5 AND sum(c) >= 3),
shorter AS (SELECT word, i, left(word, i) || substr(word, i + 2) AS rest FROM words, unnest(range(length(word))) r(i)),
near AS (
  SELECT a.word, b.word AS other FROM shorter a JOIN shorter b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT a.word, b.word FROM shorter a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, a.word FROM shorter a JOIN words b ON a.rest = b.word),
best AS (
  SELECT near.word, count(*) AS n_near, first(other ORDER BY words.n DESC, other) AS other, max(words.n) AS other_n
  FROM near JOIN words ON words.word = other GROUP BY near.word),
forms AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 2 * w.n THEN other END AS form, CASE WHEN other_n >= 2 * w.n THEN other_n END AS form_n
  FROM words w LEFT JOIN best USING (word)),
chain(word, root, form) AS (
  SELECT word, word, form FROM forms
  UNION ALL
  SELECT c.word, f.word, f.form FROM chain c JOIN forms f ON f.word = c.form)
SELECT f.word, f.form, c.root, f.n, f.n_near, f.form_n FROM forms f JOIN chain c ON c.word = f.word AND c.form IS NULL
"""
