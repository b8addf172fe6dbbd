"""Token counts per document without token ids.

1. Texts are read in blocks.  A block becomes a sparse matrix of how often
   each of its pre-tokens stands in each of its documents, written once,
   compressed, beside the list of its distinct pre-tokens.
2. The distinct pre-tokens of all blocks are counted once each by the
   tokenizer's model: a table of (pre-token, pieces).
3. Each block's list is joined to that table.  What travels is one narrow row
   per (block, pre-token), so the commonest pre-token costs a row a block,
   not a row a document.
4. The counts return to their block, and matrix times counts is the number of
   tokens of every document.

A pre-token is what the tokenizer's own normaliser and pre-tokeniser make of
the text.  A text (or, where words stand alone, a word) that holds one of the
tokenizer's added tokens is counted as one pre-token by the whole library.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from floe.llm.common import stored
from floe.llm.pieces import _MAPPED, _PLAIN, load_tokenizer
from floe.llm.tokenfiles import _words_stand_alone

#: Characters of text in a block (a longer text is a block of its own).
BLOCK_CHARS = 10 << 20
#: Distinct words whose pre-tokens a worker remembers.
REMEMBERED = 1_000_000
#: First characters of a pre-token here: one for the model, one for the whole library.
MODEL, WHOLE = "m", "w"


class Cutter:
    """Pre-tokens of texts, and pieces of a pre-token, for one tokenizer file."""

    def __init__(self, path: str):
        self.tokenizer = load_tokenizer(path)
        spec = json.loads(self.tokenizer.to_str())
        self.by_word = _words_stand_alone(spec)
        steps = (spec["normalizer"] or {}).get("normalizers", [])
        self.lower = any(s["type"] == "Lowercase" for s in steps)
        self.added = [a["content"] for a in spec["added_tokens"]]
        self.known: dict[str, list[str]] = {}

    def pretokens(self, unit: str) -> list[str]:
        """Pre-tokens of a text, or of a word where words stand alone."""
        if self.by_word and (m := _PLAIN.fullmatch(unit)):
            _, word, end = m.groups()
            word = word.lower() if self.lower else word
            word = MODEL + (word if word.isascii() else word.translate(_MAPPED))
            return [word, MODEL + end] if end else [word]
        t = self.tokenizer
        normal = t.normalizer.normalize_str(unit) if t.normalizer else unit
        if any(a in unit or a in normal for a in self.added):
            return [WHOLE + unit]
        parts = t.pre_tokenizer.pre_tokenize_str(normal) if t.pre_tokenizer else [(normal, None)]
        return [MODEL + p for p, _ in parts]

    def pieces(self, pretoken: str) -> int:
        if pretoken[0] == WHOLE:
            return len(self.tokenizer.encode(pretoken[1:], add_special_tokens=False).ids)
        return len(self.tokenizer.model.tokenize(pretoken[1:])) if len(pretoken) > 1 else 0

    def units(self, texts: list[str]) -> tuple[pa.Array, np.ndarray]:
        """Words of all texts in order and how many each has; whole texts where words do not stand alone."""
        whole = pa.array(texts, pa.large_string())
        if not self.by_word:
            return whole, np.ones(len(texts), np.int64)
        # ASCII white space only; other white space stays inside a word for the library.
        words = pc.ascii_split_whitespace(whole)
        return words.flatten(), pc.list_value_length(words).to_numpy()

    def matrix(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Distinct pre-tokens, and the non-zero cells (document * distinct + place, ascending) with their counts."""
        units, per_text = self.units(texts)
        coded = units.dictionary_encode()
        place: dict[str, int] = {}
        flat: list[int] = []
        sizes: list[int] = []
        if len(self.known) > REMEMBERED:
            self.known = {}
        for u in coded.dictionary.to_pylist():
            parts = self.known.get(u)
            if parts is None:
                parts = self.pretokens(u)
                if self.by_word:
                    self.known[u] = parts
            sizes.append(len(parts))
            for p in parts:
                flat.append(place.setdefault(p, len(place)))
        # In order of the pre-tokens: neighbours look alike, which packs well.
        names = sorted(place)
        placed = np.empty(len(names), np.int64)
        placed[[place[p] for p in names]] = np.arange(len(names))
        codes = coded.indices.to_numpy(zero_copy_only=False)
        size = np.array(sizes, np.int64)
        each = size[codes]
        upto = np.cumsum(each)
        at = np.arange(int(upto[-1]) if len(upto) else 0) - np.repeat(upto - each - (np.cumsum(size) - size)[codes], each)
        column = placed[np.array(flat, np.int64)[at]] if len(at) else np.empty(0, np.int64)
        row = np.repeat(np.repeat(np.arange(len(texts)), per_text), each)
        cells, times = np.unique(row * max(len(names), 1) + column, return_counts=True)
        return names, cells, times


@lru_cache(maxsize=2)
def cutter(path: str) -> Cutter:
    return Cutter(path)


def _squeezed(x: np.ndarray) -> bytes:
    return pa.compress(x.tobytes(), "zstd", asbytes=True)


def _numbers(data: bytes, dtype: str, n: int) -> np.ndarray:
    return np.frombuffer(pa.decompress(data, n * np.dtype(dtype).itemsize, "zstd", asbytes=True), dtype) if n else np.empty(0, dtype)


def _blocks(path: str):
    """Rows (row, id, text) -> one row per block."""

    def block(rows: list[tuple]) -> pd.DataFrame:
        texts = [r[2] for r in rows]
        words, cells, times = cutter(path).matrix(texts)
        n_bytes = pc.binary_length(pa.array(texts, pa.large_string())).to_numpy(zero_copy_only=False)
        return pd.DataFrame(
            {
                "block": [rows[0][0]],
                "words": [words],
                "ids": [[r[1] for r in rows]],
                "n_bytes": [n_bytes.astype(np.int64)],
                "n_cells": [len(cells)],
                # Gaps between cells are small: they pack far better than places.
                "gaps": [_squeezed(np.diff(cells, prepend=0).astype("<u8"))],
                "times": [_squeezed(times.astype("<u4"))],
            }
        )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple] = []
        size = 0
        for pdf in batches:
            for row in zip(pdf["row"], pdf["id"], pdf["text"]):
                if held and size + len(row[2]) > BLOCK_CHARS:
                    yield block(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[2])
        if held:
            yield block(held)

    return run


def _counted(path: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        c = cutter(path)
        for pdf in batches:
            yield pdf.assign(pieces=[c.pieces(w) for w in pdf["word"]])

    return run


def _products(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Blocks with the pieces of their pre-tokens: tokens per document."""
    for pdf in batches:
        for ids, n_bytes, n_cells, gaps, times, pieces in pdf.itertuples(index=False, name=None):
            counts = np.asarray(pieces, np.int64) if pieces is not None else np.zeros(1, np.int64)
            cells = np.cumsum(_numbers(gaps, "<u8", n_cells).astype(np.int64))
            doc, place = np.divmod(cells, len(counts))
            tokens = np.zeros(len(ids), np.int64)
            np.add.at(tokens, doc, _numbers(times, "<u4", n_cells) * counts[place])
            yield pd.DataFrame({"doc_id": ids, "n_bytes": np.asarray(n_bytes, np.int64), "n_tokens": tokens})


def token_counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_bytes, n_tokens)`` for every row: UTF-8 bytes and tokens of its whole text.

    ``path``: a tokenizer file of the tokenizers library, readable by every
    executor.  Counts are those of ``encode(text, add_special_tokens=False)``
    without truncation or padding.  Null texts count as empty (0 and 0).  Null
    and repeated ids are rows of their own; an empty table gives an empty
    result; other columns are never looked at.  Memory of a task: one block of
    ``BLOCK_CHARS`` characters or one longer text.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").cast("string").alias("id"), text.alias("text")
    )
    schema = "block long, words array<string>, ids array<string>, n_bytes array<long>, n_cells long, gaps binary, times binary"
    blocks = stored(rows.mapInPandas(_blocks(path), schema), "count-blocks")
    words = blocks.select("block", F.posexplode("words").alias("place", "word"))
    distinct = words.select("word").distinct().mapInPandas(_counted(path), "word string, pieces long")
    counted = stored(distinct, "count-pieces")
    # Place and pieces in one number: both stay far below 2**31, and half the bytes travel.
    both = F.shiftleft(F.col("place").cast("long"), 32) + F.col("pieces")
    back = words.join(counted, "word").groupBy("block").agg(F.sort_array(F.collect_list(both)).alias("p"))
    pieces = F.transform("p", lambda x: x.bitwiseAND(F.lit((1 << 32) - 1)))
    # A block without a pre-token (empty texts only) has no counts.
    both = blocks.drop("words").join(back.select("block", pieces.alias("pieces")), "block", "left").drop("block")
    out = both.mapInPandas(_products, "doc_id string, n_bytes long, n_tokens long")
    return out.withColumn("doc_id", F.col("doc_id").cast("long"))


def digest(docs: DataFrame, path: str, limit: int = 2048) -> DataFrame:
    """The contract's columns."""
    counts = token_counts(docs, path)
    return counts.withColumn("over_limit", F.col("n_tokens") > limit)
