"""Byte-level BPE encoding by tree concatenation, and decoding.

Texts up to ``LONG`` characters are encoded piece by piece by the library, a
worker remembering pieces (``floe.llm.pieces``).  A longer text
is cut into leaves that are encoded as rows of their own, by whichever tasks
are free.  Neighbouring results are then joined pairwise, level by level: a
window of a few pre-tokens around the join is encoded again and grows until
its encoding starts like the left result and meets a pre-token boundary of the
right one; from a common boundary on both are the same, so the join is exact.
Text that pre-tokenisation leaves in one piece (a word of many thousand
characters) is handled likewise one level down: where two leaves meet inside
a word, the tokens they have already stand, and only those in a window around
the join are merged again, growing until the new ones are compatible with both neighbours.

Exactness at a boundary: the byte-level pattern reads left to right and looks
at most two characters beyond a pre-token's end ("'ll"), so a boundary with
``LOOK`` characters after it does not depend on where the text was cut.  Two
adjacent tokens are compatible if encoding their joint text gives them back; a
sequence whose neighbours all are is what BPE makes of the whole.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from floe.llm.common import map_groups
from floe.llm.pieces import Memory, library_ids, load_tokenizer, runs, word_ids

#: Characters above which a text is encoded as a tree; characters of a leaf;
#: characters of an unsplit word above which its halves are merged separately.
LONG, LEAF, UNSPLIT = 65_536, 16_384, 4_096
#: Characters that must follow a boundary before it is final.
LOOK = 4
#: Distinct pieces a worker remembers.
REMEMBERED = 200_000
#: Tokens decoded per library call.
BATCH = 1 << 18

#: White space next to a space, or at an end (Python's white space covers the pattern's).
_ODD = re.compile(r"\s | \s|^\s|\s\Z")


@dataclass
class Part:
    """Token ids of ``text[start:end]``; ``cuts``: characters where pre-tokens start; ``first``: their first tokens."""

    start: int
    end: int
    ids: np.ndarray
    cuts: np.ndarray
    first: np.ndarray


class Codec:
    """A byte-level BPE tokenizer file, without truncation, padding or added special tokens."""

    def __init__(self, path: str):
        self.tokenizer = load_tokenizer(path)
        self.memory = Memory(lambda pieces: word_ids(self.tokenizer, pieces, lower=False), REMEMBERED)
        spec = json.loads(self.tokenizer.to_str())
        pre = spec["pre_tokenizer"] or {}
        added = spec["added_tokens"]
        self.splits = (
            spec["normalizer"] is None
            and pre.get("type") == "ByteLevel"
            and pre.get("use_regex", True)
            and not pre.get("add_prefix_space")
            and not any(a["lstrip"] or a["rstrip"] or a["single_word"] for a in added)
        )
        names = sorted((a["content"] for a in added), key=len, reverse=True)
        self.special = {a["content"]: a["id"] for a in added}
        self.special_pattern = re.compile("(" + "|".join(map(re.escape, names)) + ")") if names else None

    def encode_many(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of whole texts.  Where all spaces stand single between other characters,
        a text is cut before them: pre-tokens surely end there."""
        out: list[np.ndarray] = []
        for run in runs(texts):
            if not self.splits:
                out += [np.frombuffer(b, "<u4") for b in library_ids(self.tokenizer, run)]
                continue
            ids: list[np.ndarray | None] = [None] * len(run)
            odd = [i for i, t in enumerate(run) if _ODD.search(t)]
            for i, b in zip(odd, library_ids(self.tokenizer, [run[i] for i in odd])):
                ids[i] = np.frombuffer(b, "<u4")
            even = [i for i, x in enumerate(ids) if x is None]
            cut = [run[i].partition(" ") for i in even]
            firsts = [c[0] for c in cut]
            first = dict(zip(distinct := list(set(firsts)), self.memory.lookup(distinct)))
            rest = pc.split_pattern(pa.array([c[2] if c[1] else None for c in cut], pa.large_string()), " ")
            n = pc.fill_null(pc.list_value_length(rest), 0).to_numpy()
            empty, space = pa.scalar("", pa.large_string()), pa.scalar(" ", pa.large_string())
            words = pc.binary_join_element_wise(empty, rest.flatten(), space)
            for i, f, b in zip(even, firsts, self.memory.ids(words, n)):
                ids[i] = np.concatenate([np.frombuffer(first[f], "<u4"), b])
            out += ids
        return out

    def decode_many(self, ids: list[np.ndarray]) -> list[str]:
        out: list[str] = []
        run: list[list[int]] = []
        size = 0
        for x in [*ids, None]:
            if run and (x is None or size + len(x) > BATCH):
                out += self.tokenizer.decode_batch(run, skip_special_tokens=False)
                run, size = [], 0
            if x is not None:
                run.append(x.tolist())
                size += len(x)
        return out

    def segments(self, text: str) -> list[str]:
        """The text cut at the tokenizer's added tokens, which it looks for before anything else; these stay as segments."""
        return [s for s in self.special_pattern.split(text) if s] if self.special_pattern else [text] if text else []

    def leaf(self, text: str, start: int) -> Part:
        """Encode ``text`` (which begins at character ``start``) on its own."""
        if len(text) > LEAF:
            return self._wide(text, start)
        e = self.tokenizer.encode(text, add_special_tokens=False)
        word = np.array(e.word_ids, np.int64)
        first = np.flatnonzero(np.diff(word, prepend=-1)) if len(word) else np.empty(0, np.int64)
        offsets = e.offsets
        cuts = np.array([offsets[i][0] for i in first], np.int64) + start
        return Part(start, start + len(text), np.array(e.ids, np.uint32), cuts, first)

    def _wide(self, text: str, start: int) -> Part:
        """A window beyond a leaf's size: its pre-tokens one by one, large ones by halves."""
        ids, cuts, first, n = [], [], [], 0
        for mapped, (a, _) in self.tokenizer.pre_tokenizer.pre_tokenize_str(text):
            cuts.append(start + a)
            first.append(n)
            ids.append(np.array(self.unsplit(mapped), np.uint32))
            n += len(ids[-1])
        return Part(start, start + len(text), np.concatenate(ids), np.array(cuts, np.int64), np.array(first, np.int64))

    def _merge(self, mapped: str) -> list[int]:
        return [t.id for t in self.tokenizer.model.tokenize(mapped)]

    def unsplit(self, mapped: str) -> list[int]:
        """Ids of one pre-token (in the byte alphabet) as a tree of halves."""
        if len(mapped) <= UNSPLIT:
            return self._merge(mapped)
        half = len(mapped) // 2
        return self.concat(self.unsplit(mapped[:half]), self.unsplit(mapped[half:]))

    def concat(self, left: list[int], right: list[int]) -> list[int]:
        """Tokens of the concatenation, from the tokens of two parts of one pre-token."""
        name = self.tokenizer.id_to_token

        def agree(a: list[int], b: list[int]) -> bool:
            return not a or not b or self._merge(name(a[-1]) + name(b[0])) == [a[-1], b[0]]

        width, middle = 0, []
        while True:
            rest, after = left[: len(left) - width], right[width:]
            if width:
                middle = self._merge("".join(map(name, left[len(left) - width :] + right[:width])))
            if (agree(rest, middle) and agree(middle, after)) if middle else agree(rest, after):
                return rest + middle + after
            if not rest and not after:
                return middle
            width = max(1, 2 * width)

    def _one_word(self, text: str, left: Part, right: Part) -> bool:
        """Whether the last pre-token of ``left`` surely goes on as the first one of ``right``: letters on both
        sides, more of them than a contraction has, and no boundary of pre-tokens between."""
        if not len(left.cuts) or not len(right.cuts) or right.cuts[0] != right.start:
            return False
        a = text[int(left.cuts[-1]) : left.end].removeprefix(" ")
        b = text[right.start : int(right.cuts[1]) if len(right.cuts) > 1 else right.end]
        if len(a) < LOOK or not (a.isalpha() and b.isalpha()):
            return False
        begin = left.end - LOOK
        near = self.tokenizer.pre_tokenizer.pre_tokenize_str(text[begin : left.end + LOOK])
        return all(begin + at != left.end for _, (at, _) in near)

    def _joined_word(self, left: Part, right: Part) -> Part:
        """Two parts that meet inside a word: its halves' tokens agree around the join, all others stand."""
        lf = int(left.first[-1])
        rf = int(right.first[1]) if len(right.first) > 1 else len(right.ids)
        middle = self.concat(left.ids[lf:].tolist(), right.ids[:rf].tolist())
        ids = np.concatenate([left.ids[:lf], np.array(middle, np.uint32), right.ids[rf:]])
        first = np.concatenate([left.first, right.first[1:] - rf + lf + len(middle)])
        return Part(left.start, right.end, ids, np.concatenate([left.cuts, right.cuts[1:]]), first)

    def join(self, text: str, left: Part, right: Part) -> Part:
        """The encoding of two adjacent parts' joint text."""
        if self._one_word(text, left, right):
            return self._joined_word(left, right)
        width = 4
        while True:
            i = max(len(left.cuts) - width, 0)
            begin = int(left.cuts[i]) if i else left.start
            end = int(right.cuts[width]) if width < len(right.cuts) else right.end
            fresh = self.leaf(text[begin:end], begin)
            whole = begin == left.start and end == right.end
            final = fresh.cuts if end == right.end else fresh.cuts[fresh.cuts <= end - LOOK]
            same = np.intersect1d(final[final >= left.end], right.cuts)
            enough = begin == left.start or left.end - begin >= LOOK
            if whole:
                return Part(left.start, right.end, fresh.ids, fresh.cuts, fresh.first)
            if enough and len(same) and self._starts_alike(left, i, fresh):
                at = int(same[0])
                f, r = int(np.searchsorted(fresh.cuts, at)), int(np.searchsorted(right.cuts, at))
                lt, ft, rt = (int(left.first[i]) if i else 0), int(fresh.first[f]), int(right.first[r])
                return Part(
                    left.start,
                    right.end,
                    np.concatenate([left.ids[:lt], fresh.ids[:ft], right.ids[rt:]]),
                    np.concatenate([left.cuts[:i], fresh.cuts[:f], right.cuts[r:]]),
                    np.concatenate([left.first[:i], fresh.first[:f] + lt, right.first[r:] - rt + lt + ft]),
                )
            width *= 2

    @staticmethod
    def _starts_alike(left: Part, i: int, fresh: Part) -> bool:
        """The window's first pre-token is the left part's (it may go on over the join if it is its last)."""
        if i == 0 and left.start == fresh.start:
            return True
        a = left.ids[left.first[i] : left.first[i + 1] if i + 1 < len(left.first) else None]
        b = fresh.ids[fresh.first[0] : fresh.first[1] if len(fresh.first) > 1 else None]
        return np.array_equal(a, b)

    def tree(self, text: str, parts: list[Part]) -> Part:
        while len(parts) > 1:
            joined = [self.join(text, a, b) for a, b in zip(parts[::2], parts[1::2])]
            parts = joined + parts[len(joined) * 2 :]
        return parts[0]

    def encode_tree(self, text: str, leaf: int = LEAF) -> np.ndarray:
        """All in one place; what the jobs below do over rows."""
        out = []
        for s in self.segments(text):
            if s in self.special:
                out.append(np.array([self.special[s]], np.uint32))
            else:
                out.append(self.tree(s, [self.leaf(s[a : a + leaf], a) for a in range(0, len(s), leaf)]).ids)
        return np.concatenate(out) if out else np.empty(0, np.uint32)


@lru_cache(maxsize=4)
def codec(path: str) -> Codec:
    """One tokenizer per worker process."""
    return Codec(path)


def _ids(b: bytes) -> np.ndarray:
    return np.frombuffer(b, "<u4")


def _short(path: str, decoded: bool):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        c = codec(path)
        for pdf in batches:
            for a in range(0, len(pdf), 512):
                p = pdf.iloc[a : a + 512]
                ids = c.encode_many([t or "" for t in p["text"]])
                out = pd.DataFrame({"doc_id": p["doc_id"], "ids": [x.astype("<u4").tobytes() for x in ids]})
                yield out.assign(decoded=c.decode_many(ids)) if decoded else out

    return run


def _cut(path: str):
    """Leaves of long texts as rows: segment and leaf number, text."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        c = codec(path)
        for pdf in batches:
            for row, doc, text in zip(pdf["row"], pdf["doc_id"], pdf["text"]):
                segments = c.segments(text) if c.splits else [text]
                step = LEAF if c.splits else max(len(text), 1)
                leaves = [(k, a, s[a : a + step]) for k, s in enumerate(segments) for a in range(0, len(s), step)]
                yield pd.DataFrame(
                    {"row": row, "doc_id": doc, "segment": [x[0] for x in leaves], "start": [x[1] for x in leaves], "leaf": [x[2] for x in leaves]}
                )

    return run


def _encode_leaves(path: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        c = codec(path)
        for pdf in batches:
            ids, cuts, first = [], [], []
            for start, text in zip(pdf["start"], pdf["leaf"]):
                if text in c.special or not c.splits:
                    part = Part(0, 0, c.encode_many([text])[0], np.zeros(1, np.int64), np.zeros(1, np.int64))
                else:
                    part = c.leaf(text, int(start))
                ids.append(part.ids.astype("<u4").tobytes())
                cuts.append(part.cuts.astype("<i8").tobytes())
                first.append(part.first.astype("<i8").tobytes())
            yield pdf.assign(ids=ids, cuts=cuts, first=first)

    return run


def _join_leaves(path: str, decoded: bool):
    def join(g: pd.DataFrame) -> pd.DataFrame:
        c = codec(path)
        out = []
        g = g.sort_values(["segment", "start"], kind="stable")
        for _, s in g.groupby("segment", sort=True):
            text = "".join(s["leaf"])
            parts = [
                Part(int(a), int(a) + len(leaf), _ids(i), np.frombuffer(x, "<i8"), np.frombuffer(f, "<i8"))
                for a, leaf, i, x, f in zip(s["start"], s["leaf"], s["ids"], s["cuts"], s["first"])
            ]
            out.append(parts[0].ids if len(parts) == 1 else c.tree(text, parts).ids)
        ids = np.concatenate(out)
        done = pd.DataFrame({"doc_id": g["doc_id"].iloc[:1].tolist(), "ids": [ids.astype("<u4").tobytes()]})
        return done.assign(decoded=c.decode_many([ids])) if decoded else done

    return join


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", long: int = LONG, decoded: bool = False) -> DataFrame:
    """``(doc_id, ids)`` for every row; ids are little-endian unsigned 32-bit integers in a binary.
    With ``decoded``, also the library's text of the ids, by the same worker.

    Equal to the library's encoding of the whole text without added special
    tokens; null texts count as empty and give no ids.  Repeated rows, null
    ids and an empty table pass through row by row; other columns are never
    looked at.  ``path``: tokenizer file, readable by every executor.
    """
    # Ids travel as text: pandas has no long with nulls.
    rows = docs.select(F.col(id_col).cast("string").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    out = "doc_id string, ids binary" + (", decoded string" if decoded else "")
    short = rows.where(F.length("text") <= long).mapInPandas(_short(path, decoded), out)
    wide = rows.where(F.length("text") > long).withColumn("row", F.monotonically_increasing_id())
    leaf = "row long, doc_id string, segment long, start long, leaf string"
    # A count of its own: leaves are few bytes and much work, and would be merged by their bytes.
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    leaves = wide.mapInPandas(_cut(path), leaf).repartition(tasks, "row", "segment", "start")
    done = leaves.mapInPandas(_encode_leaves(path), f"{leaf}, ids binary, cuts binary, first binary")
    both = short.union(map_groups(done, ["row"], _join_leaves(path, decoded), out))
    return both.withColumn("doc_id", F.col("doc_id").cast("long"))


def decode(tokens: DataFrame, path: str) -> DataFrame:
    """``(doc_id, ids)`` -> with ``decoded``, the library's text of the ids, special tokens kept."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        c = codec(path)
        for pdf in batches:
            for a in range(0, len(pdf), 512):
                p = pdf.iloc[a : a + 512]
                yield p.assign(decoded=c.decode_many([_ids(x) for x in p["ids"]]))

    named = tokens.select(F.col("doc_id").cast("string").alias("doc_id"), "ids")
    text = named.mapInPandas(run, "doc_id string, ids binary, decoded string")
    return text.withColumn("doc_id", F.col("doc_id").cast("long"))


def token_count(ids: str = "ids"):
    return (F.octet_length(ids) / 4).cast("long")


def digest(docs: DataFrame, path: str) -> DataFrame:
    """The contract's columns."""
    return encode(docs, path, decoded=True).select(
        "doc_id",
        token_count().alias("n_tokens"),
        F.sha2(F.col("ids"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
