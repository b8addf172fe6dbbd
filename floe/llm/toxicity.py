"""Toxicity by a weighted lexicon matched with Aho-Corasick.

Texts are folded first: lower case, accents off, homoglyphs (Cyrillic, Greek,
full-width and styled letters) to Latin, zero-width characters out, digit and
sign substitutions undone inside words, everything else a space.  Lexicon
entries are whole words (`` word ``) and word beginnings (`` wor``) that mark
toxic documents in the labelled rows; phrases that hold an entry but mark
clean documents are exceptions, and hits inside them do not count.

A score is logistic in two numbers: the weight of all hits, and that weight
per folded word.  Entries, weights and the two coefficients are learned from
at most ``SAMPLE`` labelled rows, by significance alone; what they hold bounds the
lexicon, which travels with the tasks.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from floe.llm.common import free_name, stored

#: Labelled rows that are fitted at most.
SAMPLE = 20_000
#: Word beginnings that may become entries have this many characters.
STEMS = range(4, 9)
#: Toxic documents an entry has to occur in, at least; its least log odds by use;
#: standard deviations by which its uses in toxic documents exceed chance.
SUPPORT, ODDS, SURPRISE = 5, 1.2, 6.0

# Look-alike letters, digits and signs (fixed values).
HOMOGLYPHS = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "ё": "e", "һ": "h", "і": "i", "ї": "i", "ј": "j", "к": "k", "ӏ": "l", "м": "m",
    "н": "h", "о": "o", "р": "p", "ԛ": "q", "ѕ": "s", "т": "t", "у": "y", "ԝ": "w", "х": "x", "α": "a", "β": "b", "ε": "e", "η": "n",
    "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ɑ": "a", "ɡ": "g", "ı": "i", "ł": "l", "ø": "o",
    "đ": "d", "ß": "ss", "æ": "ae", "œ": "oe",
}
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i", "€": "e"}
ZERO_WIDTH = "​‌‍⁠﻿­"

_SIGNS = "".join(map(re.escape, SUBSTITUTES))
_SUBSTITUTED = re.compile(rf"(?<=[a-z])[{_SIGNS}]+(?=[a-z])|(?<![a-z{_SIGNS}])[{_SIGNS}](?=[a-z])|(?<=[a-z])[0134578@$€](?![a-z{_SIGNS}])")
_TO_LETTERS = str.maketrans(SUBSTITUTES)


class _Fold(dict):
    """Character -> folded characters, filled as characters are met."""

    def __missing__(self, code: int) -> str:
        ch = chr(code)
        if ch in ZERO_WIDTH:
            out = ""
        elif ch in HOMOGLYPHS:
            out = HOMOGLYPHS[ch]
        else:
            base = [c for c in unicodedata.normalize("NFKD", ch).lower() if not unicodedata.combining(c)]
            out = "".join(HOMOGLYPHS.get(c, c) if c.isalnum() or c in SUBSTITUTES else " " for c in base)
        self[code] = out
        return out


_FOLD = _Fold()


def fold(text: str | None) -> str:
    """The folded text, words parted and enclosed by single spaces; null or no words: one space."""
    t = (text or "").lower().translate(_FOLD)
    t = _SUBSTITUTED.sub(lambda m: m[0].translate(_TO_LETTERS), t)
    for sign in "@$!€":
        t = t.replace(sign, " ")
    return " " + " ".join(t.split()) + " " if t and not t.isspace() else " "


@dataclass
class Lexicon:
    """entries: pattern -> weight; exceptions: patterns; coefficients: bias, log weight, log weight per 100 words."""

    entries: dict[str, float] = field(default_factory=dict)
    exceptions: list[str] = field(default_factory=list)
    coefficients: tuple[float, float, float] = (-6.0, 2.0, 1.0)

    def matcher(self) -> Matcher:
        return Matcher(self)


class Matcher:
    def __init__(self, lexicon: Lexicon):
        import ahocorasick

        self.lexicon = lexicon
        self.automaton = ahocorasick.Automaton()
        for p, w in lexicon.entries.items():
            self.automaton.add_word(p, (len(p), w))
        for p in lexicon.exceptions:
            self.automaton.add_word(p, (len(p), None))
        if len(self.automaton):
            self.automaton.make_automaton()

    def hits(self, folded: str) -> list[tuple[int, int, float]]:
        """(start, end, weight) of the hits that count: the heaviest entry at each start, none inside an exception."""
        if not len(self.automaton):
            return []
        best: dict[int, tuple[int, float]] = {}
        spared: list[tuple[int, int]] = []
        for last, (n, w) in self.automaton.iter(folded):
            start, end = last + 1 - n, last + 1
            if w is None:
                spared.append((start, end))
            elif start not in best or best[start][1] < w:
                best[start] = (end, w)
        out = [(a, b, w) for a, (b, w) in sorted(best.items())]
        if spared:
            # Hits and exceptions in order of their starts: the furthest end so far tells whether one covers a hit.
            spared.sort()
            kept, at, reach = [], 0, -1
            for a, b, w in out:
                while at < len(spared) and spared[at][0] <= a:
                    reach = max(reach, spared[at][1])
                    at += 1
                if b > reach:
                    kept.append((a, b, w))
            out = kept
        return out

    def features(self, text: str | None) -> tuple[float, float]:
        folded = fold(text)
        weight = sum(w for _, _, w in self.hits(folded))
        words = max(folded.count(" ") - 1, 1)
        return math.log1p(weight), math.log1p(100 * weight / words)

    def score(self, text: str | None) -> float:
        a, b = self.features(text)
        z = float(np.dot(self.lexicon.coefficients, (1.0, a, b)))
        return 1 / (1 + math.exp(-max(-60.0, min(60.0, z))))


def _stems(folded: str) -> Counter:
    """How often each whole word and each word beginning occurs."""
    out: Counter = Counter()
    for w, n in Counter(folded.split()).items():
        out[f" {w} "] += n
        for k in STEMS:
            if len(w) >= k:
                out[f" {w[:k]}"] += n
    return out


def _counts(sample: DataFrame, patterns) -> DataFrame:
    """(pattern, toxic and all documents with it, occurrences in toxic and in all documents) over the sample, counted per task first."""
    names = ("toxic", "docs", "toxic_uses", "uses")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[str, list[int]] = {}
        for pdf in batches:
            for text, y in zip(pdf["text"], pdf["toxic"]):
                for p, n in patterns(fold(text)).items():
                    c = sums.setdefault(p, [0, 0, 0, 0])
                    c[0] += y
                    c[1] += 1
                    c[2] += y * n
                    c[3] += n
        found = list(sums)
        for a in range(0, len(found), 10_000):
            part = found[a : a + 10_000]
            yield pd.DataFrame({"pattern": part} | {name: [int(sums[p][i]) for p in part] for i, name in enumerate(names)})

    parts = sample.mapInPandas(run, "pattern string, " + ", ".join(f"{n} long" for n in names))
    return parts.groupBy("pattern").agg(*[F.sum(n).alias(n) for n in names])


def _choose(rows: list) -> dict[str, float]:
    """Weights of the patterns worth having: a longer one only if it clearly beats its beginnings."""
    out: dict[str, float] = {}
    for r in sorted(rows, key=lambda r: (len(r["pattern"]), r["pattern"])):
        p = r["pattern"]
        shorter = max((out[p[:n]] for n in range(2, len(p)) if p[:n] in out), default=-math.inf)
        if r["weight"] > shorter + 0.5:
            out[p] = r["weight"]
    return out


def _fit(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> tuple[float, float, float]:
    """Logistic regression by Newton steps, with a penalty on the two slopes."""
    a = np.column_stack([np.ones(len(x)), x])
    beta = np.zeros(a.shape[1])
    penalty = np.diag([1e-3] + [ridge] * x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(a @ beta, -30, 30)))
        grad = a.T @ (p - y) + penalty @ beta
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + penalty, grad)
        beta = beta - step
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(b) for b in beta)


def held_out(doc_id):
    """Every fifth document by crc32 of its id as text is never learned from."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))


def learn(docs: DataFrame, labels: DataFrame) -> Lexicon:
    """A lexicon from labelled documents that are not held out.

    Of the usable labels (id and toxic not null; a repeated id is toxic if
    any of its labels is) at most ``SAMPLE`` are taken, by a hash of the id.
    Without toxic and clean rows the lexicon is empty and every score low.
    """
    usable = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").where(~held_out("doc_id"))
    one = usable.groupBy(F.col("doc_id").cast("long").alias("_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    chosen = stored(one.orderBy(F.xxhash64("_id"), "_id").limit(SAMPLE), "toxicity-labels")
    # At most SAMPLE rows of two numbers: small enough to send to every task.
    texts = docs.where("text IS NOT NULL").select(F.col("doc_id").cast("long").alias("_id"), F.col("text").cast("string").alias("text"))
    sample = texts.join(F.broadcast(chosen), "_id").groupBy("text").agg(F.max("toxic").alias("toxic"))  # copies teach nothing new
    sample = stored(sample, "toxicity-texts")
    # An id may come with many texts: the bound holds for texts as well, by their smallest hashes (numbers travel, no texts).
    h = F.xxhash64("text")
    last = sample.select(h.alias("h")).orderBy("h").limit(SAMPLE).agg(F.max("h").alias("h")).first()["h"]
    sample = sample.where(h <= F.lit(last))
    n = sample.agg(F.count("*").alias("docs"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic")).first()
    if not n["toxic"] or n["toxic"] == n["docs"]:
        return Lexicon()
    stems = stored(_counts(sample, _stems), "toxicity-stems")
    # Whole words are counted once each, so their sums are the words in all.
    words = stems.where(F.col("pattern").endswith(" ")).agg(F.sum("toxic_uses").alias("t"), F.sum("uses").alias("a")).first()
    clean_uses = F.col("uses") - F.col("toxic_uses")
    odds = F.log((F.col("toxic_uses") + 0.5) / F.lit(float(words["t"]))) - F.log((clean_uses + 0.5) / F.lit(float(words["a"] - words["t"] + 1)))
    presence = F.log((F.col("toxic") + 0.5) / F.lit(float(n["toxic"]))) - F.log((F.col("docs") - F.col("toxic") + 0.5) / F.lit(float(n["docs"] - n["toxic"])))
    expected = F.col("uses") * F.lit(words["t"] / words["a"])
    surprise = (F.col("toxic_uses") - expected) / F.sqrt(expected)
    marks = stems.withColumn("weight", odds).withColumn("surprise", surprise)
    marks = marks.where((F.col("toxic") >= SUPPORT) & (F.col("weight") >= ODDS) & (presence >= 0.5) & (F.col("surprise") >= SURPRISE)).collect()
    lexicon = Lexicon(_choose(marks))

    def phrases(folded: str) -> Counter:
        out: Counter = Counter()
        for a, b, _ in lexicon.matcher_once().hits(folded):
            end = folded.index(" ", max(b - 1, a + 1)) + 1
            before = folded.rfind(" ", 0, a) if a else -1
            after = folded.find(" ", end)
            if before >= 0:
                out[folded[before:end]] += 1
            if after >= 0:
                out[folded[a : after + 1]] += 1
        return out

    # A phrase is an exception if the entry in it says nothing there: no commoner in toxic documents than elsewhere.
    base = n["toxic"] / n["docs"]
    kind = _counts(sample, phrases).where((F.col("docs") - F.col("toxic") >= 2 * SUPPORT) & (F.col("toxic") < F.col("docs") * base))
    lexicon = Lexicon(lexicon.entries, sorted(r["pattern"] for r in kind.collect()))

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = lexicon.matcher_once()
        for pdf in batches:
            f = [m.features(t) for t in pdf["text"]]
            yield pd.DataFrame({"a": [x[0] for x in f], "b": [x[1] for x in f], "y": pdf["toxic"].to_numpy()})

    rows = sample.mapInPandas(features, "a double, b double, y int").collect()  # at most SAMPLE rows
    x, y = np.array([[r["a"], r["b"]] for r in rows]), np.array([r["y"] for r in rows], float)
    return Lexicon(lexicon.entries, lexicon.exceptions, _fit(x, y))


_built: dict[tuple, Matcher] = {}


def _matcher_once(self: Lexicon) -> Matcher:
    """The lexicon's matcher, built once per worker."""
    key = (len(self.entries), hash(tuple(self.entries.items())), hash(tuple(self.exceptions)), self.coefficients)
    if key not in _built:
        _built.clear()
        _built[key] = self.matcher()
    return _built[key]


Lexicon.matcher_once = _matcher_once


def score(docs: DataFrame, lexicon: Lexicon, text_col: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with a score from 0 to 1 per row (null, empty and wordless texts too), all other columns as they were.

    Only the text is an input of the score.  ``name`` must not be a column of ``docs``.
    """

    @F.pandas_udf(T.DoubleType())
    def scored(texts: pd.Series) -> pd.Series:
        m = lexicon.matcher_once()
        return pd.Series([m.score(t) for t in texts], dtype="float64")

    return docs.withColumn(name, scored(F.col(f"`{text_col}`").cast("string")))


def keep_clean(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score below the threshold, all columns as they were."""
    name = free_name("toxicity", docs.columns)
    return score(docs, learn(docs, labels), name=name).where(F.col(name) < threshold).drop(name)


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The contract's columns."""
    scored = score(docs.select("doc_id", "text"), learn(docs, labels))
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
