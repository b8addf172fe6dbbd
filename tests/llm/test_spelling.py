"""Spelling variants against brute force."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from floe.llm import spelling
from floe.llm.queries import QUERIES
from tests.conftest import SF001
from tests.oracle import duck

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def edits(w, letters):
    for i in range(len(w) + 1):
        for c in letters:
            yield w[:i] + c + w[i:]
        if i < len(w):
            yield w[:i] + w[i + 1 :]
            for c in letters:
                yield w[:i] + c + w[i + 1 :]


def plain(rows):
    """By the contract's text, with all edits of every word."""
    n = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'null' if doc is None else doc}:{run}".encode())
            if h % 97 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            n[run] += 1
    n = {w: c for w, c in n.items() if c >= 3 and len(w) >= 5}
    letters = sorted(set("".join(n)))
    near = {w: {x for x in edits(w, letters) if x in n and x != w} for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best and n[best] >= 2 * n[w] else None
    out = set()
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return out


def result(df):
    rows = [tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def typos(seed):
    rng = random.Random(seed)
    words = ["recieve", "house", "houses", "Straße", "garçon", "aaaaaa", "aaaaa", "listen", "silent", "÷×÷×÷", "naïveté", "abcdefgh"]
    rows = []
    for i in range(400):
        text = []
        for _ in range(30):
            w = rng.choice(words)
            if rng.random() < 0.6:
                k = rng.randrange(len(w))
                w = w[:k] + rng.choice(["", rng.choice("aebÉß"), w[k] + rng.choice("aeb")]) + w[k + 1 :]
            text.append(w)
        rows.append((i if i % 9 else None, rng.choice([" ", "-", "1", "\n"]).join(text)))
    return rows


@pytest.mark.parametrize("cell,chunk", [(4096, 2048), (8, 3), (0, 5)])
def test_variants_equal_brute_force(spark, monkeypatch, cell, chunk):
    monkeypatch.setattr(spelling, "CELL", cell)
    monkeypatch.setattr(spelling, "CHUNK", chunk)
    rows = typos(4) + [(1, None), (1, ""), (2, "x" * 9_000), (2, "x" * 9_000), (3, "x" * 9_000 + " " + "x" * 8_999), (4, "x" * 8_999), (5, "x" * 8_999)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = result(spelling.digest(df))
    assert got == plain(rows)
    assert any(r[2] != r[0] and r[2] != r[1] for r in got), "a chain of more than one form"


def test_query_equals_brute_force(spark):
    rows = duck(SF001).sql("SELECT doc_id, text FROM documents").fetchall()
    assert result(QUERIES["op11_spelling_variants"](spark, SF001)) == plain(rows)


def test_one_edit():
    rng = random.Random(2)
    words = ["".join(rng.choice("abé") for _ in range(rng.randint(1, 7))) for _ in range(3000)]
    pairs = [sorted(p, key=len) for p in zip(words[::2], words[1::2])]
    want = [b in set(edits(a, "abé")) - {a} for a, b in pairs]
    assert spelling.one_edit([a for a, _ in pairs], [b for _, b in pairs]).tolist() == want
    assert 0 < sum(want) < len(want)


def test_near_pairs_in_tiles(monkeypatch):
    monkeypatch.setattr(spelling, "TILE", 3)
    words = sorted({"".join(p) for p in np.random.default_rng(3).choice(list("abc"), (60, 5))} | {"abca", "abcab"})
    got = {tuple(p) for p in spelling.near_pairs(words)}
    want = {(i, j) for i, a in enumerate(words) for j, b in enumerate(words) if (len(a), i) < (len(b), j) and b in set(edits(a, "abc")) - {a}}
    assert got == want


def test_awkward_and_empty(spark, awkward, empty):
    assert result(spelling.digest(awkward)) == plain([(r.doc_id, r.text) for r in awkward.collect()])
    assert spelling.digest(empty).collect() == []
