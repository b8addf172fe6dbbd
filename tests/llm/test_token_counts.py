"""Token counts against the tokenizers library."""

import random
from collections import Counter

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from floe.llm import tokencounts
from floe.llm.queries import QUERIES
from tests.conftest import SF01

WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
PIECES = ["a", "Ab", "the ", "'ll", " ", "  ", "\n", "1", "é", "ß", "漢", "🙂", "'s", "!", "<|endoftext|>", "<|endof", "\t", "\x1c", "　", "É", "İ", "Σ", "12", "don't"]


def library_counts(path, rows):
    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return Counter((i, len((x or "").encode()), len(t.encode(x or "", add_special_tokens=False).ids)) for i, x in rows)


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_counts_equal_the_library(spark, monkeypatch, path):
    rng = random.Random(3)
    rows = [(i if i % 7 else None, "".join(rng.choice(PIECES) for _ in range(rng.randint(0, 40)))) for i in range(500)]
    rows += [(1, None), (1, ""), (1, None), (2, "x" * 90_000), (2, "long " * 30_000), (2, "long " * 30_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert Counter(map(tuple, tokencounts.token_counts(df, path).collect())) == library_counts(path, rows)


def test_small_blocks_give_the_same(monkeypatch):
    c = tokencounts.Cutter(WORD)
    texts = ["The cat, the hat.", "", "a cat's  hat 12", "cat <|endoftext|> x"]
    whole = c.matrix(texts)
    sums = [0] * len(texts)
    for cell, n in zip(*whole[1:]):
        sums[cell // len(whole[0])] += n * c.pieces(whole[0][cell % len(whole[0])])
    assert sums == [len(c.tokenizer.encode(t, add_special_tokens=False).ids) for t in texts]
    assert c.matrix([""])[0] == []


def test_query_counts_whole_documents(spark):
    rows = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "text").collect()
    got = QUERIES["op13_token_counts"](spark, SF01).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_tokens) for r in got) == library_counts(WORD, rows)
    assert all(r.over_limit == (r.n_tokens > 2048) for r in got)


def test_awkward_and_empty(spark, awkward, empty):
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    assert Counter(map(tuple, tokencounts.token_counts(awkward, WORD).collect())) == library_counts(WORD, rows)
    assert tokencounts.digest(empty, WORD).collect() == []
