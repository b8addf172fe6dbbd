"""Filtering stages on rows whose ids collide or are null, and on tables with clashing column names."""

from collections import Counter

import pytest

import corpus_pipeline
from floe.llm import minhash, mixing, pii, toxicity
from tests.conftest import SF001

CLASHES = "row _row row_ spans _spans _gone gone _mix_hash _mix_copies hash copies threshold _toxicity toxicity _doc id component key _id of".split()


def clean(i):
    """Texts without a word in common."""
    return " ".join(f"w{i}x{k}" for k in range(20 + i))


ROWS = (
    [(1, clean(1), "a"), (1, clean(2), "a"), (1, clean(3), "b"), (None, clean(4), "b"), (None, clean(5), None), (7, clean(6), "a"), (7, clean(6), "a")]
    + [(9, clean(6), "a"), (None, clean(6), "b"), (None, None, "a"), (3, None, None), (4, "", "a"), (4, "", "a"), (5, " \n", "b")]
)
#: Of the rows with one text in several copies, one with the smallest id stays.
KEPT = Counter({(i, t): n for (i, t, _), n in Counter(ROWS).items()}) - Counter({(7, clean(6)): 1, (9, clean(6)): 1, (None, clean(6)): 1})


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string, source string")
    return df.selectExpr("*", "'en' as lang", "cast(length(text) as long) as n_chars", *[f"{100 + k} as `{c}`" for k, c in enumerate(CLASHES)])


def same_extras(df):
    return df.select(*[f"`{c}`" for c in CLASHES]).distinct().collect() == [tuple(range(100, 100 + len(CLASHES)))]


def test_near_dedup_keeps_clean_rows_whatever_their_ids(docs):
    kept = minhash.keep_one(docs)
    assert kept.columns == docs.columns and same_extras(kept)
    assert Counter((r.doc_id, r.text) for r in kept.collect()) == KEPT


def test_other_filters_keep_columns_and_rows(spark, docs):
    labels = spark.createDataFrame([(1, 0), (7, None), (None, 1)], "doc_id long, toxic int").selectExpr("*", "1 as text", "2 as _toxicity")
    for out in (pii.redact(docs), toxicity.keep_clean(docs, labels)):
        assert out.columns == docs.columns and same_extras(out)
        assert Counter((r.doc_id, r.text) for r in out.collect()) == Counter((i, t) for i, t, _ in ROWS)
    mixed = mixing.mix_documents(docs)
    assert mixed.columns == docs.columns and same_extras(mixed)
    rows = Counter((i, t) for i, t, _ in ROWS)
    assert all(n <= 2 * rows[k] for k, n in Counter((r.doc_id, r.text) for r in mixed.collect()).items())


def test_mix_parts_rows_that_share_an_id(spark):
    """All rows of a source have one id or none: its target is met as near as with ids of their own."""
    rows = [(None if i % 2 else 5, clean(i % 40) + f" {i}", "a") for i in range(400)] + [(i, clean(i % 40), "b") for i in range(400)]
    got = mixing.digest(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    for size in {r.source_size for r in got}:
        mine = [r for r in got if r.source_size == size]
        assert abs(sum(r.taken for r in mine) - mine[0].target) <= 60


def test_pipeline_stages_on_awkward_tables(spark, docs):
    for table in (docs, docs.limit(0)):
        now = table
        for name, stage in corpus_pipeline.STAGES:
            now = stage(spark, now, SF001)
            if name != corpus_pipeline.STAGES[-1][0]:
                assert now.columns == docs.columns, name
        rows = now.collect()
        assert set(now.columns) == {"doc_id", "n_tokens", "ids", "decoded_sha256"}
        assert bool(rows) == (table is docs)
