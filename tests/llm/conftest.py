import pytest

AWKWARD = [
    (1, "the quick brown fox jumps over the lazy dog and runs away from all of them today", "a", 7),
    (2, "The quick brown fox jumps over the lazy dog and runs away from all of them today", "b", 7),
    (3, None, "a", 7),
    (4, "", None, 7),
    (5, " \t\n ", "a", 7),
    (6, "word", "b", 7),
    (6, "word", "b", 7),
    (None, "no id here but some text", "a", 7),
    (7, "long " * 30_000, "c", None),
    (8, "x" * 90_000, "c", 7),
]
#: Columns whose names clash with names the operators use inside.
SCHEMA = "doc_id long, text string, source string, score int"


@pytest.fixture(scope="session")
def awkward(spark):
    df = spark.createDataFrame(AWKWARD, SCHEMA)
    return df.selectExpr("*", "score as n", "score as rank", "score as hash", "score as component", "score as ids", "score as _toxicity_free")


@pytest.fixture(scope="session")
def empty(awkward):
    return awkward.limit(0)
