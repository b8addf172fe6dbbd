"""The sieve's two parts, and how much of the texts the filters deal."""

import re

import pytest
from pyspark.sql import functions as F

from floe.llm import common, minhash, pii
from floe.session import scoped_conf


@pytest.mark.parametrize("n_keys, most", [(0, None), (1, None), (9_000, None), (9_000, 1)])
def test_sieve_loses_no_key(spark, monkeypatch, n_keys, most):
    """One block, several blocks, and fewer blocks than the keys would need; null and repeated keys."""
    if most:
        monkeypatch.setattr(common, "BITMAPS", most)
    rows = spark.range(-5_000, 60_000).union(spark.range(10)).select(F.when(F.col("id") != 7, F.col("id")).alias("a key"), F.lit("x").alias("text"))
    keys = rows.where("`a key` is null or `a key` % 3 = 0").limit(n_keys)
    keys = spark.createDataFrame(keys.collect(), "`a key` long, text string").select("a key")
    some, rest = common.sieved(rows, keys, "a key")
    assert some.columns == rest.columns == rows.columns
    assert some.union(rest).exceptAll(rows).isEmpty() and some.count() + rest.count() == rows.count()
    wanted, passed = {r[0] for r in keys.collect()}, {r[0] for r in some.collect()}
    assert wanted <= passed and not wanted & {r[0] for r in rest.collect()}
    assert len(passed - wanted) <= (65_010 * 0.35 if most else 65_010 * 0.1)


@pytest.mark.parametrize("drop", [minhash.keep_one, pii.redact])
def test_filters_deal_only_rows_that_change(spark, capsys, drop):
    """Beyond the size of a broadcast, texts that nothing links or marks stay where they are."""
    texts = [(i, " ".join(f"w{i}x{k}" for k in range(30))) for i in range(2_000)]
    texts += [(2_000 + i, texts[0][1] + f" me{i}@some{i}.org") for i in range(40)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    with scoped_conf(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        out = drop(docs)
        got = sorted(map(tuple, out.collect()))
        capsys.readouterr()
        out.explain("formatted")
    dealt = [float(n) for n in re.findall(r"ShuffleQueryStage.*rowCount=([0-9.E+]+)", capsys.readouterr().out)]
    assert dealt and sum(dealt) < 600
    want = texts[:2_000] if drop is minhash.keep_one else [(i, re.sub(r"me\d+@some\d+[.]org", "[email]", t)) for i, t in texts]
    assert got == sorted(want)
