"""Vector operators against brute force; chat offsets against plain concatenation."""

import numpy as np
import pytest

from floe.llm import ann, chat, embdup

INF, NAN = float("inf"), float("nan")
ODD = [
    (9001, None, 1, 0),
    (9002, [0.0] * 8, 1, 0),
    (9003, [NAN] + [1.0] * 7, 1, 0),
    (9004, [INF] + [1.0] * 7, 1, 0),
    (9005, [None] + [1.0] * 7, 1, 0),
    (9006, [1.0, 2.0], 1, 0),
    (None, [1.0] * 8, 1, 0),
    (9007, [], 1, 0),
]
SCHEMA = "vec_id long, embedding array<float>, label int, rank int"


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(4)
    base = rng.standard_normal((30, 8))
    x = np.concatenate([rng.standard_normal((300, 8)), base, base + 0.02, base, base * 3, base[:5].repeat(20, axis=0) + rng.standard_normal((100, 8)) * 0.1]).astype(np.float32)
    rows = [(i, v.tolist(), None if i % 50 == 7 else int(i % 2) if i < 300 else 0, 0) for i, v in enumerate(x)]
    return rows, spark.createDataFrame(rows + ODD + rows[:3], SCHEMA)


def test_near_vectors_equal_brute_force(spark, vectors, monkeypatch):
    rows, df = vectors
    monkeypatch.setattr(embdup, "CHUNK", 16)
    u = np.array([r[1] for r in rows], float)
    u /= np.linalg.norm(u, axis=1)[:, None]
    label = [r[2] for r in rows]
    near = u @ u.T >= 0.93
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    links = np.zeros(len(rows), int)
    for a in range(len(rows)):
        for b in range(a):
            if near[a, b] and label[a] is not None and label[a] == label[b]:
                links[[a, b]] += 1
                x, y = sorted((find(a), find(b)))
                root[y] = x
    want = {i: (int(links[i]), find(i), find(i) == i) for i in range(len(rows))}
    want |= {r[0]: (0, r[0], True) for r in ODD if r[0] is not None}
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embdup.digest(df).collect()}
    assert got == want and links.max() > 5
    assert embdup.digest(df.limit(0)).count() == 0


def test_nearest_recall_and_scores(spark, vectors, monkeypatch):
    rows, df = vectors
    monkeypatch.setattr(ann, "ROW_BLOCK", 128)
    monkeypatch.setattr(ann, "QUERY_BLOCK", 8)
    x = np.array([r[1] for r in rows], float)
    got = {}
    for r in ann.nearest(df).collect():
        got.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    hits = total = 0
    for q in range(0, len(rows), 20):
        s = x @ x[q]
        s[q] = -np.inf
        best = np.lexsort((np.arange(len(rows)), -s))[:20]
        found = [got[q][k] for k in range(1, 21)]
        assert all(abs(s[i] - v) < 1e-12 for i, v in found) and found == sorted(found, key=lambda f: (-f[1], f[0]))
        hits, total = hits + len({i for i, _ in found} & set(best.tolist())), total + 20
    assert hits / total >= 0.9


def test_nearest_with_few_candidates(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0], 1, 0), (1, [0.5, 0.5], 1, 0), (2, [0.5, -0.5], 1, 0), *ODD], SCHEMA)
    got = [(r.query_id, r.rank, r.vec_id, r.score) for r in ann.nearest(df).where("query_id = 0").orderBy("rank").collect()]
    assert [g[:3] for g in got] == [(0, 1, 9006), (0, 2, 1), (0, 3, 2)]
    assert ann.nearest(df.limit(0)).count() == 0


def test_perspectives(spark):
    rows = [(1, 0, "system", "rules"), (1, 1, "ann", "hi"), (1, 2, "bob", None), (1, 2, "bob", "<|end|> x"), (1, 3, None, "who"), (1, 3, None, "who"), (2, 0, "system", "alone"), (None, 0, "ann", "lost")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 as pos", "2 as speaker", "'x' as segment")
    got = chat.perspectives(df).collect()
    assert {(r.conv_id, r.speaker) for r in got} == {(1, "ann"), (1, "bob"), (1, "unknown")}
    for who in ("ann", "bob", "unknown"):
        turns = sorted((r for r in got if r.speaker == who), key=lambda r: r.pos)
        whole = "".join(r.segment for r in turns)
        assert [r.pos for r in turns] == list(range(6))
        for r in turns:
            assert whole[r.start : r.stop] == r.segment
            trained = whole[r.train_start : r.train_stop]
            assert trained == (r.segment.removeprefix("<|assistant|>\n") if r.role == who else "")
        assert whole.startswith("<|system|>\nrules<|end|>\n") and "< |end|> x" in whole
    assert chat.perspectives(df.limit(0)).count() == 0
