"""Conversation prefix trie against brute force."""

import hashlib
import random
import zlib
from collections import defaultdict

from floe.llm import trie
from floe.llm.queries import QUERIES
from tests.conftest import SF01
from tests.oracle import duck

SCHEMA = "conv_id long, turn long, role string, text string"


def plain(rows):
    turns = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            tie = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()[:16]
            turns[c].append(((turn is not None, turn or 0), tie, role, text))
    own = {c: [(r, x) for _, _, r, x in sorted(t)] for c, t in turns.items()}
    members = defaultdict(list)
    ends = defaultdict(list)
    for c in sorted(own):
        h = zlib.crc32(str(c).encode()) % 6
        # A remainder of the number's sign, as SQL's.
        seq = tuple(own.get(c - (abs(c) % 100) * (1 if c >= 0 else -1), [])[:h] + own[c][h:])
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
        ends[seq].append(c)
    children = defaultdict(int)
    for p in members:
        if p:
            children[p[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1]) if p else 0
    return {
        (m[0], len(p), members[p[:-1]][0] if p else None, len(m), children[p], leaves[p], saved[p], hashlib.sha256(",".join(map(str, ends[p])).encode()).hexdigest())
        for p, m in members.items()
    }


def result(df):
    names = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    rows = [tuple(r[n] for n in names) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def dialogues(seed):
    """Branching conversations of up to 60 turns, some turnless after rebuilding, with null and repeated turns."""
    rng = random.Random(seed)
    trunk = [(rng.choice(["user", "assistant", None]), f"text {i} é🙂" if i % 5 else None) for i in range(60)]
    rows = []
    for c in [*range(0, 260), -3, -100, -120, None]:
        n = rng.choice([0, 1, 2, 3, 7, 8, 9, 15, 16, 17, 24, 33, 60])
        cut = rng.randint(0, n)
        mine = trunk[:cut] + [(rng.choice("ab"), str(rng.randint(0, 1))) for _ in range(n - cut)]
        rows += [(c, k, r, x) for k, (r, x) in enumerate(mine)]
        if rng.random() < 0.1:
            rows += [(c, None, "user", "no number"), (c, 1, "user", "tie"), (c, 1, "user", "tie")]
    rng.shuffle(rows)
    return rows


def test_trie_equals_brute_force(spark):
    rows = dialogues(1)
    df = spark.createDataFrame(rows, SCHEMA)
    got = result(trie.prefix_trie(df))
    assert got == plain(rows)
    assert max(r[1] for r in got) > 2 * trie.WIDTH


def test_stripes_and_pieces(spark, monkeypatch):
    monkeypatch.setattr(trie, "STRIPE", 2)
    monkeypatch.setattr(trie, "SALTS", 2)
    rows = dialogues(2)
    clash = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "turn as p", "turn as t", "turn as block", "turn as t1", "turn as node", "turn as gid")
    assert result(trie.prefix_trie(clash)) == plain(rows)


def test_one_conversation_copied_very_often(spark):
    rows = [(c, k, "user", "same " * k) for c in range(100, 5000, 1) for k in range(3)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert result(trie.prefix_trie(df)) == plain(rows)


def test_turnless_and_empty(spark):
    # 10 lends from an absent conversation and keeps none of its own first turns.
    c = next(i for i in range(1, 100) if zlib.crc32(str(i).encode()) % 6 > 1)
    rows = [(c, 0, "user", "x")]
    assert result(trie.prefix_trie(spark.createDataFrame(rows, SCHEMA))) == plain(rows) == {(c, 0, None, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())}
    assert trie.prefix_trie(spark.createDataFrame([], SCHEMA)).collect() == []
    assert trie.prefix_trie(spark.createDataFrame([(None, 0, "user", "x")], SCHEMA)).collect() == []


def test_query_equals_brute_force(spark):
    rows = duck(SF01).sql("SELECT conv_id, turn, role, text FROM conversations").fetchall()
    assert result(QUERIES["op12_prefix_trie"](spark, SF01)) == plain(rows)
