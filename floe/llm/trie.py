"""Prefix trie of conversations by ROLLUP over positional turn-id columns.

1. Turns are numbered inside their conversation over an even range deal, so no
   conversation needs to fit a task.  A turn id is 16 bytes of SHA-256 over
   role and text, and the text's length.
2. Conversations become blocks of ``WIDTH`` positional columns t1 ... t8.  A
   block's key names all turns before it (two running sums of 60-bit digests
   per earlier block): the node in which the prior block ends.
3. ``GROUP BY block, key, ROLLUP(t1, ..., t8)`` aggregates the prefixes of all
   blocks together; grouping_id tells a row's depth.
4. Sums over subtrees: block totals climb to the blocks before by doubling
   steps (a round per binary digit of the longest chain of blocks), and a second
   ROLLUP adds nodes and the totals below them to all prefixes of the block.
5. Parents are looked up by their key, children of one parent in ``SALTS`` parts.
6. The ids that end in a node are sorted over ranges, written as pieces of
   text, and one pass per node feeds its pieces to SHA-256; what a task holds
   is one piece.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from floe.llm.common import stored

WIDTH = 8
SLOTS = [f"t{i}" for i in range(1, WIDTH + 1)]
#: Parts the children of one parent are dealt in; blocks of a conversation that are summed together.
SALTS, STRIPE = 64, 1024
_SUM = "decimal(38,0)"


def _hex(c: Column, at: int, n: int) -> Column:
    return F.conv(F.substring(c, at, n), 16, 10).cast(_SUM)


def turn_id(role: Column, text: Column) -> Column:
    named = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    return F.concat(F.substring(F.unhex(F.sha2(named.cast("binary"), 256)), 1, 16), F.unhex(F.lpad(F.hex(F.length(text).cast("long")), 8, "0")))


def _chars(t: Column) -> Column:
    """Code points of the text a turn id stands for."""
    return F.conv(F.hex(F.substring(t, 17, 4)), 16, 10).cast("long")


def numbered(convs: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """``(conv_id, part, local, t)`` with ``local`` counted from 1 inside a part, and ``(conv_id, part, before, n)``: turns in parts before, and in all."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    ids = convs.select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).alias("turn"), turn_id(role, text).alias("t"))
    dealt = ids.where("conv_id IS NOT NULL").repartitionByRange("conv_id", "turn", "t")
    dealt = stored(dealt.withColumn("part", F.spark_partition_id()), "trie-turns")
    local = F.row_number().over(Window.partitionBy("conv_id", "part").orderBy("turn", "t"))
    per_part = dealt.groupBy("conv_id", "part").agg(F.count("*").alias("c"))
    conv = Window.partitionBy("conv_id")
    before = F.sum("c").over(conv.orderBy("part").rowsBetween(Window.unboundedPreceding, 0)) - F.col("c")
    per_part = per_part.select("conv_id", "part", before.alias("before"), F.sum("c").over(conv).alias("n"))
    return dealt.select("conv_id", "part", local.alias("local"), "t"), stored(per_part, "trie-parts")


def rebuilt_blocks(turns: DataFrame, parts: DataFrame, lead: int, family: int) -> DataFrame:
    """``(conv_id, block, t1 ... t8, total)``: every conversation, rebuilt, in blocks; one without turns is one empty block.

    The first h turns come from conversation c - c % ``family`` (a remainder
    as SQL's, of c's sign), h = crc32 of c's digits % ``lead``; then follow c's own after its first h.
    """
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % lead).cast("int")
    base = F.col("conv_id") - F.col("conv_id") % family
    first = parts.where((F.col("conv_id") == base) & (F.col("before") < lead))
    heads = turns.join(first.select("conv_id", "part", "before"), ["conv_id", "part"]).withColumn("at", F.col("before") + F.col("local"))
    heads = heads.where(F.col("at") < lead).groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("at", "t"))).alias("head"))
    heads = heads.select(F.col("conv_id").alias("base"), F.col("head.t").alias("head"))
    convs = parts.select("conv_id", "n").distinct().select("conv_id", "n", h.alias("h"), base.alias("base")).join(heads, "base", "left")
    head = F.slice(F.coalesce("head", F.array().cast("array<binary>")), F.lit(1), F.col("h"))
    convs = convs.select("conv_id", "h", head.alias("head"), F.greatest(F.col("n") - F.col("h"), F.lit(0)).alias("own"))
    convs = stored(convs.withColumn("total", F.size("head") + F.col("own")), "trie-conversations")
    look = parts.join(convs.select("conv_id", "h", "total", F.size("head").alias("lent")), "conv_id")
    own = turns.join(look, ["conv_id", "part"]).withColumn("at", F.col("before") + F.col("local") - F.col("h")).where("at > 0")
    own = own.select("conv_id", (F.col("lent") + F.col("at") - 1).cast("long").alias("p"), "t", "total")
    lent = convs.select("conv_id", F.posexplode("head").alias("p", "t"), "total").select("conv_id", F.col("p").cast("long").alias("p"), "t", "total")
    bare = convs.where("total = 0").select("conv_id", F.lit(0).cast("long").alias("p"), F.lit(None).cast("binary").alias("t"), "total")
    rows = own.unionByName(lent).unionByName(bare)
    slots = [F.max(F.when(F.col("p") % WIDTH == i, F.col("t"))).alias(s) for i, s in enumerate(SLOTS)]
    return rows.groupBy("conv_id", F.floor(F.col("p") / WIDTH).alias("block")).agg(*slots, F.max("total").alias("total"))


def _block_digest() -> Column:
    return F.sha2(F.concat(F.concat(F.col("block").cast("string"), F.lit(":")).cast("binary"), *SLOTS), 256)


def keyed_blocks(blocks: DataFrame) -> DataFrame:
    """With ``ka``, ``kb``: sums of the digests of the conversation's earlier blocks."""
    zero = F.lit(0).cast(_SUM)
    short = blocks.where(F.col("total") <= WIDTH).select("*", zero.alias("ka"), zero.alias("kb"))
    long = blocks.where(F.col("total") > WIDTH).withColumn("stripe", F.floor(F.col("block") / STRIPE))
    # The last block may be partly filled; nothing comes after it.
    d = F.coalesce(_block_digest(), F.lit("0" * 64))
    long = long.withColumn("a", _hex(d, 1, 15)).withColumn("b", _hex(d, 16, 15))
    sums = long.groupBy("conv_id", "stripe").agg(F.sum("a").cast(_SUM).alias("sa"), F.sum("b").cast(_SUM).alias("sb"))
    before = Window.partitionBy("conv_id").orderBy("stripe").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("conv_id", "stripe", *[F.coalesce(F.sum(s).over(before).cast(_SUM), zero).alias(s) for s in ("sa", "sb")])
    inside = Window.partitionBy("conv_id", "stripe").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    long = long.select("*", *[F.coalesce(F.sum(x).over(inside).cast(_SUM), zero).alias(f"k{x}") for x in ("a", "b")])
    long = long.join(sums, ["conv_id", "stripe"])
    long = long.withColumn("ka", (F.col("ka") + F.col("sa")).cast(_SUM)).withColumn("kb", (F.col("kb") + F.col("sb")).cast(_SUM))
    return short.unionByName(long.select(*short.columns))


def _named(block: Column, ka: Column, kb: Column) -> Column:
    """The node in which a block's predecessor ends (block 0: the root), as 32 hexadecimal digits."""
    return F.left(F.sha2(F.concat_ws(":", block, ka.cast("string"), kb.cast("string")).cast("binary"), 256), F.lit(32))


def _key() -> Column:
    return _named(F.col("block"), F.col("ka"), F.col("kb"))


def _node(depth: Column) -> Column:
    """Name of the node ``depth`` turns into the block of t1 ... t8."""
    d = _block_digest()
    full = _named(F.col("block") + 1, (F.col("ka") + _hex(d, 1, 15)).cast(_SUM), (F.col("kb") + _hex(d, 16, 15)).cast(_SUM))
    prefix = [F.when(depth > i, F.col(s)).otherwise(F.lit(b"")) for i, s in enumerate(SLOTS)]
    inner = F.left(F.sha2(F.concat(_key().cast("binary"), *prefix), 256), F.lit(32))
    return F.when(depth == 0, _key()).when(depth == WIDTH, full).otherwise(inner)


def _rollup(rows: DataFrame, aggregates: str) -> DataFrame:
    """Aggregates per prefix of every block, with ``d``, the turns of the prefix; prefixes longer than the rows they hold are dropped."""
    keys = ", ".join(SLOTS)
    out = rows.sparkSession.sql(
        f"SELECT block, ka, kb, {keys}, {aggregates}, grouping_id() AS gid FROM {{rows}} GROUP BY block, ka, kb, ROLLUP({keys})", rows=rows
    )
    # A prefix of d columns leaves WIDTH - d ones rolled up: the lowest bits of grouping_id.
    d = F.lit(WIDTH) - F.bit_count("gid").cast("int")
    last = F.when(F.col("d") == 0, F.lit(b"")).otherwise(F.get(F.array(*SLOTS), F.col("d") - 1))
    return out.withColumn("d", d).drop("gid").withColumn("last", last).where(F.col("last").isNotNull())


def _block_sums(nodes: DataFrame) -> DataFrame:
    """``(node, more_saved, more_leaves)`` of the nodes that end a block and go on: sums over all blocks below."""
    spans = nodes.where("d > 0").groupBy(_key().alias("key")).agg(F.sum("own_saved").alias("saved"), F.sum("own_leaf").alias("leaves"))
    ends = nodes.where((F.col("d") == WIDTH) & (F.col("own_leaf") == 0)).select("node", _key().alias("up"))
    # Only blocks that go on or follow one take part.
    step = stored(spans.join(ends.withColumnRenamed("node", "key"), "key").select("key", "up", "saved", "leaves"), "trie-climb")
    while not step.where("up IS NOT NULL").isEmpty():
        arrived = step.where("up IS NOT NULL").groupBy(F.col("up").alias("key")).agg(F.sum("saved").alias("s"), F.sum("leaves").alias("l"))
        then = step.select(F.col("key").alias("up"), F.col("up").alias("then"))
        moved = step.join(arrived, "key", "left").join(then, "up", "left")
        step = stored(
            moved.select("key", F.col("then").alias("up"), (F.col("saved") + F.coalesce("s", F.lit(0))).alias("saved"), (F.col("leaves") + F.coalesce("l", F.lit(0))).alias("leaves")),
            "trie-climb",
        )
    return step.select(F.col("key").alias("node"), F.col("saved").alias("more_saved"), F.col("leaves").alias("more_leaves"))


def _pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sorted (node, conv_id) -> (node, first, ids): comma-joined runs of one node's ids."""
    for pdf in batches:
        if not len(pdf):
            continue
        ids = pdf["conv_id"].astype(str).tolist()
        cuts = [*np.flatnonzero(pdf["node"].ne(pdf["node"].shift())).tolist(), len(pdf)]
        heads = pdf.iloc[cuts[:-1]]
        joined = [",".join(ids[a:b]) for a, b in zip(cuts, cuts[1:])]
        yield pd.DataFrame({"node": heads["node"].tolist(), "first": heads["conv_id"].to_numpy(), "ids": joined})


def _hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Pieces sorted by (node, first) -> (node, ends_sha256)."""
    node, state = None, None
    for pdf in batches:
        names, sums = [], []
        for name, ids in zip(pdf["node"], pdf["ids"]):
            if name == node:
                state.update(b"," + ids.encode())
                continue
            if node is not None:
                names.append(node)
                sums.append(state.hexdigest())
            node, state = name, hashlib.sha256(ids.encode())
        if names:
            yield pd.DataFrame({"node": names, "ends_sha256": sums})
    if node is not None:
        yield pd.DataFrame({"node": [node], "ends_sha256": [state.hexdigest()]})


def _ends(blocks: DataFrame) -> DataFrame:
    """``(node, ends_sha256)`` of the nodes in which conversations end."""
    last = blocks.where(F.col("total") <= (F.col("block") + 1) * WIDTH)
    ended = last.select(_node((F.col("total") - F.col("block") * WIDTH).cast("int")).alias("node"), "conv_id")
    sorted_ids = ended.repartitionByRange("node", "conv_id").sortWithinPartitions("node", "conv_id")
    pieces = stored(sorted_ids.mapInPandas(_pieces, "node string, first long, ids string"), "trie-ends")
    return pieces.repartition("node").sortWithinPartitions("node", "first").mapInPandas(_hashed, "node string, ends_sha256 string")


def prefix_trie(
    convs: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    lead: int = 6,
    family: int = 100,
) -> DataFrame:
    """One row per node of the trie of rebuilt conversations (``rebuilt_blocks``).

    conv_id (smallest member), depth, parent_conv_id (root: null), n_convs,
    n_children, n_leaves, saved_tokens (over the subtree, members but one times
    code points of the node's text) and ends_sha256.

    Turns are ordered by turn (null first); turns of one number, and repeated
    rows, each count, in the order of their ids.  Null roles and texts are
    empty.  Rows without a conversation id belong to none and are left out.  A
    conversation that is rebuilt without turns is a member of the root only.
    Empty table: empty result.  Other columns are never looked at.
    """
    blocks = rebuilt_blocks(*numbered(convs, conv_col, turn_col, role_col, text_col), lead, family)
    blocks = stored(keyed_blocks(stored(blocks, "trie-blocks")), "trie-keyed")
    nodes = _rollup(blocks, "min(conv_id) AS conv_id, count(*) AS n_convs, max(total) AS longest")
    nodes = nodes.where((F.col("d") > 0) | (F.col("block") == 0)).withColumn("depth", F.col("block") * WIDTH + F.col("d"))
    nodes = nodes.select(
        "*",
        _node(F.col("d")).alias("node"),
        F.when(F.col("depth") > 0, _node(F.col("d") - 1)).alias("parent"),
        F.when(F.col("d") > 0, (F.col("n_convs") - 1) * _chars(F.col("last"))).otherwise(F.lit(0)).alias("own_saved"),
        (F.col("longest") == F.col("depth")).cast("long").alias("own_leaf"),
    )
    nodes = stored(nodes.drop("last", "longest"), "trie-nodes")
    more = _block_sums(nodes)
    placed = nodes.select("block", "ka", "kb", *SLOTS, "node", "own_saved", "own_leaf").join(more, "node", "left")
    placed = placed.withColumn("saved", F.col("own_saved") + F.coalesce("more_saved", F.lit(0))).withColumn("leaves", F.col("own_leaf") + F.coalesce("more_leaves", F.lit(0)))
    sums = _rollup(placed, "sum(saved) AS saved_tokens, sum(leaves) AS n_leaves").where((F.col("d") > 0) | (F.col("block") == 0))
    sums = sums.select(_node(F.col("d")).alias("node"), "saved_tokens", "n_leaves")

    salt = F.pmod(F.xxhash64("node"), F.lit(SALTS)).cast("int")
    family_rows = nodes.where("parent IS NOT NULL").select("node", "parent", salt.alias("salt"))
    kin = stored(family_rows.groupBy("parent", "salt").agg(F.count("*").alias("c")), "trie-kin")
    children = kin.groupBy(F.col("parent").alias("node")).agg(F.sum("c").alias("n_children"))
    above = kin.join(nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id")), "parent").drop("c")
    above = family_rows.join(above, ["parent", "salt"]).select("node", "parent_conv_id")

    out = nodes.select("node", "conv_id", "depth", "n_convs").join(sums, "node")
    for more_columns in (children, above, _ends(blocks)):
        out = out.join(more_columns, "node", "left")
    return out.select(
        "conv_id",
        F.col("depth").cast("long").alias("depth"),
        "parent_conv_id",
        "n_convs",
        F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"),
        F.col("n_leaves").cast("long").alias("n_leaves"),
        F.col("saved_tokens").cast("long").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )


#: crc32 of a text in DuckDB: a table of 256 steps made by rule, folded over the text's bytes.
_CRC = """crc AS (SELECT list(list_reduce(list_concat([i], range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) ORDER BY i) AS t
  FROM range(256) r(i))"""

ORACLE_SQL = f"""
WITH {_CRC},
turns AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS pos,
         {{'role': coalesce(role, ''), 'text': coalesce(text, '')}} AS t
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT conv_id, list(t ORDER BY pos) AS ts FROM turns GROUP BY conv_id),
cuts AS (
  SELECT conv_id, ts,
         (xor(4294967295, list_reduce(list_concat([4294967295], list_transform(string_split(conv_id::VARCHAR, ''), lambda d: ord(d)::BIGINT)),
              lambda c, b: xor(crc.t[(xor(c, b) & 255) + 1], c >> 8))) % 6)::INTEGER AS h
  FROM own, crc),
rebuilt AS (
  SELECT c.conv_id, list_concat(coalesce(b.ts, [])[1:c.h], c.ts[c.h + 1:]) AS ts
  FROM cuts c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 100),
prefixes AS (
  SELECT conv_id, d, ts[1:d] AS p, len(ts) = d AS ends, length(ts[d].text) AS chars
  FROM rebuilt, unnest(range(len(ts) + 1)) r(d)),
nodes AS (
  SELECT d, p, min(conv_id) AS conv_id, count(*) AS n_convs, coalesce(any_value(chars), 0) AS chars,
         coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '') AS members
  FROM prefixes GROUP BY d, p),
kin AS (SELECT d - 1 AS d, p[1:d - 1] AS p, count(*) AS n FROM nodes WHERE d > 0 GROUP BY ALL),
full_nodes AS (
  SELECT n.*, coalesce(k.n, 0) AS n_children FROM nodes n LEFT JOIN kin k ON n.d = k.d AND n.p = k.p),
below AS (
  SELECT r.a AS d, p[1:r.a] AS p, sum((n_convs - 1) * chars) AS saved, count(*) FILTER (n_children = 0) AS leaves
  FROM full_nodes, unnest(range(d + 1)) r(a) GROUP BY ALL)
SELECT n.conv_id, n.d::BIGINT AS depth, u.conv_id AS parent_conv_id, n.n_convs, n.n_children::BIGINT AS n_children,
       b.leaves::BIGINT AS n_leaves, b.saved::BIGINT AS saved_tokens, sha256(n.members) AS ends_sha256
FROM full_nodes n JOIN below b ON n.d = b.d AND n.p = b.p
LEFT JOIN nodes u ON u.d = n.d - 1 AND u.p = n.p[1:n.d - 1]
"""
