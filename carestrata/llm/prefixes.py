"""Conversation prefix trie by ROLLUP over positional turn columns.

A conversation's turns lie in blocks of `WIDTH` columns. One GROUP BY block, key, ROLLUP(turn columns) makes all nodes of
all depths: grouping_id tells how many columns a row keeps, and so its depth. A block's key is the node that the block
before it ends at, so that long conversations go on in further blocks of the same statement, however many they are.

A node is known by depth and a key of 128 bits: the exclusive or, over its turns, of a hash of place and turn, which a
window adds up along a conversation. Its least member stands for it; as a node's least member is also that of the nodes
below it on its own path, what a node weighs can be put at (least member, depth), summed along that conversation from
its end, and summed once more over all conversations of each node to give the whole subtree: no descent level by level.
Members that end at a node are hashed in a stream sorted by node and id, which holds one row at a time.

Cases: turns are ordered by number, null first, then by role and text; a null role or text is empty; repeated rows are
further turns; rows without conv_id belong to no conversation and are left out; a conversation may have any number of
turns of any length; an empty table has no nodes, not even a root. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from carestrata.llm.store import kept, table

WIDTH = 8
NODE = ["depth", "k1", "k2"]
ENDS = "depth long, k1 long, k2 long, ends_sha256 string"


def turns_of(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, h1, h2, chars): each turn's place from 1 on, its identity, its length; and a place 0 for each conversation."""
    text = {c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text")}
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", *[v.alias(k) for k, v in text.items()])
    rows = rows.where("conv_id IS NOT NULL")
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "text")
    turns = rows.select(
        "conv_id",
        F.row_number().over(order).cast("long").alias("pos"),
        F.xxhash64("role", "text").alias("h1"),
        F.xxhash64("text", F.lit("turn"), "role").alias("h2"),
        F.length("text").cast("long").alias("chars"),
    )
    none = F.lit(None).cast("long")
    return turns.union(turns.where("pos = 1").select("conv_id", F.lit(0).cast("long"), none, none, none))


def rebuilt(turns: DataFrame, every: int = 100, most: int = 6) -> DataFrame:
    """Each conversation c with its first h turns replaced by those of the first one of its hundred; h is a hash of c."""
    head = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).alias("h")
    base = (F.col("conv_id") - F.col("conv_id") % every).alias("base")
    firsts = turns.where((F.col("conv_id") % every == 0) & (F.col("pos") < most))
    sizes = firsts.groupBy(F.col("conv_id").alias("base")).agg(F.max("pos").alias("n"))
    placed = turns.select("*", head, base).join(sizes, "base", "left").withColumn("lead", F.least("h", F.coalesce("n", F.lit(0))))
    tails = placed.where("pos > h OR pos = 0")
    pos = F.when(F.col("pos") == 0, 0).otherwise(F.col("pos") - F.col("h") + F.col("lead"))
    wanted = placed.where("pos = 0 AND lead > 0").select("conv_id", "base", F.explode(F.sequence(F.lit(1).cast("long"), "lead")).alias("pos"))
    heads = wanted.join(firsts.withColumnRenamed("conv_id", "base"), ["base", "pos"])
    columns = ["h1", "h2", "chars"]
    return tails.select("conv_id", pos.cast("long").alias("pos"), *columns).union(heads.select("conv_id", "pos", *columns))


def mark(which: int, pos: Column, h1: Column, h2: Column) -> Column:
    """Hash of a turn at its place."""
    return F.xxhash64(F.lit(which), pos, h1, h2)


def keyed(turns: DataFrame) -> DataFrame:
    """`turns` with the key of the node that each place leads to; place 0 leads to the root."""
    so_far = Window.partitionBy("conv_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    marks = [F.when(F.col("pos") == 0, F.lit(0).cast("long")).otherwise(mark(i, F.col("pos"), F.col("h1"), F.col("h2"))) for i in (1, 2)]
    marked = turns.withColumns({"m1": marks[0], "m2": marks[1]})
    last = F.max("pos").over(Window.partitionBy("conv_id"))
    return marked.select("*", *[F.bit_xor(f"m{i}").over(so_far).alias(f"k{i}") for i in (1, 2)], (F.col("pos") == last).alias("ends"))


def blocks_of(rows: DataFrame, width: int) -> DataFrame:
    """One row a conversation and block: the key before the block, and a column for each turn."""
    slot = (F.col("pos") - 1) % width
    block = F.floor((F.greatest("pos", F.lit(1)) - 1) / width).cast("long").alias("block")
    turn = F.struct("h1", "h2", "chars")
    keys = [F.coalesce(F.max(F.when(slot == 0, F.col(f"k{i}").bitwiseXOR(F.col(f"m{i}")))), F.lit(0).cast("long")).alias(f"key{i}") for i in (1, 2)]
    return rows.groupBy("conv_id", block).agg(*keys, *[F.max(F.when(slot == j, turn)).alias(f"t{j}") for j in range(width)])


def rolled_up(blocks: DataFrame, width: int) -> DataFrame:
    """All nodes: (depth, k1, k2), the parent's key (p1, p2), the least member, members, length of the last text."""
    turns = [f"t{j}" for j in range(width)]
    sql = f"""
      SELECT block, key1, key2, {", ".join(turns)}, {width} - bit_count(grouping_id()) AS kept,
             min(conv_id) AS conv_id, count(*) AS n_convs
      FROM {{blocks}} GROUP BY block, key1, key2, ROLLUP({", ".join(turns)})"""
    found = blocks.sparkSession.sql(sql, blocks=blocks)
    last = F.get(F.array(*turns), F.col("kept") - 1)
    # where nothing is kept only the root is new; a column without a turn is behind the end of a conversation
    found = found.where(F.when(F.col("kept") == 0, F.col("block") == 0).otherwise(last.isNotNull()))

    def key(i: int, upto: Column) -> Column:
        value = F.col(f"key{i}")
        for j, t in enumerate(turns):
            at = mark(i, F.col("block") * width + j + 1, F.col(t)["h1"], F.col(t)["h2"])
            value = value.bitwiseXOR(F.when(F.lit(j) < upto, at).otherwise(F.lit(0).cast("long")))
        return value

    return found.select(
        (F.col("block") * width + F.col("kept")).cast("long").alias("depth"),
        *[key(i, F.col("kept")).alias(f"k{i}") for i in (1, 2)],
        *[key(i, F.col("kept") - 1).alias(f"p{i}") for i in (1, 2)],
        "conv_id",
        "n_convs",
        F.coalesce(last["chars"], F.lit(0).cast("long")).alias("chars"),
    )


def ends_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over (depth, k1, k2, conv_id) in order: the digest of each node's ids."""
    node, digest = None, None
    for batch in batches:
        done = []
        for *here, conv_id in zip(*(c.to_pylist() for c in batch.columns)):
            if here != node:
                if node is not None:
                    done.append((*node, digest.hexdigest()))
                node, digest = here, hashlib.sha256(str(conv_id).encode())
            else:
                digest.update(f",{conv_id}".encode())
        yield ended(done)
    if node is not None:
        yield ended([(*node, digest.hexdigest())])


def ended(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64()] * 3 + [pa.string()]
    columns = list(zip(*rows)) or [()] * 4
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], [*NODE, "ends_sha256"])


def trie_of(turns: DataFrame, width: int = WIDTH) -> DataFrame:
    """One row a node of placed turns (see `turns_of`): what `op12` returns, and the node's key k1, k2."""
    rows = kept(keyed(turns), "keyed-turns")
    nodes = kept(rolled_up(blocks_of(rows, width), width), "trie-nodes")
    children = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2")).agg(F.count("*").alias("n_children"))
    weighed = nodes.join(children, NODE, "left").fillna(0, ["n_children"])
    weighed = kept(weighed.withColumn("w", (F.col("n_convs") - 1) * F.col("chars")), "trie-weights")

    own = weighed.select("conv_id", F.col("depth").alias("pos"), "w", (F.col("n_children") == 0).cast("long").alias("leaf"))
    onward = Window.partitionBy("conv_id").orderBy(F.desc("pos")).rowsBetween(Window.unboundedPreceding, 0)
    sums = [F.sum(F.coalesce(c, F.lit(0).cast("long"))).over(onward).alias(c) for c in ("w", "leaf")]
    paths = rows.join(own, ["conv_id", "pos"], "left").select(F.col("pos").alias("depth"), "k1", "k2", *sums)
    below = paths.groupBy(*NODE).agg(F.sum("w").alias("saved_tokens"), F.sum("leaf").alias("n_leaves"))

    last = rows.where("ends").select(F.col("pos").alias("depth"), "k1", "k2", "conv_id")
    ends = last.repartition(*NODE).sortWithinPartitions(*NODE, "conv_id").mapInArrow(ends_of, ENDS)
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    whole = weighed.join(below, NODE, "left").join(ends, NODE, "left").join(parents, ["depth", "p1", "p2"], "left")
    return whole.select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
        "k1",
        "k2",
    )


def prefix_trie(conversations: DataFrame, width: int = WIDTH) -> DataFrame:
    """The trie of the conversations as they are."""
    return trie_of(turns_of(conversations), width)


def op12_conversation_prefix_trie(spark, sf_dir: str) -> DataFrame:
    turns = kept(turns_of(table(spark, sf_dir, "conversations")), "placed-turns")
    return trie_of(kept(rebuilt(turns), "rebuilt-turns")).drop("k1", "k2")


OP12_SQL = """
WITH RECURSIVE tab AS (
  SELECT i, i AS x, 0 AS s FROM range(256) r(i)
  UNION ALL SELECT i, xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END), s + 1 FROM tab WHERE s < 8),
crc AS (
  SELECT DISTINCT conv_id AS c, CAST(conv_id AS VARCHAR) AS s, CAST(4294967295 AS BIGINT) AS v, 1 AS k
  FROM conversations WHERE conv_id IS NOT NULL
  UNION ALL SELECT c, crc.s, xor(v >> 8, x), k + 1 FROM crc JOIN tab ON tab.s = 8 AND i = xor(v & 255, CAST(ascii(crc.s[k]) AS BIGINT))
  WHERE k <= len(crc.s)),
heads AS (SELECT c, c - c % 100 AS base, xor(v, 4294967295) % 6 AS h FROM crc WHERE k = len(s) + 1),
lists AS (
  SELECT conv_id, list({'r': coalesce(role, ''), 't': coalesce(text, '')} ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS us
  FROM conversations GROUP BY conv_id),
rebuilt AS (
  SELECT c AS conv_id, list_concat(CASE WHEN h > 0 THEN coalesce(b.us[1:h], []) ELSE [] END, o.us[h + 1:]) AS seq
  FROM heads JOIN lists o ON o.conv_id = c LEFT JOIN lists b ON b.conv_id = base),
members AS (SELECT conv_id, d AS depth, seq[1:d] AS prefix, len(seq) = d AS ends FROM rebuilt, unnest(range(0, len(seq) + 1)) r(d)),
nodes AS (
  SELECT depth, prefix, min(conv_id) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256,
         CASE WHEN depth = 0 THEN 0 ELSE (count(*) - 1) * len(prefix[depth].t) END AS w
  FROM members GROUP BY depth, prefix),
children AS (SELECT depth - 1 AS depth, prefix[1:depth - 1] AS prefix, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY ALL),
counted AS (SELECT nodes.*, coalesce(n, 0) AS n_children FROM nodes LEFT JOIN children USING (depth, prefix)),
below AS (
  SELECT d AS depth, prefix[1:d] AS prefix, CAST(sum(w) AS BIGINT) AS saved_tokens, count(*) FILTER (WHERE n_children = 0) AS n_leaves
  FROM counted, unnest(range(0, depth + 1)) r(d) GROUP BY ALL)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, b.n_leaves, b.saved_tokens, n.ends_sha256
FROM counted n JOIN below b USING (depth, prefix)
LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.prefix = n.prefix[1:n.depth - 1]
"""
