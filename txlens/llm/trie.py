"""Prefix trie of conversations by Spark SQL ROLLUP over positional turn columns.

A turn's id is a 128-bit hash of its role and text. The ids of ``WIDTH`` turns
stand in columns ``t0 .. t7``: one row per (conversation, block of ``WIDTH`` turns), headed
by ``node``, the id of the prefix before the block. ``GROUP BY block, node, ROLLUP (t0 .. t7)`` then
yields every prefix at once; ``grouping_id`` gives its depth in the block. Longer
conversations go on in further rows (blocks), whose ``node`` keys them to the
prior block's last node, so one rollup serves conversations of any length.

``node`` of later blocks is a hash over the blocks before. It is folded in groups
of ``FAN`` blocks, the groups in groups of ``FAN`` groups and so on, so that no
task holds a whole long conversation.

A node belongs to its smallest member. The nodes of one conversation are the end of
its path, from some depth on, so sums over a subtree are sums over its members:
the second rollup adds up, for the members, their characters, the characters of the nodes
that are theirs, and whether their last node is a leaf.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txlens.llm.common import lookup, stage, with_rank

WIDTH = 8     # turns in one row
FAN = 16      # blocks folded by one task into a prefix
PART = 256    # ids of a node's conversations written together
_T = [f"t{j}" for j in range(WIDTH)]
_C = [f"c{j}" for j in range(WIDTH)]
_ROOT = b""   # the id of the empty prefix


def _digest(*parts: Column) -> Column:
    """The first 128 bits of SHA-256."""
    return F.substring(F.unhex(F.sha2(F.concat(*parts), 256)), 1, 16)


def turns(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
          text_col: str = "text") -> DataFrame:
    """``conv, pos, turn, chars``: every turn's place from 0, the hash of its role and text, its code points.

    Turns are ordered by number, null first, equal numbers by that hash. Rows without a conversation id
    take no part. The order is made by ranges, so a long conversation is spread over tasks.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in (role_col, text_col))
    rows = conversations.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).alias("number"),
        _digest(F.char_length(role).cast("string").cast("binary"), F.lit(":").cast("binary"), role.cast("binary"), text.cast("binary")).alias("turn"),
        F.char_length(text).cast("long").alias("chars"))
    ranked = with_rank(rows, [F.col("conv"), F.col("number").asc_nulls_first()], "trie-turns")
    first = stage(ranked.groupBy("conv").agg(F.min("_rank").alias("first")), "trie-first")
    return lookup(ranked, first, ["conv"], "inner", 32).select("conv", (F.col("_rank") - F.col("first")).alias("pos"), "turn", "chars")


def with_shared_heads(rows: DataFrame, every: int = 100, most: int = 5) -> DataFrame:
    """Conversations rebuilt on the beginnings of others.

    Conversation c gets the first h turns of conversation ``c - c % every`` (all if it has fewer, none if
    absent) and then its own turns after its first h; h is the CRC-32 of c in decimals modulo ``most + 1``.
    Returns the columns of ``turns`` with one row of null ``pos`` for a conversation left without turns.
    """
    rows = stage(rows, "trie-own")
    convs = rows.groupBy("conv").agg(F.count(F.lit(1)).alias("n"))
    convs = stage(convs.select("conv", "n", (F.col("conv") - F.col("conv") % every).alias("base"),
                               (F.crc32(F.col("conv").cast("string").cast("binary")) % (most + 1)).alias("h")), "trie-sizes")
    base = convs.where(F.col("conv") % every == 0).select(F.col("conv").alias("base"), F.col("n").alias("n_base"))
    convs = convs.join(base, "base", "left").withColumn("head", F.least("h", F.coalesce("n_base", F.lit(0))))
    convs = stage(convs.select("conv", "base", "n", "h", "head"), "trie-heads")
    own = lookup(rows, convs.select("conv", "h", "head"), ["conv"], "inner", 48).where("pos >= h")
    own = own.select("conv", (F.col("pos") - F.col("h") + F.col("head")).alias("pos"), "turn", "chars")
    given = rows.where((F.col("conv") % every == 0) & (F.col("pos") < most)).withColumnRenamed("conv", "base")
    heads = given.join(convs.select("conv", "base", "h"), "base").where("pos < h").select("conv", "pos", "turn", "chars")
    bare = convs.where("head = 0 and n <= h").select("conv", *[F.lit(None).cast(t).alias(c) for c, t in (("pos", "long"), ("turn", "binary"), ("chars", "long"))])
    return own.unionByName(heads).unionByName(bare)


def _before(items: DataFrame) -> DataFrame:
    """``conv, i, node, pre``: hash and characters of all items before item i, for items ``conv, i, id, chars`` from 0."""
    groups = items.groupBy("conv", F.floor(F.col("i") / FAN).alias("g")).agg(F.array_sort(F.collect_list(F.struct("i", "id", "chars"))).alias("l"))
    groups = stage(groups, "trie-fold")  # a list has FAN items at most
    total = lambda l: F.aggregate(l, F.lit(0).cast("long"), lambda acc, x: acc + x["chars"])
    joined = lambda l: F.aggregate(l, F.lit(b""), lambda acc, x: F.concat(acc, x["id"]))
    if groups.where("g > 0").limit(1).count():
        above = _before(groups.select("conv", F.col("g").alias("i"), _digest(F.lit(b"g"), joined(F.col("l"))).alias("id"), total(F.col("l")).alias("chars")))
        groups = groups.join(above.select("conv", F.col("i").alias("g"), "node", "pre"), ["conv", "g"])
    else:
        groups = groups.select("*", F.lit(_ROOT).alias("node"), F.lit(0).cast("long").alias("pre"))
    out = groups.select("conv", "node", "pre", "l", F.posexplode("l").alias("k", "x"))
    done = F.slice("l", 1, F.col("k"))
    return out.select("conv", F.col("x.i").alias("i"), F.when(F.col("k") == 0, F.col("node")).otherwise(_digest(F.lit(b"p"), F.col("node"), joined(done))).alias("node"),
                      (F.col("pre") + total(done)).alias("pre"))


def blocks(rows: DataFrame) -> DataFrame:
    """Staged ``conv, block, node, pre, t0.., c0.., len, total``: ``WIDTH`` turns a row.

    ``pre`` are the characters before the block, ``len`` and ``total`` the conversation's turns and
    characters. A conversation without turns has one row without turns.
    """
    place = F.col("pos") % WIDTH
    wide = rows.groupBy("conv", F.floor(F.coalesce("pos", F.lit(0)) / WIDTH).alias("block")).agg(
        *[F.max(F.when(place == j, F.col("turn"))).alias(t) for j, t in enumerate(_T)],
        *[F.max(F.when(place == j, F.col("chars"))).alias(c) for j, c in enumerate(_C)], F.count("pos").alias("turns"))
    wide = stage(wide.withColumn("chars", sum((F.coalesce(c, F.lit(0)) for c in _C), F.lit(0))), "trie-wide")
    sizes = stage(wide.groupBy("conv").agg(F.sum("turns").alias("len"), F.sum("chars").alias("total")), "trie-lengths")
    wide = lookup(wide, sizes, ["conv"], "inner", 48)
    # Only conversations of several blocks have prefixes to fold.
    full = [F.coalesce(t, F.lit(b"")) for t in _T]
    nodes = _before(wide.where(F.col("len") > WIDTH).select("conv", F.col("block").alias("i"), _digest(F.lit(b"b"), *full).alias("id"), "chars"))
    wide = wide.join(nodes.withColumnRenamed("i", "block"), ["conv", "block"], "left")
    return stage(wide.select("conv", "block", F.coalesce("node", F.lit(_ROOT)).alias("node"), F.coalesce("pre", F.lit(0)).alias("pre"), *_T, *_C, "len", "total"), "trie-blocks")


def _rollup(table: DataFrame, aggregates: str) -> DataFrame:
    """All prefixes of the rows of ``table``: ``block, node, t0 .., level, depth`` and the aggregates over their members."""
    ids = ", ".join(_T)
    out = table.sparkSession.sql(f"SELECT block, node, {ids}, {WIDTH} - bit_count(grouping_id()) AS level, {aggregates} "
                                 f"FROM {{table}} GROUP BY block, node, ROLLUP ({ids})", table=table)
    # A prefix longer than its conversations is none; a later block's empty prefix is the prior block's last node.
    last = F.coalesce(*[F.when(F.col("level") == j + 1, F.col(t)) for j, t in enumerate(_T)])
    out = out.withColumn("depth", F.col("block") * WIDTH + F.col("level"))
    return out.where(F.when(F.col("level") == 0, F.col("block") == 0).otherwise(last.isNotNull()))


def _node_id(level: Column) -> Column:
    """The id of the node at ``level`` of a row with ``node, t0 ..``."""
    ids = [F.when(level > j, F.col(t)).otherwise(F.lit(b"")) for j, t in enumerate(_T)]
    return F.when((level == 0) & (F.col("block") == 0), F.lit(_ROOT)).otherwise(_digest(F.lit(b"n"), F.col("node"), *ids))


def _chars_before(level: Column) -> Column:
    """Characters of all turns before the last one of the node at ``level``."""
    return F.col("pre") + sum((F.when(level > j + 1, F.coalesce(F.col(c), F.lit(0))).otherwise(0) for j, c in enumerate(_C)), F.lit(0))


def _ends(table: DataFrame) -> DataFrame:
    """``id, ends_sha256``: for the node where conversations end, SHA-256 of their ids in ascending order, comma-joined.

    Order and text of the ids are made in parts of at most ``PART`` ids; what meets in one task per
    node is its parts, streamed through the digest one by one, since SHA-256 has no parallel form.
    """
    at = F.greatest(F.lit(0), F.floor((F.col("len") - 1) / WIDTH))
    ends = table.where(F.col("block") == at).select(F.hex(_node_id(F.col("len") - F.col("block") * WIDTH)).alias("id"), "conv")
    ranked = with_rank(ends, [F.col("id"), F.col("conv")], "trie-ends")
    ids = F.transform(F.array_sort(F.collect_list("conv")), lambda c: c.cast("string"))
    parts = ranked.groupBy("id", F.floor(F.col("_rank") / PART).alias("part")).agg(F.array_join(ids, ",").alias("ids"))

    def digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, h = None, None
        for batch in batches:
            done = []
            for node, ids in zip(batch["id"], batch["ids"]):
                if node == at:
                    h.update(b",")
                else:
                    if at is not None:
                        done.append((at, h.hexdigest()))
                    at, h = node, hashlib.sha256()
                h.update(ids.encode())
            yield pd.DataFrame(done, columns=["id", "ends_sha256"])
        if at is not None:
            yield pd.DataFrame([(at, h.hexdigest())], columns=["id", "ends_sha256"])

    streamed = parts.repartition("id").sortWithinPartitions("id", "part").select("id", "ids")
    return streamed.mapInPandas(digest, "id string, ends_sha256 string")


def prefix_trie(rows: DataFrame) -> DataFrame:
    """One row per node of the trie of conversations given as ``conv, pos, turn, chars`` (see ``turns``).

    Columns ``conv_id`` (smallest member), ``depth``, ``parent_conv_id`` (the parent's ``conv_id``, null for the
    root), ``n_convs`` (members: conversations that start with the node's turns), ``n_children``, ``n_leaves``
    (childless nodes in the subtree), ``saved_tokens`` (over the subtree, each node's members beyond the
    first times the characters of its last turn) and ``ends_sha256`` (SHA-256 of the ids of the members that end
    here). ``(conv_id, depth)`` is unique. Repeated conversations share their nodes. An
    empty table has no node.
    """
    table = blocks(rows)
    # First rollup: who owns a node, and where the nodes of a conversation begin.
    first = _rollup(table, "min(conv) AS owner, max(len) AS longest")
    owners = first.groupBy("owner").agg(F.min("depth").alias("since"), F.max((F.col("longest") == F.col("depth")).cast("long")).alias("leaf"))
    owners = stage(owners.withColumnRenamed("owner", "conv"), "trie-owners")
    at = F.floor(F.greatest(F.lit(0), F.col("since") - 1) / WIDTH)
    mine = table.join(owners, "conv").where(F.col("block") == at)
    mine = mine.select("conv", "since", "leaf", "len", "total", (F.col("total") - _chars_before(F.col("since") - F.col("block") * WIDTH)).alias("own"))
    owners = stage(mine, "trie-owned")

    # Second rollup: sums over members are sums over the subtree.
    sums = lookup(table, owners.select("conv", "leaf", "own"), ["conv"], "left", 48).fillna(0, ["leaf", "own"])
    second = _rollup(sums, "min(conv) AS owner, count(*) AS n_convs, sum(leaf) AS n_leaves, sum(total) AS all_chars, sum(own) AS own_chars, max(pre) AS pre, "
                     + ", ".join(f"max({c}) AS {c}" for c in _C))
    nodes = second.select("owner", "depth", F.hex(_node_id(F.col("level"))).alias("id"), "n_convs", "n_leaves", "all_chars", "own_chars",
                          _chars_before(F.col("level")).alias("before"))
    nodes = stage(nodes, "trie-nodes")

    # Where the first node of each owner hangs.
    above = F.col("since") - 1
    block = F.floor(F.greatest(F.lit(0), above - 1) / WIDTH)
    starts = table.join(owners.where("since > 0").select("conv", "since"), "conv").where(F.col("block") == block)
    starts = starts.select("conv", above.alias("depth"), F.hex(_node_id(above - F.col("block") * WIDTH)).alias("id"))
    hung = stage(starts.join(nodes.select("id", F.col("owner").alias("parent")), "id").select("conv", "parent", "depth"), "trie-hung")
    children = hung.groupBy(F.col("parent").alias("owner"), "depth").agg(F.count(F.lit(1)).alias("hanging"))

    known = owners.join(hung.select("conv", "parent"), "conv", "left").withColumnRenamed("conv", "owner")
    known = stage(known.select("owner", "since", "len", "total", "own", "parent"), "trie-known")
    out = lookup(nodes, known, ["owner"], "inner", 64).join(children, ["owner", "depth"], "left").join(_ends(table), "id", "left")
    shared = F.col("all_chars") - F.col("n_convs") * F.col("before") - (F.col("own_chars") - F.col("own") + F.col("total") - F.col("before"))
    return out.select(
        F.col("owner").alias("conv_id"), F.col("depth").cast("long").alias("depth"),
        F.when(F.col("depth") > F.col("since"), F.col("owner")).otherwise(F.col("parent")).alias("parent_conv_id"), "n_convs",
        ((F.col("len") > F.col("depth")).cast("long") + F.coalesce("hanging", F.lit(0))).alias("n_children"), "n_leaves",
        shared.cast("long").alias("saved_tokens"), F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"))
