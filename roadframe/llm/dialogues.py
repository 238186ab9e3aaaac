"""Prefix trie of conversations, by ROLLUP over positional turn columns.

A conversation is laid out in blocks of ``WIDTH`` turns: one row a block with a
column per turn and, as key, the node that the turns before it lead to. One
``GROUP BY block, node, ROLLUP(t1 .. tn)`` aggregates the prefixes of all
blocks together, so a long conversation only has more blocks. Turns are known
by 128 bits of SHA-256 and the length of their text; a node by two 64-bit
exclusive-or sums over (position, turn).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from roadframe.llm.common import read_table, ship_package, shuffle_partitions, stored

WIDTH = 8
#: a conversation is rebuilt from the head of the one that opens its hundred
SPAN = 100
#: heads are shorter than this
HEADS = 6
#: bytes of a turn's hash in its id; the text's length follows in 4
HASH = 16
_POSITION_BITS = 33
_TURNS = [f"t{k}" for k in range(1, WIDTH + 1)]


def running(df: DataFrame, group: str, keys: Sequence[Column], name: str, sums: Sequence[str] = (),
            xors: Sequence[str] = ()) -> DataFrame:
    """``df`` with ``place`` (from 1, in the order of ``keys`` within its
    ``group``), ``<c>_to`` for ``sums`` and ``xors``: the running sum and
    exclusive or, this row included.

    A range partitioning by group and keys deals the rows, so a group of any
    size is split; what a group holds in earlier partitions is added from one
    row per partition.
    """
    spark = df.sparkSession
    placed = stored(df.repartitionByRange(shuffle_partitions(spark), group, *keys)
                    .sortWithinPartitions(group, *keys).withColumn("_at", F.monotonically_increasing_id()), name)
    placed = placed.withColumn("_pid", F.shiftright("_at", _POSITION_BITS))
    by = Window.partitionBy("_pid", group).orderBy("_at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = placed.withColumns({"place": F.row_number().over(Window.partitionBy("_pid", group).orderBy("_at")).cast("long"),
                                **{f"{c}_to": F.sum(c).over(by).cast("long") for c in sums},
                                **{f"{c}_to": F.bit_xor(c).over(by) for c in xors}})
    names = ["place", *(f"{c}_to" for c in sums), *(f"{c}_to" for c in xors)]
    edges = local.groupBy("_pid").agg(F.min(group).alias("first"), F.max(F.struct(group, *names)).alias("last"))
    offsets, group_before, total = [], None, [0] * len(names)
    for row in edges.orderBy("_pid").collect():  # one row per partition
        carry = total if row["first"] == group_before else [0] * len(names)
        offsets.append((row["_pid"], row["first"], *carry))
        own = [row["last"][n] for n in names]
        group_before = row["last"][group]
        if group_before == row["first"]:
            own = [a ^ b if n[:-3] in xors else a + b for n, a, b in zip(names, own, carry)]
        total = own
    fields = ", ".join(["_pid long", "_first long", *(f"_{n} long" for n in names)])
    # bound: one row of longs per shuffle partition
    local = local.join(F.broadcast(spark.createDataFrame(offsets, fields)), "_pid")
    carried = lambda n: F.when(F.col(group) == F.col("_first"), F.col(f"_{n}")).otherwise(F.lit(0))
    out = {n: F.col(n).bitwiseXOR(carried(n)) if n[:-3] in xors else F.col(n) + carried(n) for n in names}
    return local.withColumns(out).drop("_pid", "_at", "_first", *(f"_{n}" for n in names))


def turn_id(role: Column, text: Column) -> Column:
    """Hash of role and text (the role's length keeps them apart), then the
    text's length in code points."""
    whole = F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text)
    size = F.lpad(F.hex(F.char_length(text)), 8, "0")
    return F.unhex(F.concat(F.substring(F.sha2(whole, 256), 1, 2 * HASH), size))


def length_of(turn: Column) -> Column:
    return F.conv(F.hex(F.substring(turn, HASH + 1, 4)), 16, 10).cast("long")


def _lane(lane: int, position: Column, turn: Column) -> Column:
    return F.xxhash64(F.lit(lane), position.cast("long"), turn)


def head_length(conv_id: Column) -> Column:
    return (F.crc32(conv_id.cast("string").cast("binary")) % HEADS).cast("int")


def rebuild(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rebuilt turns (conv_id, position from 1, turn, length) and conversations
    (conv_id, length), both stored; length counts the rebuilt turns.

    Turns stand in the order of ``turn``, null first, ties by the hash of role
    and text. Null roles and texts are empty; rows without a conv_id belong to
    no conversation and are left out; a row given twice is two turns.
    """
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("at"),
        turn_id(text("role"), text("text")).alias("turn"))
    own = running(turns, "conv_id", [F.asc_nulls_first("at"), F.col("turn")], "dialogue-turns")
    base = F.col("conv_id") - F.col("conv_id") % SPAN
    heads = own.where((F.col("conv_id") % SPAN == 0) & (F.col("place") < HEADS)).groupBy(F.col("conv_id").alias("base")).agg(
        F.transform(F.sort_array(F.collect_list(F.struct("place", "turn"))), lambda x: x["turn"]).alias("head"))  # under HEADS
    plan = own.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).select(
        "conv_id", "n", base.alias("base"), head_length(F.col("conv_id")).alias("cut")).join(heads, "base", "left")
    head = F.when(F.col("head").isNull(), F.array().cast("array<binary>")).otherwise(F.slice("head", F.lit(1), F.col("cut")))
    plan = plan.withColumn("head", head)
    plan = stored(plan.select("conv_id", "cut", "head", F.size("head").alias("kept"),
                              (F.size("head") + F.greatest(F.col("n") - F.col("cut"), F.lit(0))).cast("long").alias("length")),
                  "dialogue-plan")
    tails = own.join(plan.select("conv_id", "cut", "kept", "length"), "conv_id").where(F.col("place") > F.col("cut")).select(
        "conv_id", (F.col("place") - F.col("cut") + F.col("kept")).alias("position"), "turn", "length")
    fronts = plan.select("conv_id", F.posexplode("head").alias("position", "turn"), "length").select(
        "conv_id", (F.col("position") + 1).cast("long").alias("position"), "turn", "length")
    return tails.unionByName(fronts), plan.select("conv_id", "length")


def _blocks(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """One row per conversation and block: conv_id, block, the key of the node
    before it (k1, k2), the characters before and in it, and its turns."""
    slot = F.pmod(F.col("position") - 1, F.lit(WIDTH))
    first = lambda c: F.max(F.when(slot == 0, c))
    rows = turns.groupBy("conv_id", F.floor((F.col("position") - 1) / WIDTH).alias("block")).agg(
        first(F.col("x1_to").bitwiseXOR(F.col("x1"))).alias("k1"), first(F.col("x2_to").bitwiseXOR(F.col("x2"))).alias("k2"),
        first(F.col("chars_to") - F.col("chars")).alias("before"), F.sum("chars").alias("chars"),
        *(F.max(F.when(slot == k, F.col("turn"))).alias(t) for k, t in enumerate(_TURNS)))
    none = [F.lit(0).cast("long").alias(c) for c in ("block", "k1", "k2", "before", "chars")]
    turnless = conversations.where("length = 0").select("conv_id", *none, *(F.lit(None).cast("binary").alias(t) for t in _TURNS))
    return rows.unionByName(turnless)


def _rollup(blocks: DataFrame, aggregates: str) -> DataFrame:
    """All nodes of all blocks: depth, key (x1, x2), the parent's key (y1, y2),
    characters of the last text and of the texts before it, and ``aggregates``."""
    rolled = blocks.sparkSession.sql(
        f"SELECT block, k1, k2, before, {', '.join(_TURNS)}, grouping_id() AS folded, {aggregates} "
        f"FROM {{blocks}} GROUP BY block, k1, k2, before, ROLLUP({', '.join(_TURNS)})", blocks=blocks)
    path, level = F.array(*_TURNS), (WIDTH - F.bit_count("folded")).cast("int")
    rolled = rolled.withColumn("level", level).withColumn("last", F.get(path, F.col("level") - 1))
    # a turn that a conversation no longer has is null, as a folded one is; the top of a later block is the node before it
    rolled = rolled.where(F.when(F.col("level") == 0, F.col("block") == 0).otherwise(F.col("last").isNotNull()))
    rolled = rolled.withColumn("path", F.slice(path, F.lit(1), F.col("level")))

    def key(lane: int) -> Column:
        hashes = F.transform("path", lambda t, i: _lane(lane, F.col("block") * WIDTH + i + 1, t))
        return F.aggregate(hashes, F.col(f"k{lane}"), lambda a, b: a.bitwiseXOR(b))

    depth = (F.col("block") * WIDTH + F.col("level")).cast("long")
    out = rolled.withColumns({"depth": depth, "x1": key(1), "x2": key(2), "chars": F.coalesce(length_of(F.col("last")), F.lit(0))})
    parent = lambda lane: F.when(F.col("level") > 0, F.col(f"x{lane}").bitwiseXOR(
        _lane(lane, F.col("depth"), F.col("last"))))
    whole = F.aggregate(F.transform("path", length_of), F.col("before"), lambda a, b: a + b)
    return out.withColumns({"y1": parent(1), "y2": parent(2), "above": whole - F.col("chars")}).drop(
        *_TURNS, "path", "last", "folded", "level", "block", "k1", "k2", "before")


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows (depth, x1, x2, conv_id): the decimal ids of each run of one
    node within a batch, comma-joined."""
    for batch in batches:
        depth, x1, x2, ids = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
        if not len(ids):
            continue
        new = np.flatnonzero((depth[1:] != depth[:-1]) | (x1[1:] != x1[:-1]) | (x2[1:] != x2[:-1])) + 1
        starts, ends = np.concatenate(([0], new)), np.concatenate((new, [len(ids)]))
        texts = ids.astype(str).tolist()
        yield pa.RecordBatch.from_arrays(
            [pa.array(c[starts]) for c in (depth, x1, x2, ids)]
            + [pa.array([",".join(texts[a:b]) for a, b in zip(starts, ends)])],
            names=["depth", "x1", "x2", "first", "ids"])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted chunks: one SHA-256 per node, fed chunk by chunk."""
    node, state, rows = None, None, []

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist(rows, pa.schema([("depth", pa.int64()), ("x1", pa.int64()), ("x2", pa.int64()),
                                                           ("ends_sha256", pa.string())]))

    for batch in batches:
        for depth, x1, x2, ids in zip(*(batch.column(i).to_pylist() for i in (0, 1, 2, 4))):
            if (depth, x1, x2) == node:
                state.update(b"," + ids.encode())
                continue
            if node is not None:
                rows.append(dict(zip(("depth", "x1", "x2", "ends_sha256"), (*node, state.hexdigest()))))
            node, state = (depth, x1, x2), hashlib.sha256(ids.encode())
        if rows:
            yield out()
            rows = []
    if node is not None:
        rows.append(dict(zip(("depth", "x1", "x2", "ends_sha256"), (*node, state.hexdigest()))))
        yield out()


def end_digests(ends: DataFrame) -> DataFrame:
    """SHA-256 of the ids that end at each node, ascending and comma-joined.
    The ids of a node are spread over tasks and joined in chunks; only the
    chunks of one node meet, one after the other."""
    parts, node = shuffle_partitions(ends.sparkSession), ["depth", "x1", "x2"]
    sorted_ids = ends.repartitionByRange(parts, *node, "conv_id").sortWithinPartitions(*node, "conv_id")
    chunks = sorted_ids.mapInArrow(_chunks, "depth long, x1 long, x2 long, first long, ids string")
    chunks = chunks.repartition(parts, *node).sortWithinPartitions(*node, "first")
    return chunks.mapInArrow(_digests, "depth long, x1 long, x2 long, ends_sha256 string")


def prefix_trie(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """Nodes of the trie of ``turns`` (conv_id, position from 1, turn, length)
    over ``conversations`` (conv_id, length); no conversation, no node.

    Sums over subtrees need no walk: every node belongs to its smallest member,
    so a conversation's own nodes are the last ones of its path. Of all texts
    below a node, a member saves those from the node on to its first own one.
    """
    ship_package(turns.sparkSession)
    lanes = turns.withColumns({"x1": _lane(1, F.col("position"), F.col("turn")),
                               "x2": _lane(2, F.col("position"), F.col("turn")), "chars": length_of(F.col("turn"))})
    # position is the place within the conversation, so it orders the running sums
    placed = stored(running(lanes, "conv_id", [F.col("position")], "dialogue-paths", sums=["chars"], xors=["x1", "x2"]),
                    "dialogue-keys")
    blocks = stored(_blocks(placed, conversations), "dialogue-blocks")
    node = ["depth", "x1", "x2"]
    members = "count(*) AS n_convs, min(conv_id) AS conv_id"
    nodes = stored(_rollup(blocks, members).select(*node, "y1", "y2", "conv_id", "above"), "dialogue-nodes")
    children = nodes.where("depth > 0").groupBy(
        (F.col("depth") - 1).alias("depth"), F.col("y1").alias("x1"), F.col("y2").alias("x2")).agg(
        F.count(F.lit(1)).alias("n_children"))
    children = stored(children, "dialogue-children")
    own = nodes.join(children, node, "left").groupBy("conv_id").agg(
        F.min("above").alias("own_from"), F.max(F.col("n_children").isNull().cast("long")).alias("leaf"))
    each = blocks.groupBy("conv_id").agg(F.sum("chars").alias("total")).join(own, "conv_id", "left").select(
        "conv_id", F.coalesce("own_from", "total").alias("own_from"), F.coalesce("leaf", F.lit(0)).alias("leaf"))
    found = _rollup(blocks.drop("chars").join(each, "conv_id"), members + ", CAST(sum(leaf) AS BIGINT) AS n_leaves, "
                    "sum(own_from) AS from_all, min_by(own_from, conv_id) AS from_own")
    saved = F.col("from_all") - F.col("from_own") - (F.col("n_convs") - 1) * F.col("above")
    ends = placed.where(F.col("position") == F.col("length")).select(
        F.col("position").alias("depth"), F.col("x1_to").alias("x1"), F.col("x2_to").alias("x2"), "conv_id")
    zero = F.lit(0).cast("long")
    ends = ends.unionByName(conversations.where("length = 0").select(
        zero.alias("depth"), zero.alias("x1"), zero.alias("x2"), "conv_id"))
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("x1").alias("y1"), F.col("x2").alias("y2"),
                           F.col("conv_id").alias("parent_conv_id"))
    out = found.withColumn("saved_tokens", saved.cast("long")).join(children, node, "left").join(
        end_digests(ends), node, "left")
    out = out.join(parents, ["depth", "y1", "y2"], "left")
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs",
                      F.coalesce("n_children", zero).alias("n_children"), "n_leaves", "saved_tokens",
                      F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))


def op13_prefixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the rebuilt conversations' trie; see ``rebuild`` and ``prefix_trie``."""
    return prefix_trie(*rebuild(read_table(spark, sf_dir, "conversations")))


def oracle_sql() -> str:
    """DuckDB SQL of the query: every prefix listed as a hash of its turns."""
    crc = ("xor(list_reduce(list_transform(range(1, length(s) + 1), lambda i: CAST(ascii(s[i]) AS BIGINT)), "
           "lambda a, b: list_reduce(range(8), lambda v, i: xor(v >> 1, 3988292384 * (v & 1)), xor(a, b)), 4294967295), 4294967295)")
    return (
        "WITH raw AS (SELECT conv_id AS c, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations "
        "WHERE conv_id IS NOT NULL), "
        "t AS (SELECT c, turn, length(text) AS chars, sha256(CAST(length(role) AS VARCHAR) || ':' || role || text) AS id FROM raw), "
        "o AS (SELECT c, chars, id, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, id) AS p FROM t), "
        "n AS (SELECT c, count(*) AS n, CAST(c AS VARCHAR) AS s FROM o GROUP BY c), "
        f"h AS (SELECT c, c - c % {SPAN} AS b, {crc} % {HEADS} AS h FROM n), "
        "rb AS (SELECT h.c, o.p AS d, o.id, o.chars FROM h JOIN o ON o.c = h.b AND o.p <= h.h UNION ALL "
        "SELECT h.c, o.p - h.h + least(h.h, coalesce(n.n, 0)) AS d, o.id, o.chars FROM h JOIN o ON o.c = h.c AND o.p > h.h "
        "LEFT JOIN n ON n.c = h.b), "
        "m AS (SELECT c, d, chars, sha256(string_agg(id, ',') OVER (PARTITION BY c ORDER BY d)) AS k FROM rb "
        "UNION ALL SELECT c, 0, 0, '' FROM h), "
        "pm AS (SELECT *, lag(k) OVER (PARTITION BY c ORDER BY d) AS pk, lead(k) OVER (PARTITION BY c ORDER BY d) IS NULL AS last FROM m), "
        "nd AS (SELECT d, k, any_value(pk) AS pk, any_value(chars) AS chars, min(c) AS conv_id, count(*) AS n_convs, "
        "coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (last), '') AS ends FROM pm GROUP BY d, k), "
        "ch AS (SELECT d - 1 AS d, pk AS k, count(*) AS n FROM nd WHERE d > 0 GROUP BY ALL), "
        "x AS (SELECT nd.*, coalesce(ch.n, 0) AS n_children FROM nd LEFT JOIN ch ON ch.d = nd.d AND ch.k = nd.k), "
        "sub AS (SELECT m.d, m.k, sum((x.n_convs - 1) * x.chars) AS saved, count(*) FILTER (x.n_children = 0) AS leaves "
        "FROM x JOIN m ON m.c = x.conv_id AND m.d <= x.d GROUP BY ALL) "
        "SELECT x.conv_id, CAST(x.d AS BIGINT) AS depth, up.conv_id AS parent_conv_id, x.n_convs, x.n_children, "
        "sub.leaves AS n_leaves, CAST(sub.saved AS BIGINT) AS saved_tokens, sha256(x.ends) AS ends_sha256 "
        "FROM x JOIN sub ON sub.d = x.d AND sub.k = x.k LEFT JOIN x up ON up.d = x.d - 1 AND up.k = x.pk")
