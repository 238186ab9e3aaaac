"""Sharding by a hierarchical weighted hash tree.

A document descends from the root by one weighted hash draw per level
(region, rack, shard): among the children of its node the one with the
smallest ``-ln(u) / weight`` wins, where ``u`` is a hash of the document's key
and the child. A child's draw depends on its own label and weight alone, so
after a weight change a document moves only into or out of the subtrees whose
weights changed.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadframe.llm.common import ordered, read_table, stored, uniform

SHARDS = 24
RACKS_PER_REGION = 2
SHARDS_PER_RACK = 3


@dataclass(frozen=True)
class Leaf:
    """A shard and its place in the tree; inner weights are sums of leaves."""

    region: str
    rack: str
    shard: int
    weight: float = 1.0


def even_tree(shards: int = SHARDS, racks: int = RACKS_PER_REGION, per_rack: int = SHARDS_PER_RACK) -> list[Leaf]:
    """Equal shards, ``per_rack`` in a rack and ``racks`` in a region."""
    places = [(i // (racks * per_rack), i // per_rack % racks, i) for i in range(shards)]
    return [Leaf(f"region{r}", f"rack{r}-{k}", i) for r, k, i in places]


def grown(tree: Sequence[Leaf], weight: float = 1.0) -> list[Leaf]:
    """``tree`` with one more shard, alone in a new region: no other subtree's
    weight changes, so documents move only into the new shard."""
    n = 1 + max(leaf.shard for leaf in tree)
    return [*tree, Leaf(f"region-{n}", f"rack-{n}", n, weight)]


def tree_of(shards: int = SHARDS, base: int = SHARDS) -> list[Leaf]:
    """The tree that a number of shards decides: an even tree of the first
    ``base`` of them, the size at which a corpus was first dealt, and every
    further one added by ``grown``. So the tree of ``n + 1`` shards is the
    grown tree of ``n``, and growing by any number moves documents only into
    the new shards."""
    tree = even_tree(min(shards, base))
    for _ in range(shards - len(tree)):
        tree = grown(tree)
    return tree


def _draw(key: Sequence[Column], label: str, weight: float) -> Column:
    return -F.log(uniform(F.lit(label), *key)) / F.lit(float(weight))


def _winner(children: Sequence[tuple[Column, float, str]], key: Sequence[Column]) -> Column:
    """The value of the winning child; ``children`` are (value, weight, label)."""
    if len(children) == 1:
        return children[0][0]
    draws = F.array(*(F.struct(_draw(key, label, w).alias("d"), v.alias("v")) for v, w, label in children))
    return F.array_min(draws)["v"]


def shard_of(key: Sequence[Column], tree: Sequence[Leaf]) -> Column:
    """Shard number of a key: a region draw, then a rack draw inside it, then
    a shard draw inside that. A shard of weight 0 or less gets nothing."""
    regions: dict[str, dict[str, list[Leaf]]] = {}
    for leaf in tree:
        if leaf.weight > 0:
            regions.setdefault(leaf.region, {}).setdefault(leaf.rack, []).append(leaf)
    total = lambda leaves: sum(leaf.weight for leaf in leaves)
    children = []
    for region, racks in regions.items():
        inner = [(_winner([(F.lit(x.shard), x.weight, f"shard {x.shard}") for x in leaves], key), total(leaves),
                  f"rack {rack}") for rack, leaves in racks.items()]
        children.append((region, inner, sum(w for _, w, _ in inner)))
    if len(children) == 1:
        return _winner(children[0][1], key)
    region_of = _winner([(F.lit(r), w, f"region {r}") for r, _, w in children], key)
    # CASE descends only into the region that won
    found = F.when(region_of == children[0][0], _winner(children[0][1], key))
    for region, inner, _ in children[1:]:
        found = found.when(region_of == region, _winner(inner, key))
    return found


def assign_shards(docs: DataFrame, tree: Sequence[Leaf]) -> DataFrame:
    """One row per document row: ``doc_id, size, text_crc32, law, shard, slot,
    grown_shard``.

    The ``key`` law: ``doc_id`` and the tree decide. ``size`` is the text's
    UTF-8 bytes (null: none) plus 8, ``text_crc32`` the checksum of the text
    (null or empty: 0), ``grown_shard`` the shard with one more. ``slot`` is
    the place within the shard, gapless from 0 in hash order. Null ids share a
    key and so a shard; repeated ids share a shard and take a slot each; other
    columns are ignored. Places come from one range sort over all shards, so
    no task holds a whole shard.
    """
    key = [F.col("doc_id")]
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", (F.octet_length(text) + 8).cast("long").alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"), F.lit("key").alias("law"),
                       shard_of(key, tree).cast("int").alias("shard"),
                       shard_of(key, grown(tree)).cast("int").alias("grown_shard"))
    rows = stored(rows, "shard-rows")  # the range sort samples its input
    placed = ordered(rows, [F.col("shard"), F.xxhash64("doc_id", "text_crc32"), F.col("doc_id")], "shards")
    # bound: one row per shard of the tree
    firsts = F.broadcast(placed.groupBy("shard").agg(F.min("rank").alias("_first")))
    return placed.join(firsts, "shard").select("doc_id", "size", "text_crc32", "law", "shard",
                                               (F.col("rank") - F.col("_first")).alias("slot"), "grown_shard")


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` in shards 0 to 23; see ``tree_of`` and ``assign_shards``."""
    return assign_shards(read_table(spark, sf_dir, "documents"), tree_of(SHARDS))
