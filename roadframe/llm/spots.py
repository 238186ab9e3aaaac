"""Document fingerprints by SpotSigs: chains of content words that follow
common-word anchors. A document's fingerprint is the set of its spots.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadframe.llm.common import read_table, ship_package, shuffle_partitions, stored
from roadframe.llm.words import Words, mix64, slices

#: common words of the corpus languages; every other word is a content word
ANCHORS = (
    "a an and are as at be been but by can for from had has have he her his if in is it its not of on or she that "
    "the their there they this to was we were which who will with you "
    "au aux avec ce ces dans de des du elle en est et il la le les leur mais ne ou par pas pour que qui sa se ses son "
    "sur un une "
    "aber als am auch auf aus bei das dem den der des die ein eine einer es für hat ich ihr im ist mit nicht noch nur "
    "oder sich sie sind so um und von vor war wie wird zu zum zur "
    "al como con del el ella entre era ha hay las lo los más me mi muy o para pero por porque sin sobre su sus también "
    "tan te tu y ya "
).split()
#: content words in a chain
CHAIN = 2
SEPARATORS = r"[^\p{L}\p{N}]+"


def spot_sets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """``(spots, cuts)``: the sorted distinct 32-bit spots of text ``i`` stand
    at ``cuts[i]:cuts[i + 1]``.

    A spot is an anchor and the ``CHAIN`` content words after it; one that the
    text's end cuts short is shorter. A text whose words hold no anchor with a
    content word after it lets every word anchor the chain after it; a text of
    one word has that word, and one without words has no spots.
    """
    plain = pc.replace_substring_regex(pc.utf8_lower(pc.fill_null(texts.cast(pa.large_string()), "")), SEPARATORS, " ")
    words = Words(plain)
    n, code, owner = len(texts), words.code, words.owner
    if not len(code):
        return np.zeros(0, np.uint32), np.zeros(n + 1, np.int64)
    hashes = words.hashes(1)[code]
    anchor = pc.is_in(words.unique, pa.array(ANCHORS, words.unique.type)).to_numpy(zero_copy_only=False)[code]
    found, who = _chains(hashes, owner, anchor, np.flatnonzero(~anchor))
    bare = np.bincount(who, minlength=n) == 0
    if bare.any():
        places = np.flatnonzero(bare[owner])
        more, more_who = _chains(hashes[places], owner[places], np.ones(len(places), bool), np.arange(len(places)))
        single = np.flatnonzero(bare & (words.counts == 1))
        found = np.concatenate((found, more, hashes[words.offsets[single]]))
        who = np.concatenate((who, more_who, single))
    key = np.unique(who.astype(np.uint64) << np.uint64(32) | mix64(found) >> np.uint64(32))
    return key.astype(np.uint32), np.searchsorted(key >> np.uint64(32), np.arange(n + 1))


def _chains(hashes: np.ndarray, owner: np.ndarray, anchor: np.ndarray, content: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Chain hashes of all anchors that a content word of their text follows."""
    at = np.flatnonzero(anchor)
    following = np.searchsorted(content, at, side="right")
    value, some = mix64(hashes[at]), np.zeros(len(at), bool)
    with np.errstate(over="ignore"):
        for k in range(CHAIN):
            inside = following + k < len(content)
            place = content[np.minimum(following + k, max(len(content) - 1, 0))] if len(content) else at
            inside &= owner[place] == owner[at]
            value = np.where(inside, mix64(value ^ hashes[place]) + np.uint64(k + 1), value)
            some |= inside
    return value[some], owner[at[some]]


def pruned_jaccard(a: np.ndarray, b: np.ndarray, floor: float = 0.0) -> float:
    """Jaccard similarity of two sorted sets. The sizes alone bound it by
    min / max; where that bound is below ``floor``, the sets are not compared
    and the answer is 0. Two empty sets are alike."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    if min(len(a), len(b)) < floor * max(len(a), len(b)):
        return 0.0
    common = int((a[np.minimum(np.searchsorted(a, b), len(a) - 1)] == b).sum())
    return common / (len(a) + len(b) - common)


def as_text(spots: np.ndarray) -> str:
    """Eight hexadecimal digits a spot, ascending."""
    return spots.astype(">u4").tobytes().hex()


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, spots``: each document's spots (array of int, as signed)."""
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 1):
                spots, cuts = spot_sets(batch.column(1))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.ListArray.from_arrays(cuts.astype(np.int32), pa.array(spots.view(np.int32)))],
                    names=["doc_id", "spots"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, spots array<int>")


def similar_pairs(docs: DataFrame, threshold: float = 0.8) -> DataFrame:
    """``a, b, similarity`` between distinct fingerprints, by their smallest
    doc_id, where the Jaccard similarity reaches ``threshold``.

    Fingerprints are partitioned by set length so that only neighbouring
    partitions can hold similar sets: partition ``k`` has lengths from
    ``threshold ** -k`` on. Within those, a pair must share one of the rarest
    ``length - ceil(threshold * length) + 1`` spots of both. Documents without
    spots have no pairs.
    """
    step = 1.0 / threshold
    sets = fingerprints(docs).where(F.size("spots") > 0).groupBy("spots").agg(F.min("doc_id").alias("id"))
    sets = stored(sets.withColumn("part", F.floor(F.log(F.size("spots").cast("double")) / F.log(F.lit(step)) + 1e-9)), "spots")
    spread = stored(sets.select("id", F.explode("spots").alias("spot")).groupBy("spot").agg(F.count(F.lit(1)).alias("n")), "spot-counts")
    ranked = sets.select("id", F.explode("spots").alias("spot")).join(spread, "spot").groupBy("id").agg(
        F.array_sort(F.collect_list(F.struct("n", "spot"))).alias("ranked"))
    head = F.size("ranked") - F.ceil(F.lit(threshold) * F.size("ranked") - 1e-9).cast("int") + 1
    heads = sets.join(ranked, "id").select("id", "part", F.size("spots").alias("size"),
                                           F.explode(F.slice("ranked", F.lit(1), head)).alias("first"))
    heads = stored(heads.select("id", "part", "size", F.col("first")["spot"].alias("spot")), "spot-heads")
    two = heads.select(F.col("id").alias("other"), F.explode(F.array("part", F.col("part") + 1)).alias("part"),
                       F.col("size").alias("other_size"), "spot")
    pairs = heads.join(two, ["part", "spot"]).where(
        (F.col("id") != F.col("other")) & (F.least("size", "other_size") >= threshold * F.greatest("size", "other_size")))
    pairs = pairs.select(F.least("id", "other").alias("a"), F.greatest("id", "other").alias("b")).distinct()
    one, other = (sets.select(F.col("id").alias(c), F.col("spots").alias(f"s{c}")) for c in "ab")
    common = F.size(F.array_intersect("sa", "sb"))
    return pairs.join(one, "a").join(other, "b").select(
        "a", "b", (common / (F.size("sa") + F.size("sb") - common)).alias("similarity")).where(F.col("similarity") >= threshold)


def with_next(docs: DataFrame, parts: int | None = None) -> DataFrame:
    """``part, doc_id, text, tail`` sorted within tasks by part and descending
    doc_id, every part followed by the first document of the next one (``tail``
    true; the last part by the very first document).

    Parts are ranges of doc_id by quantile, so a task holds neighbours and the
    only rows sent twice are one per part. An id that fills several quantiles
    is split by text hash.
    """
    parts = parts or shuffle_partitions(docs.sparkSession)
    # nulls come last; equal ids by text hash
    ident = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"),
                       ident.alias("_id"))
    shares = [i / parts for i in range(1, parts)]
    cuts = rows.agg(F.percentile_approx("_id", F.array(*map(F.lit, shares or [0.5])), 10_000)).head()[0] or []
    times = Counter(cuts)
    cuts = [(c, -(1 << 63) + k * ((1 << 64) // times[c])) for c in times for k in range(times[c])]
    # part 0 holds the largest ids; a literal array of one bound per partition
    bounds = F.array(*(F.struct(F.lit(c).alias("id"), F.lit(t).cast("long").alias("tie")) for c, t in cuts)) \
        if cuts else F.array().cast("array<struct<id:bigint,tie:bigint>>")
    rows = rows.withColumn("_tie", F.xxhash64("text"))
    part = F.size(F.filter(bounds, lambda b: (b["id"] > F.col("_id")) | ((b["id"] == F.col("_id")) & (b["tie"] > F.col("_tie")))))
    rows = rows.withColumn("part", part)
    heads = rows.groupBy("part").agg(F.max(F.struct("_id", "_tie")).alias("h")).orderBy("part").collect()  # one row per part
    table = [(r["part"], heads[i - 1]["part"], r["h"]["_id"], r["h"]["_tie"]) for i, r in enumerate(heads)]
    spark = docs.sparkSession
    firsts = F.broadcast(spark.createDataFrame(table, "part int, before int, h_id long, h_tie long"))
    rows = rows.join(firsts, "part")
    is_head = (F.col("_id") == F.col("h_id")) & (F.col("_tie") == F.col("h_tie"))
    again = F.when(is_head, F.array(F.struct(F.col("part").alias("to"), F.lit(False).alias("tail")),
                                    F.struct(F.col("before").alias("to"), F.lit(True).alias("tail")))).otherwise(
        F.array(F.struct(F.col("part").alias("to"), F.lit(False).alias("tail"))))
    dealt = rows.select("doc_id", "text", "_id", "_tie", F.explode(again).alias("d")).select(
        F.col("d.to").alias("part"), "doc_id", "text", "_id", "_tie", F.col("d.tail").alias("tail"))
    return dealt.repartitionByRange(parts, "part").sortWithinPartitions(
        F.col("part"), F.col("tail"), F.col("_id").desc(), F.col("_tie").desc()).select("part", "doc_id", "text", "tail")


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """One row per document row: ``doc_id, n_chars, edited_sha256,
    fingerprint, edited_fingerprint, near_edited, near_next``.

    The next document is the one of the next smaller doc_id (after the last:
    the first; null ids last; equal ids by text hash; a single document is its
    own next). Null texts are empty. Likenesses are Jaccard similarities of
    spot sets. Other columns are ignored; an empty table gives no rows.
    """
    ship_package(docs.sparkSession)
    schema = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
              "near_edited double, near_next double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the row before: part, doc_id, text, spots
        for whole in batches:
            for batch in slices(whole, 2):
                spots, cuts = spot_sets(batch.column(2))
                part, doc_id, text, tail = (batch.column(i).to_pylist() for i in range(4))
                rows = []
                for i in range(batch.num_rows):
                    following = spots[cuts[i]:cuts[i + 1]]
                    # a part's tail row only completes the row before it; repeated heads come as repeated tails
                    if held is not None and held[0] == part[i]:
                        rows.append((*held, text[i], following))
                    held = None if tail[i] else (part[i], doc_id[i], text[i], following.copy())
                if not rows:
                    continue
                edited = []
                for _, _, own, _, nxt, _ in rows:
                    k = len(own) // 3
                    edited.append(own[:len(own) - k] + nxt[:k])
                new, new_cuts = spot_sets(pa.array(edited, pa.large_string()))
                out = []
                for i, (_, who, own, mine, _, theirs) in enumerate(rows):
                    changed = new[new_cuts[i]:new_cuts[i + 1]]
                    out.append((who, len(own), hashlib.sha256(edited[i].encode()).hexdigest(), as_text(mine),
                                as_text(changed), pruned_jaccard(mine, changed), pruned_jaccard(mine, theirs)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)],
                    names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    return with_next(docs).mapInArrow(run, schema)


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all ``documents`` and their edited texts; see
    ``edited_fingerprints``."""
    return edited_fingerprints(read_table(spark, sf_dir, "documents"))
