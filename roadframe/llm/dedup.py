"""Near-duplicate classes: ProbMinHash, banding, exact verification.

1. Equal texts fall together by a 128-bit hash; the rest works on distinct texts.
2. One pass over the texts gives signatures, band keys and shingle sets.
3. In every band bucket each text is compared with one centre, the text that
   shares most buckets, so a large group costs a row per text, not per pair.
4. Buckets that still hold several classes are searched block by block:
   first, round by round, each text outside its centre's class is compared
   with the text of another class that agrees best, until no round links any
   more, a round after the first only where the last one's links joined
   classes; then all pairs of different classes whose signatures agree often
   enough are verified where they meet, and only links leave the block.
Pairs count only if the probability Jaccard similarity of their weighted
shingles reaches the threshold, the one that registers estimate: the weight of
the common shingles over that of all, where a shingle weighs as many as it has
distinct words. Classes are the connected components of such pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadframe.llm.common import read_table, ship_package, stored
from roadframe.llm.components import components
from roadframe.llm.minhash import KIND_BITS, REGISTERS, SHINGLE, kinds, shingles, signatures
from roadframe.llm.words import Words, mix64, release, slices

SIMILARITY = 0.8
#: 20 bands of 5 registers: a pair at 0.8 shares a bucket with probability 0.9996
BAND_ROWS = 5
#: agreeing registers, as a share, from which step 4 verifies a pair: the
#: similarity less 3 standard deviations of the estimate
AGREE = SIMILARITY - 3 * (SIMILARITY * (1 - SIMILARITY) / REGISTERS) ** 0.5
#: texts of one side of a block in step 4
BLOCK = 256


def text_node(text: Column) -> Column:
    """Number of a text; null is as empty. Two texts may share one: see ``sketch``."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def text_hash(text: Column) -> Column:
    """Identity of a text: half of its SHA-256; null is as empty."""
    return F.unhex(F.substring(F.sha2(F.coalesce(text, F.lit("")), 256), 1, 32))


def sketch(docs: DataFrame) -> DataFrame:
    """``doc_id, node, hash, signature, bands, shingles``, one row per
    document, stored; words are lower-cased runs between white space.
    Signatures hold 4 bytes a register, shingle sets 4 bytes a shingle, its
    weight in the lowest bits. Different texts have different nodes: those
    that share the 64-bit number get new ones."""
    found = stored(_sketch(docs), "sketch")
    texts = found.groupBy("node", "hash").agg(F.count(F.lit(1)).alias("n"))
    shared = texts.groupBy("node").agg(F.count(F.lit(1)).alias("n"), F.min("hash").alias("first")).where("n > 1")
    shared = stored(shared.select("node", "first"), "shared-nodes")
    if shared.isEmpty():
        return found
    # a few texts at most; the first of each keeps the number
    fresh = texts.join(shared, "node").where("hash <> first").select(
        "node", "hash", F.xxhash64("hash", "node").alias("_fresh"))
    return stored(found.join(stored(fresh, "fresh-nodes"), ["node", "hash"], "left").withColumn(
        "node", F.coalesce("_fresh", "node")).select(*found.columns), "sketch")


def _sketch(docs: DataFrame) -> DataFrame:
    ship_package(docs.sparkSession)
    schema = "doc_id long, node long, hash binary, signature binary, bands array<long>, shingles array<int>"
    bands = REGISTERS // BAND_ROWS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 3):
                n = batch.num_rows
                owner, value, _ = shingles(Words(batch.column(3), lower=True), SHINGLE)
                registers = signatures(n, owner, value, kinds(value).astype(np.float64))
                keys = np.zeros((n, bands), np.uint64)
                with np.errstate(over="ignore"):
                    for i in range(BAND_ROWS):
                        keys = mix64(keys ^ registers[:, i::BAND_ROWS]) + np.uint64(1)
                short = registers.astype(np.uint32)  # the low bits
                cuts = np.searchsorted(owner, np.arange(n + 1)).astype(np.int32)
                has = np.diff(cuts) > 0
                places = np.concatenate(([0], np.cumsum(has * bands))).astype(np.int32)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0), batch.column(1), batch.column(2), pa.array([row.tobytes() for row in short], pa.binary()),
                    pa.ListArray.from_arrays(places, pa.array(keys[has].ravel().view(np.int64))),
                    pa.ListArray.from_arrays(cuts, pa.array(value.astype(np.uint32).view(np.int32)))],
                    names=["doc_id", "node", "hash", "signature", "bands", "shingles"])
        release()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_node(F.col("text")).alias("node"),
                       text_hash(F.col("text")).alias("hash"), "text")
    return rows.mapInArrow(run, schema)


def _weight(shingles: Column) -> Column:
    return F.aggregate(shingles, F.lit(0).cast("long"), lambda w, s: w + s.bitwiseAND(F.lit((1 << KIND_BITS) - 1)))


def verified(pairs: DataFrame, sets: DataFrame, threshold: float = SIMILARITY) -> DataFrame:
    """The ``(a, b)`` rows whose weighted shingles reach ``threshold``; the
    joins are split by Spark where one text has very many partners."""
    weighed = sets.select("node", "shingles", _weight(F.col("shingles")).alias("weight"))
    one = weighed.select(F.col("node").alias("a"), F.col("shingles").alias("_x"), F.col("weight").alias("_u"))
    two = weighed.select(F.col("node").alias("b"), F.col("shingles").alias("_y"), F.col("weight").alias("_v"))
    joined = pairs.hint("merge").join(one, "a").hint("merge").join(two, "b")
    # weights alone rule out many pairs
    joined = joined.where(F.least("_u", "_v") >= threshold * F.greatest("_u", "_v"))
    common = joined.withColumn("_common", _weight(F.array_intersect("_x", "_y")))
    return common.where(F.col("_common") >= threshold * (F.col("_u") + F.col("_v") - F.col("_common"))).select("a", "b")


def _labelled(buckets: DataFrame, classes: DataFrame) -> DataFrame:
    """Bucket rows with their class, that of their centre (``main``) and
    whether the two differ (``open``), stored."""
    known = buckets.join(classes, "node", "left").withColumn("component", F.coalesce("component", "node"))
    of_centre = classes.select(F.col("node").alias("centre"), F.col("component").alias("main"))
    known = known.join(of_centre, "centre", "left").withColumn("main", F.coalesce("main", "centre"))
    return stored(known.withColumn("open", F.col("component") != F.col("main")), "known")


def _opened(known: DataFrame) -> DataFrame:
    """The rows of the buckets that have an open text, with their number
    (``n_open``), stored."""
    sizes = known.groupBy("band", "key").agg(F.sum(F.col("open").cast("long")).alias("n_open")).where("n_open > 0")
    return stored(known.join(stored(sizes, "open-keys"), ["band", "key"]), "open-rows")


def _between(links: DataFrame, classes: DataFrame) -> DataFrame:
    """``links`` as pairs ``(a, b)`` of the classes that they join, stored."""
    for end in ("a", "b"):
        of = classes.select(F.col("node").alias(end), F.col("component").alias("_class"))
        links = links.join(of, end, "left").withColumn(end, F.coalesce("_class", end)).drop("_class")
    return stored(links.select("a", "b"), "class-links")


def _relabelled(rows: DataFrame, merged: DataFrame) -> DataFrame:
    """Rows of ``_opened`` after classes were ``merged`` (``node``, a class,
    is now in ``component``), stored."""
    for name in ("component", "main"):
        now = merged.select(F.col("node").alias(name), F.col("component").alias("_now"))
        rows = rows.join(now, name, "left").withColumn(name, F.coalesce("_now", name)).drop("_now")
    return stored(rows.drop("n_open").withColumn("open", F.col("component") != F.col("main")), "known")


def _grown(opened: DataFrame, merged: DataFrame, joined: DataFrame) -> DataFrame:
    """The rows to search again after the links ``joined`` between classes:
    the buckets that hold a text of a class that grew, and only the texts of
    such classes are open. The others would find the same texts as before, or
    ones that agree as much; the last search verifies all that agree enough."""
    grew = merged.join(joined.select(F.col("a").alias("node")), "node", "left_semi").select("component").distinct()
    grew = stored(grew, "grown")
    parts = merged.join(grew, "component", "left_semi").select(F.col("node").alias("component"))
    keys = opened.join(parts, "component", "left_semi").select("band", "key").distinct()
    known = _relabelled(opened.join(stored(keys, "grown-keys"), ["band", "key"], "left_semi"), merged)
    known = known.join(grew.withColumn("_grew", F.lit(True)), "component", "left")
    return _opened(known.withColumn("open", F.col("open") & F.col("_grew").isNotNull()).drop("_grew"))


def _blocks(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of buckets dealt to block pairs: every open text to all blocks of
    members, every member to all blocks of open texts."""
    deal = lambda n: F.pmod(F.xxhash64("node", "band"), n).cast("int")
    member_blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    open_blocks = F.ceil(F.col("n_open") / BLOCK).cast("int")
    spread = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    left = rows.where("open").select("band", "key", "node", "component", deal(open_blocks).alias("i"),
                                     spread(member_blocks).alias("j"))
    right = rows.select("band", "key", "node", "component", "open", deal(member_blocks).alias("j"),
                        spread(open_blocks).alias("i"))
    return left, right


def _similar(x: np.ndarray, y: np.ndarray, threshold: float) -> bool:
    """Whether the weighted Jaccard similarity of two sorted sets reaches the threshold."""
    one, two = int(kinds(x).sum()), int(kinds(y).sum())
    if min(one, two) < threshold * max(one, two):
        return False
    common = int(kinds(y[x[np.minimum(np.searchsorted(x, y), len(x) - 1)] == y]).sum())
    return common >= threshold * (one + two - common)


def _searched(left: DataFrame, right: DataFrame, sketches: DataFrame, threshold: float, best: bool) -> DataFrame:
    """Pairs ``a < b`` of an open text and a member of another class whose
    signatures agree on at least AGREE of the registers. With ``best``: for
    each open text of a block the one that agrees most, yet to be verified.
    Else all pairs are verified in their block, each in the first band that
    its texts share, but for texts that the block has linked already; the
    links found are returned."""
    sides = sketches.select("node", "signature", *([] if best else ["bands", "shingles"]))
    keys = ["band", "key", "i", "j"]

    def search(one: pa.Table, two: pa.Table) -> pa.Table:
        a, b = [], []
        if one.num_rows and two.num_rows:
            band = one.column("band")[0].as_py()
            x, y = (np.frombuffer(b"".join(t.column("signature").to_pylist()), np.uint32).reshape(-1, REGISTERS)
                    for t in (one, two))
            nx, ny = (t.column("node").to_numpy() for t in (one, two))
            cx, cy = (t.column("component").to_numpy().copy() for t in (one, two))
            if not best:
                bx, by = (np.array(t.column("bands").to_pylist(), np.int64) for t in (one, two))
                sx, sy = ([np.sort(v.values.to_numpy()) for v in t.column("shingles")] for t in (one, two))
                open_y = two.column("open").to_numpy(zero_copy_only=False).astype(bool)
            for r in range(len(nx)):
                agree = (x[r] == y).mean(axis=1)
                fit = (agree >= AGREE) & (cy != cx[r])
                if best:
                    hit = np.flatnonzero(fit & (agree == np.max(agree, where=fit, initial=0.0)))[:1].tolist()
                else:
                    fit &= ~open_y | (ny > nx[r])
                    if band:  # searched in an earlier band already
                        fit &= ~(bx[r, :band] == by[:, :band]).any(axis=1)
                    hit = []
                    for k in np.flatnonzero(fit)[np.argsort(-agree[fit], kind="stable")].tolist():
                        if cx[r] != cy[k] and _similar(sx[r], sy[k], threshold):
                            hit.append(k)
                            cx[cx == cy[k]] = cx[r]
                            cy[cy == cy[k]] = cx[r]
                a.extend([nx[r]] * len(hit))
                b.extend(ny[hit])
        a, b = np.array(a, np.int64), np.array(b, np.int64)
        return pa.table({"a": np.minimum(a, b), "b": np.maximum(a, b)})

    one, two = (side.join(sides, "node") for side in (left, right))
    one, two = (side.toDF(*side.columns) for side in (one, two))  # fresh columns: both come from one table
    return one.groupBy(*keys).cogroup(two.groupBy(*keys)).applyInArrow(search, "a long, b long")


def near_duplicates(docs: DataFrame, threshold: float = SIMILARITY) -> DataFrame:
    """One row per document row: ``doc_id, class_id, links, copies, node,
    component`` (numbers of its text and its class), ``text_hash``.

    ``class_id`` is the smallest ``doc_id`` of its class (null ids do not
    count; a class of null ids only has null). ``copies`` is the number of
    rows with the very same text, ``links`` that of verified links to other
    texts found on the way. Null and empty texts are one class; texts without
    words fall together only if equal; a text of fewer than five words is one
    shingle; repeated rows are copies; other columns are ignored; an empty
    table gives no rows.
    """
    sketches = sketch(docs)
    texts = stored(sketches.groupBy("node", "hash").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies")),
                   "texts")
    rows = sketches.select("node", F.posexplode("bands").alias("band", "key")).distinct()
    # stored, so that the joins see plain shuffles, which Spark splits where a key is hot
    shared = stored(rows.groupBy("band", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "shared-keys")
    buckets = stored(rows.join(shared, ["band", "key"]), "buckets")
    fame = buckets.groupBy("node").agg(F.sum("n").alias("fame"))
    famous = buckets.join(fame, "node")
    centres = stored(famous.groupBy("band", "key").agg(F.max(F.struct("fame", "node"))["node"].alias("centre")), "centres")
    buckets = stored(buckets.join(centres, ["band", "key"]), "centred")
    used = buckets.select("node").distinct()
    # one sketch per text that shares a bucket; equal sketches of copies fall together before the shuffle
    sides = stored(sketches.dropDuplicates(["node"]).join(used.hint("merge"), "node", "left_semi"), "candidates")
    pairs = buckets.where("node <> centre").select(
        F.least("node", "centre").alias("a"), F.greatest("node", "centre").alias("b")).distinct()
    tested = stored(pairs, "pairs")
    found = stored(verified(tested, sides, threshold), "links")
    classes = components(found)
    # a closed bucket stays closed: from here on only the open ones are read
    rows = opened = _opened(_labelled(buckets, classes))
    sides = stored(sides.join(opened.select("node").distinct().hint("merge"), "node", "left_semi"), "open-candidates")
    joined = merged = None  # links between the classes of step 3, and the classes that they make
    while True:
        pairs = stored(_searched(*_blocks(rows), sides, threshold, best=True), "open-pairs").distinct()
        pairs = stored(pairs.join(tested, ["a", "b"], "left_anti"), "new-pairs")
        ends = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        more = stored(verified(pairs, sides.join(ends, "node", "left_semi"), threshold), "new-links")
        if more.isEmpty():
            break
        found, tested = found.union(more), tested.union(pairs)
        new = _between(more, classes)
        joined = stored(joined.union(new), "joined") if joined is not None else new
        merged = components(joined)
        rows = _grown(opened, merged, new)
    rows = _opened(_relabelled(opened, merged)) if merged is not None else opened
    more = stored(_searched(*_blocks(rows), sides, threshold, best=False).distinct(), "last-links")
    if not more.isEmpty():
        found = found.union(more)
        new = _between(more, classes)
        merged = components(joined.union(new) if joined is not None else new)
    if merged is not None:
        now = merged.select(F.col("node").alias("component"), F.col("component").alias("_now"))
        loose = merged.select("node", F.col("node").alias("component")).join(classes, "node", "left_anti")
        classes = classes.union(loose).join(now, "component", "left").select("node", F.coalesce("_now", "component").alias("component"))
    links = found.select("a").union(found.select("b")).groupBy("a").agg(F.count(F.lit(1)).alias("links"))

    texts = texts.withColumnRenamed("hash", "text_hash")
    named = texts.join(classes, "node", "left").withColumn("component", F.coalesce("component", "node"))
    names = named.groupBy("component").agg(F.min("rep").alias("class_id"))
    named = named.join(names, "component").join(links.withColumnRenamed("a", "node"), "node", "left")
    named = named.select("node", "component", "class_id", F.coalesce("links", F.lit(0)).cast("long").alias("links"), "copies", "text_hash")
    return sketches.select("doc_id", "node").join(named, "node").select(
        "doc_id", "class_id", "links", "copies", "node", "component", "text_hash")


def keep_one(docs: DataFrame, threshold: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs`` without near duplicates: of every class the row
    with its class's id stays (a class of null ids keeps one of its rows)."""
    columns = docs.columns
    classes = stored(near_duplicates(docs, threshold), "classes")
    stay = classes.where(F.col("doc_id").eqNullSafe(F.col("class_id"))).groupBy("component", "doc_id", "text_hash").agg(
        F.count(F.lit(1)).alias("rows"))
    stay = stay.groupBy("component").agg(F.min(F.struct("text_hash", "doc_id", "rows")).alias("k")).select(
        F.col("k.text_hash").alias("_text"), F.col("k.doc_id").alias("_id"), F.col("k.rows").alias("_rows"))
    marked = docs.withColumn("_own", text_hash(F.col("text")))
    kept = marked.join(stay, (F.col("_own") == F.col("_text")) & marked["doc_id"].cast("long").eqNullSafe(F.col("_id")))
    # equal rows: one stays
    single = kept.where("_rows = 1")
    repeated = kept.where("_rows > 1").dropDuplicates(["_id", "_text"])
    return single.select(*columns).unionByName(repeated.select(*columns))


def op2_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of all ``documents``; see ``near_duplicates``."""
    return near_duplicates(read_table(spark, sf_dir, "documents"))
