"""Main text of web pages by a suffix array over the pages of a host.

The token streams of a host's pages are put one after another. Sorting their
suffixes by the first ``RUN`` tokens (prefix doubling) brings equal substrings
together; runs that stand on many distinct pages of the host are boilerplate.
Covered boilerplate is removed, unique runs are kept.

A host beyond ``SECTION_BYTES`` is dealt to sections, each with a suffix array
of its own, but what decides is always the number of pages of the whole host:
a run on a given share of a host's pages has that share in some section too,
so the sections name all candidates, count them, and use the summed counts.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadframe.llm.common import read_table, ship_package, stored
from roadframe.llm.pagetext import page_blocks
from roadframe.llm.words import mix64, release
from roadframe.operators.joins import join_summary

#: tokens of a repeated substring; a shorter block counts as a whole
RUN = 8
#: bytes of html in one suffix array (a longer page stands alone)
SECTION_BYTES = 1 << 20
#: share and number of a host's pages from which a repeated substring is
#: boilerplate: outside an article, and inside one
SHARE, PAGES = 0.25, 3
MAIN_SHARE, MAIN_PAGES = 0.6, 5
#: an article that repeats by more than this share is a copy, not boilerplate
COPY = 0.8


def host_of(url: Column) -> Column:
    """Host part of a URL in lower case; empty if there is none."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/:?#]*)", 1))


def suffix_ranks(tokens: np.ndarray, depth: int = RUN) -> np.ndarray:
    """Rank of every suffix by its first ``depth`` tokens (a power of two);
    equal ranks mean equal substrings. The stream's end counts as smallest."""
    _, rank = np.unique(tokens, return_inverse=True)
    rank, width = rank.astype(np.int64) + 1, 1
    while width < depth:
        after = np.zeros_like(rank)
        after[:-width] = rank[width:]
        _, rank = np.unique(rank * (len(tokens) + 2) + after, return_inverse=True)
        rank, width = rank.astype(np.int64) + 1, 2 * width
    return rank


@dataclass
class Section:
    """Suffix array of some pages: blocks by page, and the substrings of RUN
    tokens (or whole shorter blocks), which do not cross blocks."""

    words: list[list[str]]
    page: np.ndarray  # number of each block's page, equal for rows of one page
    main: np.ndarray
    pages: int
    unique: pa.Array  # the words that the stream's numbers from 1 on stand for
    stream: np.ndarray
    place: np.ndarray  # of every word in the stream
    at: np.ndarray  # places where substrings begin
    block: np.ndarray  # and their blocks
    rank: np.ndarray
    spread: np.ndarray  # distinct pages of every rank

    def names(self) -> np.ndarray:
        """A 64-bit hash of every rank's substring, the same in all sections."""
        hashes = np.array([0, *(xxhash.xxh3_64_intdigest(w) for w in self.unique.to_pylist())], np.uint64)
        first = np.zeros(len(self.spread), np.int64)
        first[self.rank] = self.at
        out = np.zeros(len(self.spread), np.uint64)
        padded = np.concatenate((self.stream, np.zeros(RUN, np.int64)))
        for k in range(RUN):
            out = mix64(out * np.uint64(0x9E3779B97F4A7C15) + hashes[padded[first + k]])
        return out.astype(np.int64)


def section_of(parts: list[list[tuple[bool, str]]], page: list) -> Section:
    """Suffix array of the pages' blocks; rows of one page id are one page."""
    identity: dict = {}
    numbers = [identity.setdefault(("row", i) if p is None else p, len(identity)) for i, p in enumerate(page)]
    flat = [(numbers[i], is_main, text) for i, found in enumerate(parts) for is_main, text in found]
    words = [text.split(" ") for _, _, text in flat]
    owner = np.array([n for n, _, _ in flat], np.int64)
    main = np.array([m for _, m, _ in flat], bool)
    sizes = np.array([len(w) for w in words], np.int64)
    none = np.zeros(0, np.int64)
    if not len(sizes):
        return Section(words, owner, main, len(identity), pa.array([], pa.string()), none, none, none, none, none, np.zeros(1, np.int64))
    tokens = pa.array([w for ws in words for w in ws], pa.large_string()).dictionary_encode()
    code = tokens.indices.to_numpy(zero_copy_only=False).astype(np.int64) + 1
    # blocks with RUN - 1 end marks (0) after each
    starts = np.cumsum(sizes + RUN - 1) - (sizes + RUN - 1)
    stream = np.zeros(int(sizes.sum()) + len(sizes) * (RUN - 1), np.int64)
    within = np.arange(len(code)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    block = np.repeat(np.arange(len(sizes)), sizes)
    place = starts[block] + within
    stream[place] = code
    rank = suffix_ranks(stream)[place]
    whole = (within + RUN <= sizes[block]) | (within == 0)  # full substrings, and short blocks
    rank, at, block = rank[whole], place[whole], block[whole]
    pairs = np.unique(rank * len(identity) + owner[block])
    spread = np.bincount(pairs // len(identity), minlength=int(rank.max()) + 1)
    return Section(words, owner, main, len(identity), tokens.dictionary, stream, place, at, block, rank, spread)


def covered(section: Section, spread: np.ndarray, pages: int) -> list[np.ndarray]:
    """For each block which words are covered by boilerplate, given the pages
    of the host that hold each substring. An article that is mostly covered is
    a copy of another one and loses nothing."""
    sizes = [len(w) for w in section.words]
    if not len(section.stream):
        return [np.zeros(n, bool) for n in sizes]
    least = np.where(section.main[section.block], max(MAIN_PAGES, MAIN_SHARE * pages), max(PAGES, SHARE * pages))
    hit = section.at[spread[section.rank] >= least]
    edge = np.zeros(len(section.stream) + RUN, np.int64)
    np.add.at(edge, hit, 1)
    np.add.at(edge, hit + RUN, -1)
    gone = np.cumsum(edge)[section.place] > 0
    return np.split(gone, np.cumsum(sizes)[:-1])


def main_text(parts: list[list[tuple[bool, str]]], section: Section, spread: np.ndarray, pages: int) -> list[str]:
    """Text of each page: the words of its blocks that no boilerplate covers."""
    masks = covered(section, spread, pages)
    out, at = [], 0
    for found in parts:
        words, gone = section.words[at:at + len(found)], masks[at:at + len(found)]
        at += len(found)
        if found and found[0][0] and sum(int(g.sum()) for g in gone) > COPY * sum(map(len, words)):
            out.append("\n\n".join(text for _, text in found))
            continue
        left = (" ".join(w for w, g in zip(ws, mask, strict=True) if not g) if mask.any() else text
                for (_, text), ws, mask in zip(found, words, gone, strict=True))
        out.append("\n\n".join(text for text in left if text))
    return out


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of every page, packed: they are a fraction of the html."""
    for batch in batches:
        packed = [zlib.compress(json.dumps(page_blocks(page.as_py()), ensure_ascii=False).encode("utf-8", "surrogatepass"), 6)
                  for page in batch.column(4)]
        yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(4)), pa.array(packed, pa.binary())],
                                         names=["host", "section", "page_id", "url", "packed"])


_SECTION = "host string, section long, page_ids array<long>, urls array<string>, packed array<binary>"


def _gather(table: pa.Table) -> pa.Table:
    """One row of a section's pages."""
    whole = lambda name, kind: pa.array([table.column(name).to_pylist()], pa.list_(kind))
    return pa.table({"host": table.column("host")[:1], "section": table.column("section")[:1],
                     "page_ids": whole("page_id", pa.int64()), "urls": whole("url", pa.string()),
                     "packed": whole("packed", pa.binary())})


def _unpacked(pages: list[bytes]) -> list[list[tuple[bool, str]]]:
    return [[(m, t) for m, t in json.loads(zlib.decompress(p).decode("utf-8", "surrogatepass"))] for p in pages]


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Substrings on the least share of a section's pages; the hosts are those
    of several sections."""
    for batch in batches:
        for row in batch.to_pylist():
            section = section_of(_unpacked(row["packed"]), row["page_ids"])
            found = np.flatnonzero(section.spread >= max(1, SHARE * section.pages))
            runs = section.names()[found] if len(found) else found
            yield pa.RecordBatch.from_arrays([pa.array([row["host"]] * len(found), pa.string()), pa.array(runs, pa.int64())],
                                             names=["host", "run"])


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pages of a section that hold each of the host's candidates."""
    for batch in batches:
        for row in batch.to_pylist():
            section = section_of(_unpacked(row["packed"]), row["page_ids"])
            names = section.names()
            known = np.flatnonzero((section.spread > 0) & np.isin(names, np.array(row["runs"], np.int64)))
            yield pa.RecordBatch.from_arrays(
                [pa.array([row["host"]] * len(known), pa.string()), pa.array(names[known], pa.int64()),
                 pa.array(section.spread[known], pa.int64())], names=["host", "run", "pages"])


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts of a section's pages; ``host_pages`` and the counts are given
    where the host has several sections."""
    for batch in batches:
        for row in batch.to_pylist():
            parts, ids, host_pages = _unpacked(row["packed"]), row["page_ids"], row["host_pages"]
            if host_pages is not None and not row["runs"]:  # nothing on this host repeats enough
                texts = ["\n\n".join(text for _, text in found) for found in parts]
            else:
                section = section_of(parts, ids)
                spread, pages = section.spread, section.pages
                if host_pages is not None and len(section.stream):
                    order = np.argsort(np.array(row["runs"], np.int64))
                    runs, counts = (np.append(np.array(row[c], np.int64)[order], 0) for c in ("runs", "counts"))
                    names, pages = section.names(), host_pages
                    at = np.searchsorted(runs[:-1], names)
                    spread = np.where(runs[at] == names, counts[at], 0)
                texts = main_text(parts, section, spread, pages)
            found = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(row["urls"], pa.string()), found,
                                              pc.utf8_length(found).cast(pa.int64())], names=["page_id", "url", "text", "n_chars"])
        release()


def extract(pages: DataFrame, section_bytes: int = SECTION_BYTES) -> DataFrame:
    """One row per page row: ``page_id, url, text, n_chars``.

    Null and empty html, and pages without text of their own, give an empty
    text. Null urls are one host. Rows repeated with one page_id count as one
    page of their host. Extra columns are ignored; an empty table gives no
    rows. A host of more than ``section_bytes`` of html is dealt to sections by
    a hash of the page; counts are those of the whole host for every size.
    """
    spark = pages.sparkSession
    ship_package(spark)
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html").withColumn("host", host_of(F.col("url")))
    sizes = rows.groupBy("host").agg(F.sum(F.coalesce(F.octet_length("html"), F.lit(0)) + 64).alias("bytes"))
    # the hosts to split, one row each; Spark broadcasts the stored table if its size allows
    large = stored(sizes.where(F.col("bytes") > section_bytes).select(
        "host", F.ceil(F.col("bytes") / section_bytes).alias("sections")), "large-hosts")
    page = F.when(F.col("page_id").isNull(), F.xxhash64("url", "html")).otherwise(F.xxhash64("page_id"))
    dealt = rows.join(large, "host", "left").withColumn("section", F.pmod(page, F.coalesce("sections", F.lit(1))))
    schema = "host string, section long, page_id long, url string, packed binary"
    parsed = dealt.select("host", "section", "page_id", "url", "html").mapInArrow(_parse, schema)
    key = ["host", "section"]
    sections = stored(parsed.groupBy(*key).applyInArrow(_gather, _SECTION), "page-sections")  # about section_bytes of html each
    known = sections.select(*key, F.lit(None).cast("array<long>").alias("runs"), F.lit(None).cast("array<long>").alias("counts"),
                            F.lit(None).cast("long").alias("host_pages")).limit(0)
    if not large.isEmpty():
        split = sections.join(large, "host").select(*key, "page_ids", "packed")
        candidates = split.mapInArrow(_candidates, "host string, run long").distinct()
        # a candidate is on a share of some section's pages, so a section names at most its words a page over that share
        lists = split.select(*key).join(candidates.groupBy("host").agg(F.collect_list("run").alias("runs")), "host")
        # sections travel again only where the lists are too large to be broadcast
        counts = join_summary(split, lists, key).mapInArrow(_counts, "host string, run long, pages long")
        ids = split.select("host", F.explode("page_ids").alias("page_id"))
        total = ids.groupBy("host").agg((F.count_distinct("page_id") + F.count_if(F.col("page_id").isNull())).alias("host_pages"))
        # counts that no threshold asks for are left out
        summed = counts.groupBy("host", "run").agg(F.sum("pages").alias("pages")).join(total, "host").where(
            F.col("pages") >= F.col("host_pages") * SHARE)
        found = summed.groupBy("host").agg(F.collect_list(F.struct("run", "pages")).alias("found"))
        known = split.select(*key).join(total, "host").join(found, "host", "left").select(
            *key, F.transform("found", lambda x: x["run"]).alias("runs"), F.transform("found", lambda x: x["pages"]).alias("counts"),
            "host_pages")
    return join_summary(sections, known, key, "left").mapInArrow(_texts, "page_id long, url string, text string, n_chars long")


def op7_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main texts of all ``pages``; see ``extract``."""
    return extract(read_table(spark, sf_dir, "pages"))
