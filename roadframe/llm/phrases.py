"""Phrase collocation mining: counts of word runs, level by level, by
double-array tries over the numbers of frequent words.

Every text is lower-cased (A-Z) and cut into pieces and words once, and its
frequent words are written as numbers. At level k the trie holds the frequent
phrases of k - 1 words; numpy advances the states of all positions of a block
together. What passes one trie's size is dealt to several by a hash; a position
asks its own trie only, so a level reads its blocks once. A position whose own
and whose next state both accept begins an Apriori-safe candidate: each block
counts its candidates, and the counts are summed over blocks. All pairs of
frequent words would be quadratic, so the candidates of a level are found in the
texts, not listed beforehand.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from roadframe.llm.common import ordered, read_table, ship_package, stored
from roadframe.llm.tries import DoubleArray
from roadframe.llm.words import release, slices

SUPPORT = 30
LONGEST = 4
#: a phrase is covered by a longer one with this percentage of its places
COVER = 80
TOP = 2000
#: sizes of one broadcast trie: bytes of words, number of phrases. More of
#: them are dealt to further tries by a hash, so each is asked in one trie only.
TRIE_BYTES = 1 << 22
TRIE_PHRASES = 1 << 19
#: factor and prime of the hash that deals phrases
DEAL = (1_103_515_245, (1 << 31) - 1)
#: bytes of text cut into words at once, and for which all tries are opened once
SLICE = 2 << 20
WALK_BYTES = 1 << 24
#: word numbers in a stored row (10,000 of them travel to a worker at once), in a block that is
#: counted at once and for which all tries are opened once, and candidates sent at once
ROW_IDS = 1 << 7
BLOCK_IDS = 1 << 20
SENT = 1 << 17
#: bits of a word's number in a candidate's code, below those of its prefix
WORD_BITS = 31
SALTS = 32
#: separators of words, and of pieces (fixed values)
BLANKS = b" \t"
BREAKS = b".,;:!?\n\x0b\x0c\r"

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_KIND = np.zeros(256, np.uint8)
_KIND[list(BLANKS)], _KIND[list(BREAKS)] = 1, 2


class PieceWords:
    """Words of texts: ``code`` into the byte strings ``data``/``offsets``,
    the ``row`` of each, and ``joined``: it follows the word before it in the
    same piece. Null texts have none."""

    def __init__(self, texts: pa.Array):
        filled = pc.fill_null(texts.cast(pa.large_string()), "")
        ends = np.frombuffer(filled.buffers()[1], np.int64, len(filled) + 1, filled.offset * 8)
        raw = filled.buffers()[2]
        whole = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
        data = whole[ends[0]:ends[-1]]
        ends = ends - ends[0]
        kind = _KIND[data]
        inside = kind == 0
        opens = np.zeros(len(data), bool)
        opens[ends[:-1][np.diff(ends) > 0]] = True
        start = inside.copy()
        start[1:] &= ~inside[:-1] | opens[1:]
        at = np.flatnonzero(start)
        piece = np.cumsum((kind == 2) | opens, dtype=np.int32)[at]
        before = (np.cumsum(inside, dtype=np.int32) - 1)[at]
        kept = _LOWER[data[inside]]
        bounds = np.concatenate((before, [len(kept)])).astype(np.int64)
        words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(bounds), pa.py_buffer(kept)])
        encoded = words.dictionary_encode()
        self.unique = encoded.dictionary
        self.code = encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        self.row = np.searchsorted(ends, at, side="right") - 1
        self.joined = np.zeros(len(at), bool)
        self.joined[1:] = piece[1:] == piece[:-1]


def binary_parts(words: pa.LargeBinaryArray) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and data of byte strings."""
    n = len(words)
    if not n:
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    raw = words.buffers()[2]
    return (np.frombuffer(words.buffers()[1], np.int64, n + 1, words.offset * 8),
            np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8))


def _by_language(batch: pa.RecordBatch) -> tuple[list[str], np.ndarray]:
    encoded = batch.column(0).dictionary_encode()
    return encoded.dictionary.to_pylist(), encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64)


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, word, n) of every slice; the row of a null word counts them all."""
    for whole in batches:
        for batch in slices(whole, 1, most_rows=20000, most_bytes=SLICE):
            words = PieceWords(batch.column(1))
            langs, lang = _by_language(batch)
            mine = lang[words.row]
            span = len(words.unique) + 1
            codes, n = np.unique(mine * span + words.code, return_counts=True)
            all_n = np.bincount(mine, minlength=len(langs))
            place = pa.array(np.concatenate((codes // span, np.arange(len(langs)))))
            text = pa.concat_arrays([words.unique.take(pa.array(codes % span)).cast(pa.large_string()),
                                     pa.nulls(len(langs), pa.large_string())]).cast(pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()).take(place), text,
                                              pa.array(np.concatenate((n, all_n)).astype(np.int64))],
                                             names=["lang", "word", "n"])
        release()


def _opened(tries: list) -> Iterator[DoubleArray]:
    """The broadcast tries in turn; of several, a worker keeps none but the current."""
    for held in tries:
        path = getattr(held, "_path", None) if len(tries) > 1 else None  # none under encryption
        yield held.load_from_path(path) if path else held.value


class _Slice:
    """A slice of texts for the encoder: its distinct words by language, and
    the ``place`` of every word among them."""

    def __init__(self, batch: pa.RecordBatch):
        words = PieceWords(batch.column(1))
        langs, lang = _by_language(batch)
        self.joined, self.unique = words.joined, words.unique
        span = len(words.unique) + 1
        pairs = pa.array(lang[words.row] * span + words.code).dictionary_encode()
        self.place = pairs.indices.to_numpy(zero_copy_only=False)
        keys = pairs.dictionary.to_numpy(zero_copy_only=False)
        order = np.argsort(keys // span, kind="stable")
        cuts = np.searchsorted(keys[order] // span, np.arange(len(langs) + 1))
        #: (language and zero byte, places, codes)
        self.asked = [(name.encode() + b"\0", order[i:j], keys[order[i:j]] % span)
                      for name, i, j in zip(langs, cuts, cuts[1:]) if i < j]
        self.number = np.zeros(len(keys), np.int32)

    def spelled(self, codes: np.ndarray) -> pa.LargeBinaryArray:
        return self.unique.take(pa.array(codes))


def _slice_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[list[_Slice]]:
    """Slices of about WALK_BYTES of text together."""
    group, held = [], 0
    for whole in batches:
        for batch in slices(whole, 1, most_rows=20000, most_bytes=SLICE):
            group.append(_Slice(batch))
            held += pc.sum(pc.binary_length(batch.column(1))).as_py() or 0
            if held >= WALK_BYTES:
                yield group
                group, held = [], 0
        release()
    if group:
        yield group


def _encoder(tries: list):
    """Write known words as numbers from 1; 0 stands between pieces and for
    other words. A word is looked up in the one trie it is dealt to, once for
    each slice and language."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _slice_groups(batches):
            asked = []
            for part in group:
                for start, places, codes in part.asked:
                    shard = np.zeros(len(codes), np.int64)
                    if len(tries) > 1:
                        seed = zlib.crc32(start)
                        shard = np.array([zlib.crc32(w, seed) for w in part.spelled(codes).to_pylist()], np.int64) % len(tries)
                    asked.append((part, start, places, codes, shard))
            for k, trie in enumerate(_opened(tries)):
                for part, start, places, codes, shard in asked:
                    state, mine = trie.state(start), shard == k
                    if state >= 0 and mine.any():
                        part.number[places[mine]] = trie.look_up(*binary_parts(part.spelled(codes[mine])), state) + 1
            for part in group:
                yield pa.RecordBatch.from_arrays([_rows(_runs(part.number[part.place], part.joined))], names=["ids"])
            release()

    return encode


def _runs(number: np.ndarray, joined: np.ndarray) -> np.ndarray:
    """Numbers with one 0 before each word that follows no known word in its
    piece; words that neither follow nor precede one are left out."""
    known = number > 0
    after = np.zeros(len(number), bool)
    after[1:] = joined[1:] & known[1:] & known[:-1]
    before = np.zeros(len(number), bool)
    before[:-1] = after[1:]
    keep = known & (after | before)
    values, first = number[keep], ~after[keep]
    out = np.zeros(len(values) + int(first.sum()) + 1, np.int32)
    out[np.arange(len(values)) + np.cumsum(first)] = values
    return out


def _rows(values: np.ndarray) -> pa.ListArray:
    """Lists of about ROW_IDS numbers, cut before a 0."""
    zeros = np.flatnonzero(values == 0)
    wanted = np.arange(ROW_IDS, len(values), ROW_IDS)
    at = np.searchsorted(zeros, wanted)
    cuts = np.unique(zeros[at[at < len(zeros)]])
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], cuts, [len(values)])).astype(np.int32)), pa.array(values))


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    """The numbers of whole rows together, about BLOCK_IDS at a time."""
    group, held = [], 0
    for batch in batches:
        sizes = np.cumsum(pc.list_value_length(batch.column(0)).to_numpy())
        start = 0
        while start < len(sizes):
            done = sizes[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(sizes, done + BLOCK_IDS - held, side="right")))
            group.append(batch.column(0).slice(start, end - start).flatten().to_numpy(zero_copy_only=False))
            start, held = end, held + len(group[-1])
            if held >= BLOCK_IDS or start < len(sizes):
                yield np.concatenate(group)
                group, held = [], 0
        release()
    if group:
        yield np.concatenate(group)


def dealt(words: Sequence, shards: int):
    """The trie, of ``shards``, that a phrase of these word numbers (64 bits) is
    dealt to: the same of arrays and of Spark's columns."""
    place = 0
    for word in words:
        place = (place * DEAL[0] + word) % DEAL[1]
    return place % shards


def digits(words: np.ndarray, width: int) -> list[np.ndarray]:
    """The low ``width`` bytes of word numbers, high first."""
    return [(words >> shift) & 255 for shift in range(8 * (width - 1), -1, -8)]


def advance(tries: list, ids: np.ndarray, size: int, width: int) -> np.ndarray:
    """Number of the phrase of ``size`` words that begins at each place, 0 if
    no trie has one. Every place is walked in the one trie it is dealt to."""
    places = len(ids) - size + 1
    out = np.zeros(len(ids), np.int64)
    if places <= 0:
        return out
    words = [ids[k:k + places] for k in range(size)]
    full = np.flatnonzero(np.logical_and.reduce([w > 0 for w in words]))
    if len(tries) > 1:
        shard = dealt([w[full].astype(np.int64) for w in words], len(tries))
        full = full[np.argsort(shard, kind="stable")]
        ends = np.cumsum(np.bincount(shard, minlength=len(tries)))
    else:
        ends = [len(full)]
    first = 0
    for trie, end in zip(_opened(tries), ends):
        here, first = full[first:end], end
        states = trie.walk([d for w in words for d in digits(w[here], width)])
        found = np.flatnonzero(states >= 0)
        out[here[found]] = trie.value[states[found]] + 1
    return out


def _extender(tries: list, size: int, width: int):
    """(code, n): candidates of ``size`` words, counted per block; the code
    holds the number of the phrase without its last word, and that word's."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids in _blocks(batches):
            states = ids.astype(np.int64) if size == 2 else advance(tries, ids, size - 1, width)
            safe = np.flatnonzero((states[:-1] > 0) & (states[1:] > 0))
            codes, n = np.unique((states[safe] << WORD_BITS) | ids[safe + size - 1], return_counts=True)
            for k in range(0, len(codes), SENT):
                yield pa.RecordBatch.from_arrays([pa.array(codes[k:k + SENT]), pa.array(n[k:k + SENT].astype(np.int64))],
                                                 names=["code", "n"])

    return count


def _word_trie(vocabulary: DataFrame, shard: int) -> DoubleArray:
    """Keys are language, a zero byte and the word; about TRIE_BYTES."""
    part = vocabulary.where(F.col("shard") == shard).select(_key().alias("key"), "id").toArrow()
    keys = pa.concat_arrays([pa.array([], pa.large_binary()), *part.column("key").cast(pa.large_binary()).chunks])
    return DoubleArray(*binary_parts(keys), part.column("id").to_numpy() - 1)


def _phrase_trie(phrases: DataFrame, shard: int, size: int, width: int) -> DoubleArray:
    """Keys are the bytes of the words' numbers; about TRIE_PHRASES."""
    part = phrases.where(F.col("shard") == shard).select(
        *(F.element_at("words", k + 1).alias(f"w{k}") for k in range(size)), "id").toArrow()
    words = [part.column(k).to_numpy() for k in range(size)]
    data = np.stack([d for w in words for d in digits(w, width)], axis=1).astype(np.uint8).ravel()
    offsets = np.arange(len(part) + 1, dtype=np.int64) * (size * width)
    return DoubleArray(offsets, data, part.column("id").to_numpy() - 1)


def _key() -> Column:
    return F.concat(F.encode("lang", "utf-8"), F.lit(b"\0"), F.encode("word", "utf-8"))


def _shards(df: DataFrame) -> int:
    return int(df.agg(F.coalesce(F.max("shard") + 1, F.lit(0))).first()[0])


def count_words(docs: DataFrame, support: int) -> tuple[DataFrame, DataFrame]:
    """Frequent words (id from 1, lang, word, n, shard) and the words of every
    language (lang, total)."""
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), "text")
    counts = texts.mapInArrow(_word_counts, "lang string, word string, n long").groupBy("lang", "word").agg(
        F.sum("n").alias("n"))
    counts = stored(counts.where((F.col("n") >= support) | F.col("word").isNull()), "phrase-words")
    frequent = counts.where(F.col("word").isNotNull())
    size = frequent.agg(F.sum(F.octet_length("lang") + F.octet_length("word") + 1)).first()[0] or 0
    shards = max(1, -(-size // TRIE_BYTES))
    numbered = ordered(frequent, [F.desc("n"), F.col("lang"), F.col("word")], "phrase-vocabulary")
    vocabulary = numbered.select((F.col("rank") + 1).alias("id"), "lang", "word", "n",
                                 (F.crc32(_key()) % shards).cast("int").alias("shard"))
    return (stored(vocabulary, "phrase-numbers", by=["shard"]),
            counts.where("word is null").select("lang", F.col("n").alias("total")))


def encode(docs: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """Blocks (ids): the texts' frequent words as numbers, stored."""
    spark = docs.sparkSession
    shards = _shards(vocabulary)
    if not shards:
        return spark.createDataFrame([], "ids array<int>")
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), "text")
    # bound of one: about TRIE_BYTES edges
    tries = [spark.sparkContext.broadcast(_word_trie(vocabulary, shard)) for shard in range(shards)]
    blocks = stored(texts.mapInArrow(_encoder(tries), "ids array<int>"), "phrase-ids")
    for held in tries:
        held.destroy()
    return blocks


def extend(blocks: DataFrame, shorter: DataFrame, size: int, support: int, width: int) -> DataFrame:
    """Frequent phrases of ``size`` words: (id, words, lang, n, shard), from
    those of one word less; a word's number has ``width`` bytes."""
    spark = blocks.sparkSession
    # bound of one: about TRIE_PHRASES keys
    tries = [spark.sparkContext.broadcast(_phrase_trie(shorter, shard, size - 1, width))
             for shard in range(_shards(shorter) if size > 2 else 0)]
    schema = "code long, n long"
    if size > 2 and not tries:
        counted = spark.createDataFrame([], schema)
    else:
        counted = blocks.mapInArrow(_extender(tries, size, width), schema)
    frequent = counted.groupBy("code").agg(F.sum("n").alias("n")).where(F.col("n") >= support)
    numbered = ordered(frequent, [F.col("code")], f"phrase-level-{size}").withColumns({
        "prefix": F.shiftright("code", WORD_BITS),
        "word": F.col("code").bitwiseAND(F.lit((1 << WORD_BITS) - 1)).cast("int")})
    shards = max(1, -(-numbered.count() // TRIE_PHRASES))
    prefixes = shorter.select(F.col("id").alias("prefix"), "lang", F.col("words").alias("_before"))
    out = numbered.join(prefixes, "prefix").select(
        (F.col("rank") + 1).alias("id"), F.concat("_before", F.array("word")).alias("words"), "lang", "n")
    out = out.withColumn("shard", dealt([F.element_at("words", k + 1).cast("long") for k in range(size)],
                                        shards).cast("int"))
    out = stored(out, f"phrase-{size}", by=["shard"])
    for held in tries:
        held.destroy()
    return out


def mine(docs: DataFrame, support: int = SUPPORT, longest: int = LONGEST,
         cover: int = COVER) -> tuple[DataFrame, DataFrame]:
    """Frequent phrases that no longer one covers, and the words of every language.

    ``docs`` has ``lang`` and ``text``; other columns are ignored. Null texts
    are empty, a null language is ``und``, repeated rows count each time; an
    empty table gives no phrase. Phrases: ``lang, phrase`` (space-joined),
    ``words`` (count of them), ``a, l, r, score`` of the lowest-scoring cut
    and ``cut`` (its words before the cut).
    """
    ship_package(docs.sparkSession)
    vocabulary, totals = count_words(docs, support)
    blocks = encode(docs, vocabulary)
    level = vocabulary.select("id", F.array(F.col("id").cast("int")).alias("words"), "lang", "n", "shard")
    levels = [level]
    known = vocabulary.agg(F.coalesce(F.max("id"), F.lit(0))).first()[0]
    width = max(1, (int(known).bit_length() + 7) // 8)
    for size in range(2, longest + 1):
        level = extend(blocks, level, size, support, width)
        levels.append(level)
    every = levels[0].select("words", "n")
    for level in levels[1:]:
        every = every.unionByName(level.select("words", "n"))
    candidates = levels[1].select("lang", "words", "n")
    for level in levels[2:]:
        candidates = candidates.unionByName(level.select("lang", "words", "n"))
    size = F.size("words")
    # exact: products of counts pass 64 bits
    wide = lambda c: c.cast("decimal(28,0)")
    cuts = candidates.select("lang", "words", F.col("n").alias("a"), F.explode(F.sequence(F.lit(1), size - 1)).alias("cut"))
    cuts = cuts.select("*", F.slice("words", F.lit(1), F.col("cut")).alias("_first"),
                       F.slice("words", F.col("cut") + 1, size - F.col("cut")).alias("_rest"))
    cuts = cuts.join(every.select(F.col("words").alias("_first"), F.col("n").alias("l")), "_first")
    cuts = cuts.join(every.select(F.col("words").alias("_rest"), F.col("n").alias("r")), "_rest")
    score = F.floor(wide(F.col("a")) * 2000000 / wide(F.col("l") + F.col("r")))
    # the quotient of decimals is rounded at some digit; the remainder is exact
    exact = F.when(wide(score) * wide(F.col("l") + F.col("r")) > wide(F.col("a")) * 2000000, score - 1).otherwise(score)
    best = cuts.withColumn("score", exact.cast("long")).groupBy("lang", "words", "a").agg(
        F.min(F.struct("score", "cut", "l", "r")).alias("_best")).select("lang", "words", "a", "_best.*")
    longer = candidates.where(size > 2).select(F.col("n").alias("_longer"), F.explode(F.flatten(F.transform(
        F.sequence(F.lit(2), size - 1), lambda k: F.transform(
            F.sequence(F.lit(1), size - k + 1), lambda i: F.slice("words", i, k))))).alias("words"))
    longer = longer.groupBy("words").agg(F.max("_longer").alias("_longer"))
    kept = best.join(longer, "words", "left").where(
        F.col("_longer").isNull() | (wide(F.col("_longer")) * 100 < wide(F.col("a")) * cover)).drop("_longer")
    spelled = kept.select("words", F.posexplode("words").alias("_at", "id")).join(
        vocabulary.select(F.col("id").cast("int").alias("id"), "word"), "id")
    spelled = spelled.groupBy("words").agg(F.sort_array(F.collect_list(F.struct("_at", "word"))).alias("_text"))  # at most `longest`
    out = kept.join(spelled, "words").select(
        "lang", F.array_join(F.transform("_text", lambda w: w["word"]), " ").alias("phrase"), size.alias("words"),
        "a", "l", "r", "score", "cut")
    return out, totals


def top(phrases: DataFrame, most: int = TOP) -> DataFrame:
    """Each language's first phrases with ``rank`` from 1, by score, count
    and UTF-8 bytes. Salted parts are ranked first, so that no task gets a
    whole language."""
    by = [F.desc("score"), F.desc("a"), F.col("phrase")]
    salted = phrases.withColumn("_salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    salted = salted.withColumn("_place", F.row_number().over(Window.partitionBy("lang", "_salt").orderBy(*by)))
    first = salted.where(F.col("_place") <= most)
    return first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*by))).where(
        F.col("rank") <= most).drop("_salt", "_place")


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first ``TOP`` phrases of every language; see ``mine``."""
    phrases, totals = mine(read_table(spark, sf_dir, "documents").select("lang", "text"))
    return top(phrases).join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", F.col("total").alias("n"), "score",
        F.col("cut").cast("long").alias("cut"))


def oracle_sql(support: int = SUPPORT, longest: int = LONGEST, cover: int = COVER, most: int = TOP) -> str:
    """DuckDB SQL of the query: all word runs listed and counted."""
    grams = " UNION ALL ".join(
        f"SELECT lang, {k} AS size, array_to_string(unnest(list_transform(range(1, len(words) - {k - 2}), "
        f"lambda i: words[i:i + {k - 1}])), ' ') AS p FROM w WHERE len(words) >= {k}" for k in range(1, longest + 1))
    parts = " UNION ALL ".join(
        f"SELECT lang, size, p, a, {k} AS cut, array_to_string(s[1:{k}], ' ') AS p1, "
        f"array_to_string(s[{k + 1}:], ' ') AS p2 FROM c WHERE size > {k}" for k in range(1, longest))
    inner = " UNION ALL ".join(
        f"SELECT lang, array_to_string(unnest(list_transform(range(1, size - {k - 2}), lambda i: s[i:i + {k - 1}])), ' ') AS p, "
        f"a FROM c WHERE size > {k}" for k in range(2, longest))
    return (
        "WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), "
        "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents), "
        "w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS words FROM pieces), "
        "t AS (SELECT lang, CAST(sum(len(words)) AS BIGINT) AS n FROM w GROUP BY lang), "
        f"g AS ({grams}), "
        f"f AS (SELECT lang, size, p, count(*) AS a FROM g GROUP BY ALL HAVING count(*) >= {support}), "
        "c AS (SELECT *, string_split(p, ' ') AS s FROM f WHERE size > 1), "
        f"k AS ({parts}), "
        "sc AS (SELECT k.*, x.a AS l, y.a AS r, CAST(CAST(2000000 AS HUGEINT) * k.a // (x.a + y.a) AS BIGINT) AS score "
        "FROM k JOIN f x ON x.lang = k.lang AND x.p = k.p1 JOIN f y ON y.lang = k.lang AND y.p = k.p2), "
        "b AS (SELECT * FROM sc QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, cut) = 1), "
        f"i AS (SELECT lang, p, max(a) AS longer FROM ({inner}) GROUP BY ALL), "
        "o AS (SELECT b.* FROM b LEFT JOIN i ON i.lang = b.lang AND i.p = b.p WHERE i.longer IS NULL "
        f"OR CAST(100 AS HUGEINT) * i.longer < CAST({cover} AS HUGEINT) * b.a), "
        "q AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, p) AS rank FROM o) "
        "SELECT q.lang, q.rank, q.p AS phrase, q.a, q.l, q.r, t.n, q.score, CAST(q.cut AS BIGINT) AS cut "
        f"FROM q JOIN t ON t.lang = q.lang WHERE q.rank <= {most}")
