"""License scan: an exact set-similarity join of text blocks with license
templates, beside an exact phrase scan. Only DataFrame functions are used.

A text meets a template if some window of it, a run of as many words as
``window`` gives for the template, holds at least ``THRESHOLD`` of the
template's distinct words, among them all that are in ``TELLING``. Line ends are separators like any other, so wrapped
texts are met too. Texts are cut into overlapping blocks that hold every
window whole. Words are ordered by how often the corpus has them, rarest
first. If a window of a block meets a template, the first words of both in
that order (their prefixes) share a word, the block has enough of the
templates' words (length filter), and from the shared word on enough words are
left in both (position filter). In pairs that pass every window is counted.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadframe.llm.common import read_table, stored

THRESHOLD = 0.8
#: words of a window, as a multiple of the template's words, and at least
SPREAD, LEAST_WINDOW = 2, 16
#: words that tell licenses of like wording apart: where a template has some, a window must hold all of them
TELLING = frozenset("apache attribution gnu mit mozilla nc noncommercial sharealike unencumbered".split())
#: a family's name that a word of the others follows names one of them: 'attribution
#: noncommercial' is no plain 'attribution', which templates without such a word ask for
FAMILY = ("attribution",)
OTHERS = ("nc", "nd", "noderivatives", "noderivs", "noncommercial", "sa", "sharealike")
#: a word is a run of characters other than these (after lower-casing A-Z)
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# The phrases of the base scan and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

#: (label, text): wording by which a license makes itself known
TEMPLATES = [
    ("apache", "licensed under the apache license version 2 0"),
    ("apache", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided "
            "that the following conditions are met"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-nc", "creative commons attribution noncommercial 4 0 international license"),
    ("cc-by-sa", "creative commons attribution sharealike 4 0 international license"),
    ("gpl", "licensed under the gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu "
            "general public license as published by the free software foundation"),
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and "
            "associated documentation files to deal in the software without restriction"),
    ("apache", "unless required by applicable law or agreed to in writing software distributed under the license is distributed "
               "on an as is basis without warranties or conditions of any kind either express or implied"),
    ("bsd", "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
            "products derived from this software without specific prior written permission"),
    ("gpl", "you should have received a copy of the gnu general public license along with this program"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("mit", "the above copyright notice and this permission notice shall be included in all copies or substantial portions "
            "of the software"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
]


def window(template: str) -> int:
    """Words of a text among which a template's words have to stand."""
    return max(LEAST_WINDOW, SPREAD * len(template.split(" ")))


def lowered(text: Column) -> Column:
    """A-Z in lower case, nothing else changed; null is empty."""
    return F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(low: Column) -> Column:
    return F.array_remove(F.split(low, SEPARATORS), "")


def marked(words: Column) -> Column:
    """The words, family names that stand for another license with a plus sign."""
    followed = lambda i: F.coalesce(F.get(words, i + 1).isin(*OTHERS), F.lit(False))
    told = F.transform(words, lambda w, i: F.when(w.isin(*FAMILY) & followed(i), F.concat(w, F.lit("+"))).otherwise(w))
    return F.when(F.arrays_overlap(words, _strings(OTHERS)), told).otherwise(words)


def unmarked(words: Column) -> Column:
    return F.transform(words, lambda w: F.when(w.isin(*(f + "+" for f in FAMILY)), F.regexp_replace(w, "[+]", "")).otherwise(w))


def plain(text: str) -> bool:
    """Whether a template has a family's name by itself."""
    words = text.split(" ")
    return any(w in FAMILY and not (words[i + 1:i + 2] and words[i + 1] in OTHERS) for i, w in enumerate(words))


def _strings(values: Sequence[str]) -> Column:
    return F.array(*(F.lit(v) for v in values)) if values else F.array().cast("array<string>")


def _places(words: Column, phrase: str) -> Column:
    """Starts of a phrase among the words, ascending."""
    parts = phrase.split(" ")

    def starts(i: Column) -> Column:
        match = F.get(words, i) == parts[0]
        for k, part in enumerate(parts[1:], 1):
            match = match & (F.get(words, i + k) == part)
        return F.coalesce(match, F.lit(False))

    none = F.array().cast("array<int>")
    # the rarest part decides whether the words are looked through at all
    return F.when(F.array_contains(words, parts[0]) & F.array_contains(words, parts[-1]),
                  F.filter(F.sequence(F.lit(0), F.size(words) - 1), starts)).otherwise(none)


def word_frequencies(docs: DataFrame, vocabulary: Sequence[str]) -> dict[str, int]:
    """How often the whole corpus has each word of a fixed vocabulary."""
    found = docs.select(F.explode(words_of(lowered(F.col("text")))).alias("word"))
    counts = dict.fromkeys(vocabulary, 0)
    rows = found.where(F.col("word").isin(list(vocabulary))).groupBy("word").count().collect()  # at most the vocabulary
    return counts | {r["word"]: r["count"] for r in rows}


def scan(docs: DataFrame, phrases: Mapping[str, str] = PHRASES, templates: Sequence[tuple[str, str]] = TEMPLATES,
         threshold: float = THRESHOLD) -> DataFrame:
    """One row per document row: ``doc_id, n_words, n_base, first_word,
    last_word, base_labels, labels, score``.

    The base columns count and place the phrases; ``labels`` adds those of the
    templates that some window meets. ``score`` is 1 where a phrase stands,
    else the best share of a met template's words, else 0. Null and empty
    texts have no words and empty labels; ``first_word`` and ``last_word`` are
    null without a phrase; repeated rows and null ids are rows like any other;
    other columns are ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    sets = [(label, sorted(set(text.split(" "))), window(text), plain(text)) for label, text in templates]
    widest = max((width for _, _, width, _ in sets), default=LEAST_WINDOW)
    vocabulary = sorted({w for _, words, _, _ in sets for w in words})
    frequency = word_frequencies(docs, vocabulary)
    order = sorted(vocabulary, key=lambda w: (frequency[w], w))
    place = {w: i for i, w in enumerate(order)}
    prefixes, first_words = [], set()
    for number, (_, words, _, _) in enumerate(sets):
        need = math.ceil(threshold * len(words) - 1e-9)
        by_order = sorted(words, key=place.get)
        for at, word in enumerate(by_order[:len(words) - need + 1]):
            prefixes.append((word, number, at, len(words), need, [w for w in words if w in TELLING]))
            first_words.add(word)

    low = docs.select("doc_id", lowered(F.col("text")).alias("low")).withColumn("words", words_of(F.col("low")))
    low = low.withColumn("marked", marked(F.col("words")))
    found = low.withColumns({f"p{i}": _places(F.col("words"), phrase) for i, phrase in enumerate(phrases)})
    rare = _strings(sorted(first_words | {w + "+" for w in FAMILY if w in first_words}))
    # a window that starts in the first half of a block ends in it; blocks
    # that hold no prefix word of any template meet none
    starts = F.sequence(F.lit(0), F.greatest(F.size("words") - 1, F.lit(0)), F.lit(widest))
    blocks = F.when(F.arrays_overlap("marked", rare), F.filter(
        F.transform(starts, lambda i: F.slice("marked", i + 1, 2 * widest - 1)), lambda block: F.arrays_overlap(block, rare)))
    all_places = F.flatten(F.array(*(F.col(f"p{i}") for i in range(len(phrases)))))
    base = F.array_compact(F.array(*(
        F.when(F.size(f"p{i}") > 0, F.lit(label)) for i, label in enumerate(phrases.values()))))
    rows = stored(found.select(
        "doc_id", F.size("words").cast("long").alias("n_words"), F.size(all_places).cast("long").alias("n_base"),
        F.array_min(all_places).cast("long").alias("first_word"), F.array_max(all_places).cast("long").alias("last_word"),
        F.array_sort(F.array_distinct(base)).alias("base"), blocks.alias("blocks"),
        F.monotonically_increasing_id().alias("row")), "license-rows")

    # bounds: the prefixes and sizes of the given templates
    prefix = F.broadcast(spark.createDataFrame(prefixes, "word string, template int, at int, size int, need int, telling array<string>"))
    texts = F.broadcast(spark.createDataFrame(
        [(i, *found) for i, found in enumerate(sets)],
        "template int, label string, content array<string>, width int, plain boolean"))
    block = rows.select("row", F.posexplode("blocks").alias("block", "run"))
    # in the order of the first array: rarest words first
    block = block.withColumn("held", F.array_intersect(_strings(order), unmarked(F.col("run"))))
    heads = block.select("*", F.posexplode("held").alias("j", "word"))
    held = F.size("held")
    pairs = heads.join(prefix, "word").where(
        (held >= F.col("need")) & (F.col("j") <= held - F.col("need"))
        & (F.least(F.col("size") - F.col("at"), held - F.col("j")) >= F.col("need"))
        & (F.size(F.array_except("telling", "held")) == 0))
    pairs = pairs.select("row", "block", "run", "template", "size", "need", "telling").dropDuplicates(["row", "block", "template"])
    # it is enough to look at the windows that start with a word of the template
    begins = F.filter(F.sequence(F.lit(0), F.least(F.size("run"), F.lit(widest)) - 1),
                      lambda i: F.array_contains(F.col("content"), F.get("run", i)))
    inside = F.transform(begins, lambda i: F.array_intersect("content", F.slice("run", i + 1, F.col("width"))))
    inside = F.filter(inside, lambda found: F.size(F.array_except("telling", found)) == 0)
    common = F.array_max(F.transform(inside, F.size))
    met = pairs.join(texts, "template").withColumn(
        "run", F.when(F.col("plain"), F.col("run")).otherwise(unmarked(F.col("run")))).withColumn("common", common).where(F.col("common") >= F.col("need"))
    met = met.groupBy("row").agg(F.collect_set("label").alias("more"), F.max(F.col("common") / F.col("size")).alias("share"))

    out = rows.drop("blocks").join(met, "row", "left")
    labels = F.array_sort(F.array_union("base", F.coalesce("more", F.array().cast("array<string>"))))
    return out.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base", ",").alias("base_labels"),
        F.array_join(labels, ",").alias("labels"),
        F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce("share", F.lit(0.0))).alias("score"))


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License labels of all ``documents``; see ``scan``."""
    return scan(read_table(spark, sf_dir, "documents"))


def _quoted(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def oracle_sql(threshold: float = THRESHOLD) -> str:
    """The scan in DuckDB SQL: phrases by place, and every window of every text
    against every template by plain set intersection, without filters but that
    the whole text holds enough of the template's words."""
    words = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
    places = []
    for phrase, label in PHRASES.items():
        match = " AND ".join(f"words[i + {k}] = {_quoted(w)}" for k, w in enumerate(phrase.split(" ")))
        places.append(f"SELECT r, {_quoted(label)} AS label, unnest(list_filter(range(1, len(words) + 1), lambda i: {match})) AS spot FROM w")
    listed = lambda found: "CAST([" + ", ".join(map(_quoted, found)) + "] AS VARCHAR[])"
    templates = ", ".join(
        f"({_quoted(label)}, {listed(sorted(set(text.split(' '))))}, {window(text)}, "
        f"{listed(sorted(set(text.split(' ')) & TELLING))}, {plain(text)})" for label, text in TEMPLATES)
    family, others = (", ".join(map(_quoted, found)) for found in (FAMILY, OTHERS))
    return f"""WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low FROM documents
), w AS MATERIALIZED (SELECT r, doc_id, regexp_extract_all(low, {words}) AS words FROM d
), p AS ({" UNION ALL ".join(places)}
), b AS (
  SELECT r, count(*) AS n_base, min(spot) - 1 AS first_word, max(spot) - 1 AS last_word,
    list_sort(list_distinct(list(label))) AS base FROM p GROUP BY r
), k AS (
  SELECT r, words AS whole, list_transform(range(1, len(words) + 1), lambda i:
    CASE WHEN words[i] IN ({family}) AND words[i + 1] IN ({others}) THEN words[i] || '+' ELSE words[i] END) AS told FROM w
), c AS (
  SELECT r, label, content, telling, width, CASE WHEN plain THEN told ELSE whole END AS words
  FROM k CROSS JOIN (VALUES {templates}) t(label, content, width, telling, plain)
  WHERE len(list_intersect(list_distinct(whole), content)) >= ceil({threshold} * len(content) - 1e-9)
), runs AS (
  SELECT r, label, content, telling, unnest(list_transform(list_filter(range(1, len(words) + 1),
    lambda i: list_contains(content, words[i])), lambda i: list_distinct(words[i:i + width - 1]))) AS run FROM c
), m AS (
  SELECT r, list_distinct(list(label)) AS more, max(common / len(content)) AS share FROM (
    SELECT r, label, content, len(list_intersect(run, content)) AS common FROM runs
    WHERE len(list_intersect(run, telling)) = len(telling))
  WHERE common >= ceil({threshold} * len(content) - 1e-9) GROUP BY r
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
  coalesce(array_to_string(base, ','), '') AS base_labels,
  coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(base, []), coalesce(more, [])))), ','), '') AS labels,
  CASE WHEN n_base > 0 THEN 1.0 ELSE coalesce(share, 0.0) END::DOUBLE AS score
FROM w LEFT JOIN b USING (r) LEFT JOIN m USING (r)"""
