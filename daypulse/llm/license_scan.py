"""License notices: fixed phrases, and an exact set-similarity join of text
blocks with license templates.

A block is a line, or a sentence of a line, or a sentence that runs on over line
ends, whatever the lines' lengths; a line without a word ends it, so no block
goes over a paragraph's end. Its set is that of its words. A template is found
in a block if the block holds at least ``threshold`` of the template's distinct
words; in a sentence over line ends they must stand within a stretch of
``SPREAD`` times as many words as the template has, so that a word far off does
not complete a notice. The join orders the templates' words by how often
they occur in all documents, rarest first. A block that reaches the threshold
for a template of n words, needing k of them, must hold one of its n - k + 1
rarest (prefix filter), must have k words (length filter), and, with its first
such word at place p of the template and place q among the block's template
words, must have enough words left behind both places (positional filter). What
passes is counted exactly. All of it is DataFrame code; the index has a row for
each prefix word of a template, so it is broadcast.

Defined results: a null or empty text has no words, no labels and score 0; a
phrase that begins inside an earlier match of itself counts as a place of its
own; a text of any length is taken whole; of equal words the one first in the
alphabet counts as rarer; repeated rows keep a row each; an empty table gives an
empty table; other columns are ignored.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daypulse.llm.storage import materialise

PHRASES = {"mit": "under the mit license", "apache-2": "apache license version 2", "cc-by-nc": "cc by nc"}
# The notices that licenses ask for, as words.
TEMPLATES = [
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
            "documentation files to deal in the software without restriction"),
    ("apache-2", "licensed under the apache license version 2 0"),
    ("gpl-3", "this work is licensed under the gnu general public license version 3"),
    ("gpl-3", "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
              "public license as published by the free software foundation either version 3 of the license"),
    ("bsd-3", "redistribution and use in source and binary forms with or without modification are permitted provided that "
              "the following conditions are met"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
]
THRESHOLD = 0.8
#: Words of a sentence over line ends, for each distinct word of a template, that the template's words must stand within.
SPREAD = 3
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD, WORD_ANY_CASE = r"[0-9a-z\x{80}-\x{10FFFF}]+", r"[0-9A-Za-z\x{80}-\x{10FFFF}]+"
_LINE_END, _NO_WORD = r"(?>\r\n|\r|\n)", r"[^\r\n0-9A-Za-z\x{80}-\x{10FFFF}]"
_GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(f"({WORD})"), F.lit(1))


def blocks(text: Column) -> Column:
    """Lines and sentences within them, then the sentences over several lines."""
    lines = F.split(F.regexp_replace(text, r"([.!?])[ \t\r\n]+", "$1\n"), r"[\r\n]+")
    runs = F.split(text, rf"(?<=[.!?])[ \t\r\n]+|{_LINE_END}{_NO_WORD}*{_LINE_END}")
    return F.concat(lines, F.filter(runs, lambda b: b.rlike(r"[^\r\n][\r\n]+[^\r\n]")))


def _has_any(text: Column, vocabulary) -> Column:
    """Whether a text holds one of the words (ASCII) as a word."""
    return text.rlike(f"(?i)(?:^|{_GAP})(?:{'|'.join(sorted(vocabulary))})(?:$|{_GAP})")


def _phrase_places(text: Column, phrase: str, found: Column) -> Column:
    """Word indexes at which the phrase's words stand."""
    parts = phrase.split()
    return F.filter(F.sequence(F.lit(0), F.size(found) - 1), lambda i: F.slice(found, i + 1, len(parts)) == F.array(
        *map(F.lit, parts)))


def base(rows: DataFrame, phrases=PHRASES) -> DataFrame:
    """Adds n_words and places, a map of label to word indexes; only texts
    with a phrase are split into words for it."""
    text = F.col("text")
    some = text.rlike("(?i)" + "|".join(f"(?:^|{_GAP})" + f"{_GAP}+".join(p.split()) + f"(?:$|{_GAP})" for p in phrases.values()))
    rows = rows.withColumn("n_words", F.regexp_count(text, F.lit(WORD_ANY_CASE)).cast("long"))
    rows = rows.withColumn("found", F.when(some, words(text)))
    return rows.withColumn("places", F.when(F.size("found") > 0, F.create_map(*[
        x for label, p in phrases.items() for x in (F.lit(label), _phrase_places(text, p, F.col("found")))]))).drop("found")


def _together(text: Column, template: Column, need: Column) -> Column:
    """Whether a stretch of a text's words that begins with a template's word
    holds enough of them."""
    def held(found: Column) -> Column:  # the words, worked out once
        return F.exists(F.sequence(F.lit(1), F.size(found)), lambda i: F.array_contains(template, F.get(found, i - 1)) & (
            F.size(F.array_intersect(F.slice(found, i, SPREAD * F.size(template)), template)) >= need))

    return F.get(F.transform(F.array(text), held), F.lit(0))


def _rarest_first(rows: DataFrame, vocabulary: list[str]) -> list[str]:
    """The templates' words by how often they stand between spaces in all
    documents (then by the alphabet); one row for each comes to the driver."""
    every = rows.select(F.explode(F.split("text", " ")).alias("w")).select(F.lower("w").alias("w"))
    counts = {r["w"]: r["n"] for r in every.where(F.col("w").isin(vocabulary)).groupBy("w").agg(
        F.count(F.lit(1)).alias("n")).collect()}
    return sorted(vocabulary, key=lambda w: (counts.get(w, 0), w))


def similarity_join(rows: DataFrame, key: list[str], templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """(key, block, template, score): every block of ``text`` that holds at
    least ``threshold`` of a template's words."""
    spark = rows.sparkSession
    sets = [sorted(set(t.split())) for _, t in templates]
    order = _rarest_first(rows, sorted({w for s in sets for w in s}))
    rank = {w: n for n, w in enumerate(order)}
    need = [ceil(threshold * len(s) - 1e-9) for s in sets]
    ordered = [sorted(rank[w] for w in s) for s in sets]
    prefix = [(order[r], r, t, p) for t, s in enumerate(ordered) for p, r in enumerate(s[:len(s) - need[t] + 1])]
    index = spark.createDataFrame([(r, t, p, need[t], ordered[t], sets[t]) for _, r, t, p in prefix],
                                  "rank int, template int, p int, need int, ranks array<int>, words array<string>")
    ranks = F.create_map(*[F.lit(x) for w, n in rank.items() for x in (w, n)])
    hit = rows.where(_has_any(F.col("text"), {w for w, *_ in prefix}))
    split = hit.select(*key, F.posexplode(blocks(F.col("text"))).alias("block", "b")).where(
        _has_any(F.col("b"), {w for w, *_ in prefix}))
    own = F.array_sort(F.transform(F.filter(F.array_distinct(words(F.col("b"))), lambda w: w.isin(order)),
                                   lambda w: F.element_at(ranks, w)))
    over = F.when(F.col("b").rlike("[\r\n]"), F.col("b")).alias("over")
    split = split.select(*key, "block", over, own.alias("own")).where(F.size("own") >= min(need))  # length filter, for any template
    probes = split.select(*key, "block", "over", "own", F.posexplode("own").alias("q", "rank"))
    found = probes.join(F.broadcast(index), "rank")
    left = 1 + F.least(F.size("ranks") - F.col("p") - 1, F.size("own") - F.col("q") - 1)
    found = found.where((F.size("own") >= F.col("need")) & (left >= F.col("need")))
    first = F.element_at(F.array_intersect("ranks", "own"), 1) == F.col("rank")
    both = F.size(F.array_intersect("ranks", "own"))
    found = found.where(first & (both >= F.col("need")))
    return found.where(F.col("over").isNull() | _together(words(F.col("over")), F.col("words"), F.col("need"))).select(
        *key, "block", "template", (both / F.size("ranks")).alias("score"))


def scan(docs: DataFrame, id_col: str = "doc_id", text: str = "text", phrases=PHRASES, templates=TEMPLATES,
         threshold: float = THRESHOLD) -> DataFrame:
    """Per row: the id, n_words, n_base (places of phrases), first_word and
    last_word (their smallest and largest word index), base_labels, labels
    (both distinct, sorted, joined by commas) and score (0 to 1)."""
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))
    same = F.xxhash64("text", F.length("text"))  # rows with equal ids and texts have equal blocks
    names = F.array(*[F.lit(label) for label, _ in templates])
    found = similarity_join(rows.select("id", same.alias("same"), "text"), ["id", "same"], templates, threshold)
    found = materialise(found.groupBy("id", "same").agg(
        F.collect_set(F.element_at(names, F.col("template") + 1)).alias("more"), F.max("score").alias("best")), "license-blocks")
    out = base(rows.withColumn("same", same), phrases).drop("text")
    out = materialise(out, "license-phrases")
    found = found.select(F.col("id").alias("f_id"), F.col("same").alias("f_same"), "more", "best")
    out = out.join(found, F.col("id").eqNullSafe(F.col("f_id")) & (F.col("same") == F.col("f_same")), "left")
    at = F.coalesce(F.flatten(F.map_values("places")), F.array().cast("array<int>"))
    mine = F.coalesce(F.array_sort(F.map_keys(F.map_filter("places", lambda _, v: F.size(v) > 0))), F.array().cast("array<string>"))
    every = F.array_sort(F.array_distinct(F.concat(mine, F.coalesce("more", F.array().cast("array<string>")))))
    return out.select(F.col("id").alias(id_col), "n_words", F.size(at).cast("long").alias("n_base"),
                      F.array_min(at).cast("long").alias("first_word"), F.array_max(at).cast("long").alias("last_word"),
                      F.array_join(mine, ",").alias("base_labels"), F.array_join(every, ",").alias("labels"),
                      F.when(F.size(at) > 0, F.lit(1.0)).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"))
