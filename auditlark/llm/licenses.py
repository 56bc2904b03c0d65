"""License scans: every text block that holds a license template to a containment threshold.

A template's containment in a block is the share of its distinct words that the block holds. The join is exact:

- words are ordered by how many blocks of the whole corpus hold them, rarest first;
- *prefix*: a block that holds ``a = ceil(t * |T|)`` of a template's words shares one with the template's first ``|T| - a + 1``
  words and has it among its own first ``|B| - a + 1``;
- *length*: the block has at least ``a`` distinct words;
- *position*: the words after the shared one suffice to reach ``a``;
- what passes is verified by intersecting the word sets.

A block is a line. Words outside every template cannot match and are dropped before the order is taken, so what moves
between tasks is a few words of the few blocks that can match. Templates are a parameter and small: one row per template word.

Besides, exact places of fixed phrases are counted over the whole text, across lines.

Null text counts as empty: no words, no places, no labels, score 0. Rows that share an id are scanned each by its own text;
equal rows give equal results. Other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BLANK_IN_LINE = r"[\x00-\x09\x0B-\x2F\x3A-\x60\x7B-\x7F]+"

# Phrases and their labels.
PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)

# Opening words of well-known public notices.
TEMPLATES = (
    ("gpl-3.0", "this work is licensed under the gnu general public license version 3"),
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0"),
    ("cc-by-sa-4.0", "licensed under cc by sa 4 0"),
    ("mit-notice", "released under the mit license"),
    ("mit-text", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("all-rights-reserved", "all rights reserved"),
)


def _lines(text: Column) -> Column:
    """Lower-cased words, one blank between words and a line feed between lines."""
    return F.regexp_replace(F.translate(F.coalesce(text.cast("string"), F.lit("")), UPPER, LOWER), BLANK_IN_LINE, " ")


def needed(words: int, threshold: Fraction) -> int:
    return max(1, -(-words * threshold.numerator // threshold.denominator))


def matches(blocks: DataFrame, templates: Sequence[tuple[str, str]], threshold: str, keys: list[str]) -> DataFrame:
    """``(keys, label, containment)`` of every block and template that meet the threshold; ``blocks`` has the keys and the array ``words``."""
    spark, t = blocks.sparkSession, Fraction(threshold)
    split = [(i, label, sorted(set(re.findall(WORD, text)))) for i, (label, text) in enumerate(templates)]
    vocabulary = sorted({w for _, _, words in split for w in words})
    least = min(needed(len(words), t) for _, _, words in split)
    known = blocks.select(*keys, F.array_intersect(F.array_distinct("words"), F.lit(vocabulary)).alias("words")).where(F.size("words") >= least)

    counts = known.select(F.explode("words").alias("word")).groupBy("word").count()
    listed = spark.createDataFrame([(i, label, len(words), needed(len(words), t), w) for i, label, words in split for w in words],
                                   "template int, label string, size int, needed int, word string")
    # One row per word of the vocabulary, which the templates bound.
    order = listed.select("word").distinct().join(counts, "word", "left").select(F.coalesce("count", F.lit(0)).alias("n"), "word")
    order = order.agg(F.array_sort(F.collect_list(F.struct("n", "word"))).alias("o")).select(F.col("o.word").alias("order"))
    ranked = listed.crossJoin(F.broadcast(order)).withColumn("rank", F.array_position("order", F.col("word")))
    wanted = ranked.groupBy("template", "label", "size", "needed").agg(F.array_sort(F.collect_list("rank")).alias("ranks"))
    probe = wanted.select("template", "label", "size", "needed", "ranks", F.posexplode("ranks").alias("i", "rank")).where(F.col("i") <= F.col("size") - F.col("needed"))

    own = known.crossJoin(F.broadcast(order)).select(*keys, F.array_sort(F.transform("words", lambda w: F.array_position("order", w))).alias("own"))
    offered = own.select(*keys, "own", F.posexplode("own").alias("j", "rank"))
    pairs = offered.join(F.broadcast(probe), "rank").where(
        (F.size("own") >= F.col("needed")) & (F.col("j") <= F.size("own") - F.col("needed"))
        & (1 + F.least(F.col("size") - 1 - F.col("i"), F.size("own") - 1 - F.col("j")) >= F.col("needed")))
    shared = pairs.withColumn("shared", F.array_intersect("own", "ranks")).where(F.col("rank") == F.array_min("shared"))  # each pair once, at its rarest word
    return shared.withColumn("common", F.size("shared")).where("common >= needed").select(*keys, "label", (F.col("common") / F.col("size")).alias("containment"))


def _spaced(words: str) -> str:
    return " " + words.replace(" ", "  ") + " "


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: Sequence[tuple[str, str]] = TEMPLATES,
         phrases: Sequence[tuple[str, str]] = PHRASES, threshold: str = "0.9") -> DataFrame:
    """``(id_col, n_words, n_base, first_word, last_word, base_labels, labels, score)`` of every document.

    ``score`` is 1 where a phrase stands, else the largest containment that meets the threshold, else 0.
    """
    rows = docs.select(F.col(id_col).alias("id"), _lines(F.col(text_col)).alias("lines"), F.xxhash64(F.col(text_col).cast("string")).alias("mark"))
    blocks = rows.select("id", "mark", F.explode(F.split("lines", "\n")).alias("line"))
    blocks = blocks.select("id", "mark", F.split(F.trim("line"), " ").alias("words"))
    found = matches(blocks, templates, threshold, ["id", "mark"])
    found = found.groupBy("id", "mark").agg(F.collect_set("label").alias("own"), F.max("containment").alias("best"))

    # Each word between two blanks of its own, so that neighbouring phrases do not overlap.
    rows = rows.select("id", "mark", F.trim(F.regexp_replace("lines", "[ \n]+", " ")).alias("words"))
    n_words = F.when(F.col("words") == "", 0).otherwise(F.length("words") - F.length(F.replace("words", F.lit(" "), F.lit(""))) + 1)
    some = F.lit(False)
    for phrase, _ in phrases:
        some = some | F.contains("words", F.lit(phrase))
    spaced = F.when(some, F.concat(F.lit(" "), F.replace("words", F.lit(" "), F.lit("  ")), F.lit(" ")))
    rows = rows.select("id", "mark", n_words.cast("long").alias("n_words"), spaced.alias("spaced"))

    def before(part: Column) -> Column:
        """Words of a piece cut off the spaced text: half its blanks."""
        return ((F.length(part) - F.length(F.replace(part, F.lit(" "), F.lit("")))) / 2).cast("long")

    counts, firsts, lasts, labels = [], [], [], []
    for phrase, label in phrases:
        text = F.lit(_spaced(phrase))
        here = F.coalesce(F.contains("spaced", text), F.lit(False))
        counts.append(F.when(here, ((F.length("spaced") - F.length(F.replace("spaced", text, F.lit("")))) / len(_spaced(phrase))).cast("long")).otherwise(0))
        firsts.append(F.when(here, before(F.substring_index("spaced", _spaced(phrase), 1))))
        after = before(F.substring_index("spaced", _spaced(phrase), -1))
        lasts.append(F.when(here, F.col("n_words") - after - len(phrase.split(" "))))
        labels.append(F.when(here, F.lit(label)))
    base = F.array_sort(F.array_distinct(F.array_compact(F.array(*labels))))
    rows = rows.select("id", "mark", "n_words", sum(counts[1:], counts[0]).cast("long").alias("n_base"), F.array_min(F.array(*firsts)).alias("first_word"),
                       F.array_max(F.array(*lasts)).alias("last_word"), base.alias("base"))
    both = rows.alias("r").join(found.alias("f"), F.col("r.id").eqNullSafe(F.col("f.id")) & (F.col("r.mark") == F.col("f.mark")), "left")
    everything = F.array_sort(F.array_distinct(F.concat("base", F.coalesce("own", F.array().cast("array<string>")))))
    return both.select(
        F.col("r.id").alias(id_col), "n_words", "n_base", "first_word", "last_word", F.array_join("base", ",").alias("base_labels"),
        F.array_join(everything, ",").alias("labels"), F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"))
