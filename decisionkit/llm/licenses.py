"""License scans: an exact set-similarity join of text blocks against license templates, with DataFrame functions only.

Blocks are windows of ``block_words`` words that start every half window, over the whole text, so any passage of up to half a window lies
in one block. Template words are ordered by their frequency over all documents, rarest first; only such words can make an overlap, so a
block is the list of its template words in that order. For a template of t words and a threshold c, an overlap of o = ceil(c t) is
needed. A pair that reaches it shares a word among the template's first t - o + 1 and the block's first b - o + 1 (prefix filter), has
b >= o (length filter), and after the shared word enough words are left on either side (positional filter). What is left is counted
exactly: the template's words must stand within a passage of at most twice its own length, and words that name the license must be among
them. The order of words changes the work only, never the result. A passage longer than half a window is found if a window holds enough of it.
Texts are cut into words once; what is kept of them, and written for the later passes, is where template words stand, by half windows.

Nulls and odd rows: a null or empty text has no words and no labels; a very long text is cut into its windows like any other; repeated rows get the same result each; rows that share an id but not the
text stay apart; an empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import math
import re
import zlib
from itertools import count

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ascii_lower, filled, staged

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# fixed values: phrases of the base result, and opening sentences of public licenses with the words that must be there
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
TEMPLATES = [
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction", ""),
    ("mit", "Released under the MIT License", "mit"),
    ("apache", "you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0", "apache"),
    ("apache", "Licensed under the Apache License, Version 2.0", "apache"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation", "general public"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3", "general public"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met", ""),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0", "mozilla"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0", "cc nc"),
]
THRESHOLD, BLOCK_WORDS = 0.8, 64


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(ascii_lower(filled(text)), F.lit(WORD), F.lit(0))


def _template_words(text: str) -> list[str]:
    return sorted(set(re.findall(r"[0-9a-z]+", text.lower())))


def span_of(text: str) -> int:
    """Words within which a template's words must stand."""
    return 2 * len(re.findall(r"[0-9a-z]+", text.lower()))


def _vocabulary(templates: list[tuple[str, str, str]]) -> list[str]:
    return sorted({w for _, text, _ in templates for w in _template_words(text)})


def _one_of(vocabulary: list[str]):
    """Test of a word by one look into a table in which each word of the vocabulary has a place of its own."""
    sums = [zlib.crc32(w.encode()) for w in vocabulary]
    if len(set(sums)) < len(sums):
        return lambda w: F.array_contains(F.array(*map(F.lit, vocabulary)), w)
    places = next(n for n in count(max(1, len(sums))) if len({c % n for c in sums}) == len(sums))
    table = [""] * places
    for word, c in zip(vocabulary, sums):
        table[c % places] = word
    lookup = F.split(F.lit(",".join(table)), ",", -1)
    return lambda w: F.get(lookup, F.pmod(F.crc32(w.cast("binary")), F.lit(places)).cast("int")) == w


def _template_places(templates: list[tuple[str, str, str]], half: int) -> Column:
    """For each half window of ``words`` the (at, word) of the template words in it."""
    own = _one_of(_vocabulary(templates))

    def places(start: Column) -> Column:
        every = F.transform(F.slice("words", start + 1, F.lit(half)), lambda w, i: F.when(own(w), F.struct((start + i).alias("at"), w.alias("word"))))
        return F.filter(every, lambda x: x.isNotNull())

    return F.transform(F.sequence(F.lit(0), F.greatest(F.size("words") - 1, F.lit(0)), F.lit(half)), places)


def frequency_order(rows: DataFrame, vocabulary: list[str]) -> list[str]:
    """The vocabulary of the templates, rarest over all documents first. At most that many counts reach the driver."""
    own = F.array_distinct(F.transform(F.flatten("halves"), lambda x: x["word"]))
    seen = rows.select(F.explode(own).alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    counts = {r["word"]: r["n"] for r in seen.collect()}
    return sorted(vocabulary, key=lambda w: (counts.get(w, 0), w))


def _prefixes(spark: SparkSession, templates: list[tuple[str, str, str]], block_words: int, order: list[str], threshold: float) -> DataFrame:
    """One row per template and word of its prefix: word, t_pos, t_size, needed, label, t_words, names, span. A few rows per template."""
    rows = []
    for label, text, names in templates:
        own = [w for w in order if w in set(_template_words(text))]
        needed = math.ceil(threshold * len(own) - 1e-9)
        for pos, word in enumerate(own[: len(own) - needed + 1]):
            rows.append(
                F.struct(
                    F.lit(word).alias("word"),
                    F.lit(pos).alias("t_pos"),
                    F.lit(len(own)).alias("t_size"),
                    F.lit(needed).alias("needed"),
                    F.lit(label).alias("label"),
                    F.array(*map(F.lit, own)).alias("t_words"),
                    F.array(*map(F.lit, names.split())).cast("array<string>").alias("names"),
                    F.lit(min(block_words, span_of(text))).alias("span"),
                )
            )
    return spark.range(1).select(F.inline(F.array(*rows)))


def similarity_join(rows: DataFrame, templates: list[tuple[str, str, str]] = TEMPLATES, threshold: float = THRESHOLD, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(doc_id, key, n_words, halves) -> doc_id, key, block (first word), label, containment: every block and template at or above the threshold."""
    vocabulary = _vocabulary(templates)
    if max(len(_template_words(text)) for _, text, _ in templates) > block_words // 2:
        raise ValueError("a block must be twice as long as the longest template")
    order = frequency_order(rows, vocabulary)
    least = min(math.ceil(threshold * len(_template_words(text)) - 1e-9) for _, text, _ in templates)
    own, half = F.array(*map(F.lit, order)), block_words // 2
    starts = F.sequence(F.lit(0), F.greatest(F.col("n_words") - half - 1, F.lit(0)).cast("int"), F.lit(half))

    def window(s: Column) -> Column:
        parts = [F.coalesce(F.get("halves", (s / half).cast("int") + k), F.array().cast("array<struct<at:int,word:string>>")) for k in range(2 + block_words % 2)]
        return F.filter(F.concat(*parts), lambda x: x["at"] < s + block_words)

    blocks = rows.where(F.exists("halves", lambda h: F.size(h) > 0)).select("doc_id", "key", F.explode(F.transform(starts, lambda s: F.struct(s.alias("block"), window(s).alias("text")))).alias("b"))
    blocks = blocks.select("doc_id", "key", "b.block", "b.text").where(F.size("text") >= least)
    blocks = blocks.withColumn("own", F.array_intersect(own, F.transform("text", lambda x: x["word"])))
    blocks = blocks.withColumn("b_size", F.size("own")).where(F.col("b_size") >= least)
    prefix = blocks.select("doc_id", "key", "block", "text", "b_size", F.posexplode(F.slice("own", F.lit(1), F.col("b_size") - least + 1)).alias("b_pos", "word"))
    index = F.broadcast(_prefixes(rows.sparkSession, templates, block_words, order, threshold))  # bounded by the templates
    pairs = prefix.join(index, "word").where(
        (F.col("b_pos") <= F.col("b_size") - F.col("needed")) & (1 + F.least(F.col("b_size") - F.col("b_pos"), F.col("t_size") - F.col("t_pos")) - 1 >= F.col("needed"))
    )
    # words of the template within one of its spans, from each place where one of them stands
    places = F.filter("text", lambda x: F.array_contains(F.col("t_words"), x["word"]))
    pairs = pairs.withColumn("places", places)
    within = lambda x: F.array_distinct(F.transform(F.filter("places", lambda y: (y["at"] >= x["at"]) & (y["at"] < x["at"] + F.col("span"))), lambda y: y["word"]))
    named = F.filter(F.transform("places", within), lambda own: F.size(F.array_except("names", own)) == 0)
    pairs = pairs.withColumn("overlap", F.coalesce(F.array_max(F.transform(named, lambda own: F.size(own))), F.lit(0)))
    return pairs.where("overlap >= needed").select("doc_id", "key", "block", "label", (F.col("overlap") / F.col("t_size")).alias("containment"))


def _phrase_places(phrases: dict[str, str]) -> Column:
    """Array of (at, label): places where a phrase's words stand consecutively."""

    def at(i: Column) -> Column:
        out = F.lit(None).cast("struct<at:bigint,label:string>")
        for phrase, label in phrases.items():
            here = None
            for k, word in enumerate(phrase.split()):
                same = F.get("words", i + k) == word
                here = same if here is None else here & same
            out = F.when(here, F.struct(i.cast("long").alias("at"), F.lit(label).alias("label"))).otherwise(out)
        return out

    lasts = F.array(*[F.lit(w) for w in sorted({p.split()[-1] for p in phrases})])
    places = F.filter(F.transform(F.sequence(F.lit(0), F.size("words") - 1), at), lambda x: x.isNotNull())
    return F.when(F.arrays_overlap("words", lasts), places).otherwise(F.array().cast("array<struct<at:bigint,label:string>>"))


def license_scan(docs: DataFrame, templates: list[tuple[str, str, str]] = TEMPLATES, phrases: dict[str, str] = PHRASES, threshold: float = THRESHOLD, block_words: int = BLOCK_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score (the best containment; 1 for a base phrase)."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(filled(F.col(text_col))).alias("key"), words_of(F.col(text_col)).alias("words"))
    rows = rows.select(
        "doc_id",
        "key",
        F.size("words").cast("long").alias("n_words"),
        _phrase_places(phrases).alias("places"),
        _template_places(templates, block_words // 2).alias("halves"),
    )
    rows = staged(rows, "license-words")
    found = similarity_join(rows, templates, threshold, block_words).groupBy(F.col("doc_id").alias("f_id"), F.col("key").alias("f_key"))
    found = found.agg(F.collect_set("label").alias("found"), F.max("containment").alias("best"))
    base = rows.select("doc_id", "key", "n_words", "places")
    starts, labels = F.col("places")["at"], F.col("places")["label"]
    base = base.select(
        "doc_id",
        "key",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        F.array_sort(F.array_distinct(labels)).alias("base"),
    )
    out = base.join(found, base["doc_id"].eqNullSafe(found["f_id"]) & (base["key"] == found["f_key"]), "left")
    every = F.array_sort(F.array_distinct(F.concat("base", F.coalesce("found", F.array().cast("array<string>")))))
    return out.select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join("base", ",").alias("base_labels"),
        F.array_join(every, ",").alias("labels"),
        F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"),
    )
