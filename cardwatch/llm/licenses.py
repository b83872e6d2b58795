"""License texts and phrases by diagonal voting, in DataFrame operations only.

All rolling word k-grams of a text, as hashes, are joined with the positions of
the same k-grams in license templates.  A match of text position i and template
position j votes for the diagonal i - j.  Votes are aggregated by diagonal;
neighbouring diagonals of a template (a word or two put in or left out) are
merged to a span, and a span is verified: each vote by comparing its words, the
span by the share of the template's words that its votes cover and by its
length.  Grams have two words for templates of up to three words (phrases) and
four, hashed from two hashes of two, for longer ones.

A phrase stands where one diagonal has the votes of all its grams.

Defined results: null and empty texts have no words and no label, score 0;
repeated rows (same id and text) get the same result each; rows of one id with
different texts, null ids included, get their own; an empty table gives an
empty result; a phrase inside a longer one counts in its own right; columns of
the input other than id and text are not read.

Scale: one pass over the texts.  The join's small side are the templates, given
by the caller as a list, so their number is known: more than ``BROADCAST`` grams
are joined in blocks, a pass each.  Only votes are shuffled, after a partial
aggregate in which copies of a row become one.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cardwatch.llm import common
from cardwatch.llm.spans import let

# ---- Fixed values: phrases of the task, and the opening or notice texts of public licenses.
PHRASES = [("mit", "mit license"), ("apache", "apache license"), ("gpl", "general public license")]
TEXTS = [
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files, to deal in the Software without restriction"),
    ("apache", "Licensed under the Apache License, Version 2.0; you may not use this file except in compliance with the License"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
            "License as published by the Free Software Foundation"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
            "following conditions are met"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("cc-by", "Licensed under CC BY 4.0"),
]
# ---- End of fixed values.

SEPARATORS = r"[\x00-/:-`{-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Templates of up to so many words are phrases, matched exactly by grams of two.
PHRASE_WORDS = 3
#: Diagonals of one template at most so far apart belong to one span.
SLACK = 8
#: Share of a template's words that a span's votes must cover, and how many times the template's length it may be.
COVER, STRETCH = 0.8, 1.5
#: Template grams that are broadcast at once, at most.
BROADCAST = 5_000
#: Hash that every text has once, so that texts without votes stay in the result.
HEADER = -1


def words(text: Column) -> Column:
    """The words of a text: runs of digits, letters a-z (A-Z lower-cased) and characters beyond ASCII."""
    lowered = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.array_remove(F.split(lowered, SEPARATORS, -1), "")


def _pairs(hashes: Column, apart: int) -> Column:
    """Hash of each element and the one ``apart`` places on."""
    rest = F.greatest(F.size(hashes) - apart, F.lit(0))
    return F.zip_with(F.slice(hashes, F.lit(1), rest), F.slice(hashes, F.lit(apart + 1), rest), lambda a, b: F.xxhash64(a, b))


def grams(text_words: Column) -> Column:
    """Hashes of all two-word grams, in order, followed by those of all four-word grams."""
    return let(F.transform(text_words, lambda w: F.xxhash64(w)),
               lambda single: let(_pairs(single, 1), lambda two: F.concat(two, _pairs(two, 2))))


def _templates(labelled: list[tuple[str, str]]) -> list[tuple[int, str, list[str], int]]:
    """Number, label, words and gram length of each template."""
    out = []
    for number, (label, text) in enumerate(labelled):
        found = [w for w in re.split(SEPARATORS, text.translate(str.maketrans(UPPER, LOWER))) if w]
        if len(found) < 2:
            raise ValueError(f"a template needs two words: {text!r}")
        out.append((number, label, found, 2 if len(found) <= PHRASE_WORDS else 4))
    return out


def _blocks(templates: list, most: int) -> Iterator[list[tuple]]:
    """Grams of the templates (number, position, words of the gram) in lists of about ``most``; a template stays whole."""
    block: list[tuple] = []
    for number, _, found, k in templates:
        mine = [(number, at, found[at:at + k]) for at in range(len(found) - k + 1)]
        if block and len(block) + len(mine) > most:
            yield block
            block = []
        block += mine
    yield block


def _literal(spark: SparkSession, rows: list[tuple], *names: str) -> DataFrame:
    """A small table of literals."""
    entries = [F.struct(*[F.lit(v).alias(n) for v, n in zip(row, names)]) for row in rows]
    return spark.range(1).select(F.inline(F.array(*entries)))


def votes(docs: DataFrame, templates: list[tuple[int, str, list[str], int]], id_col: str, text_col: str) -> DataFrame:
    """Per text (``id``, ``digest``, ``n_words``), template and diagonal the template positions that match, and per text a
    row without template that counts its copies."""
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).alias("id"), F.md5(F.coalesce(F.col(text_col), F.lit(""))).alias("digest"),
                        words(F.col(text_col)).alias("words"))
    rolled = texts.withColumn("grams", grams(F.col("words"))).withColumn("n_two", F.greatest(F.size("words") - 1, F.lit(0)))
    out = None
    for number, block in enumerate(_blocks(templates, BROADCAST)):
        # a gram's own hash is the last of its grams
        table = _literal(spark, [(t, at, " ".join(gram)) for t, at, gram in block], "template", "at", "text").select(
            "template", "at", F.split("text", " ").alias("gram"))
        table = table.select(F.element_at(grams(F.col("gram")), -1).alias("hash"), "template", "at", "gram")
        every = F.col("grams")
        if number == 0:
            head = spark.range(1).select(F.lit(HEADER).cast("long").alias("hash"), F.lit(None).cast("int").alias("template"),
                                         F.lit(0).alias("at"), F.array().cast("array<string>").alias("gram"))
            table = table.union(head)
            every = F.concat(every, F.array(F.lit(HEADER).cast("long")))
        rows = rolled.select("id", "digest", "words", "n_two", F.posexplode(every).alias("pos", "hash"))
        place = F.when(F.col("pos") < F.col("n_two"), F.col("pos")).otherwise(F.col("pos") - F.col("n_two"))
        same = F.col("template").isNull() | (F.slice("words", F.col("place") + 1, F.greatest(F.size("gram"), F.lit(1))) == F.col("gram"))
        hits = rows.withColumn("place", place).join(F.broadcast(table), "hash").filter(same)
        diagonal = F.when(F.col("template").isNotNull(), F.col("place") - F.col("at")).otherwise(0)
        hits = hits.select("id", "digest", F.size("words").alias("n_words"), "template", diagonal.alias("diagonal"), "at")
        out = hits if out is None else out.union(hits)
    return out.groupBy("id", "digest", "n_words", "template", "diagonal").agg(F.count("*").alias("n"), F.collect_set("at").alias("at"))


def spans(voted: DataFrame, templates: list[tuple[int, str, list[str], int]], cover: float = COVER, stretch: float = STRETCH) -> DataFrame:
    """Spans of one template each (``id``, ``digest``, ``n_words``, ``template``): first and last word of the span, the share
    of the template covered, ``verified`` and, for phrases, ``places``, ``first_place``, ``last_place``; and the rows without template."""
    spark = voted.sparkSession
    known = _literal(spark, [(n, label, len(w), k) for n, label, w, k in templates], "template", "label", "size", "k")
    # all later groups are within a text
    voted = voted.repartition("id", "digest").join(F.broadcast(known), "template", "left")
    text = ["id", "digest", "n_words", "template"]
    order = Window.partitionBy(*text).orderBy("diagonal")
    fresh = F.coalesce((F.col("diagonal") - F.lag("diagonal").over(order) > SLACK).cast("int"), F.lit(0))
    voted = voted.withColumn("fresh", fresh).withColumn("span", F.sum("fresh").over(order))
    whole = F.when((F.col("size") <= PHRASE_WORDS) & (F.size("at") == F.col("size") - F.col("k") + 1), F.col("diagonal"))
    merged = voted.groupBy(*text, "label", "size", "k", "span").agg(
        F.array_distinct(F.flatten(F.collect_list("at"))).alias("at"), F.max("n").alias("n"),
        F.min(F.col("diagonal") + F.array_min("at")).alias("start"), F.max(F.col("diagonal") + F.array_max("at") + F.col("k")).alias("end"),
        F.count(whole).alias("places"), F.min(whole).alias("first_place"), F.max(whole).alias("last_place"))
    covered = F.size(F.array_distinct(F.flatten(F.transform("at", lambda a: F.sequence(a, a + F.col("k") - 1)))))
    share = F.when(F.col("size") <= PHRASE_WORDS, (F.col("places") > 0).cast("double")).otherwise(covered / F.col("size"))
    fits = (F.col("size") <= PHRASE_WORDS) | (F.col("end") - F.col("start") <= F.col("size") * stretch)
    return merged.withColumn("share", share).withColumn("verified", (F.col("share") >= cover) & fits).drop("at")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", phrases: list[tuple[str, str]] | None = None,
         texts: list[tuple[str, str]] | None = None) -> DataFrame:
    """One row per row of ``docs``: the id, ``n_words``, places of the phrases (``n_base``, ``first_word``, ``last_word``),
    ``base_labels``, ``labels`` (phrases and verified spans), ``score`` (largest share of a template found, 1 for a phrase) and
    ``spans`` (label, start, end, share of each verified span, words from 0)."""
    templates = _templates([*(PHRASES if phrases is None else phrases), *(TEXTS if texts is None else texts)])
    found = spans(votes(docs, templates, id_col, text_col), templates)
    good = F.col("verified")
    base = F.col("places") > 0
    one = F.struct("start", "end", "label", "share")
    per = found.groupBy("id", "digest", "n_words").agg(
        F.max(F.when(F.col("template").isNull(), F.col("n"))).alias("copies"), F.sum("places").alias("n_base"),
        F.min("first_place").cast("long").alias("first_word"), F.max("last_place").cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(base, F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set(F.when(good, F.col("label")))), ",").alias("labels"),
        F.coalesce(F.max("share"), F.lit(0.0)).alias("score"), F.array_sort(F.collect_list(F.when(good, one))).alias("spans"))
    return per.select(F.col("id").alias(id_col), F.col("n_words").cast("long").alias("n_words"), "n_base", "first_word", "last_word",
                      "base_labels", "labels", "score", "spans",
                      F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("copy")).drop("copy")


def op13_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and texts in every document."""
    places = F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["label"], s["start"], s["end"])), ",")
    return scan(common.table(spark, sf_dir, "documents")).withColumn("spans", places)
