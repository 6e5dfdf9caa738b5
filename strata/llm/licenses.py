"""License scans by diagonal voting (operator 11, DataFrame functions only).

Words: A-Z lower-cased, then runs of ASCII letters, digits and non-ASCII characters. Templates
are license notices and short phrases, cut into the same words.

1. Every run of ``GRAM`` words of every text is hashed and joined to the template positions that
   carry the hash; the words themselves are compared too, so no match rests on the hash.
2. A match at word p of the text and word q of a template votes for the diagonal p - q, where
   the template would start. A phrase is found where one diagonal has all its votes.
3. For notices, diagonals of one template at most ``SLACK`` words apart, and whose matches are at
   most ``REACH`` words apart, are merged: a word left out, added or changed moves the rest of
   the text to a neighbouring diagonal, or leaves a gap on the same one.
4. A merged span is verified by the share of the template's words that its matches cover, and by
   its length; the best share is the score.

Texts are read once and never shuffled: matches travel (a few numbers each), and one narrow
row for each document, under a number of its own that is written before it is grouped by.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import materialise
from strata.llm.decontamination import words_of

GRAM = 3
SLACK = 6
REACH = 24
SHARE = 0.7
# templates of up to this many words together (some MB) are broadcast; more are joined by a shuffle
BROADCAST_WORDS = 100_000


@dataclass(frozen=True)
class Template:
    """A text that stands for a license. A ``whole`` template (a phrase) counts only where all
    its words stand consecutively; others as set out above. At least ``GRAM`` words long."""

    label: str
    text: str
    whole: bool = False


# The phrases of the contract
PHRASES = (
    Template("mit", "under the mit license", True),
    Template("apache-2", "apache license version 2", True),
    Template("cc-by-nc", "cc by nc", True),
)

# The usual notices of public licenses
NOTICES = (
    Template("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
             "software and associated documentation files (the \"Software\"), to deal in the Software "
             "without restriction"),
    Template("apache-2", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use "
             "this file except in compliance with the License."),
    Template("bsd", "Redistribution and use in source and binary forms, with or without modification, are "
             "permitted provided that the following conditions are met"),
    Template("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with "
             "or without fee is hereby granted"),
    Template("gpl-3", "This work is licensed under the GNU General Public License, version 3"),
    Template("gpl", "This program is free software: you can redistribute it and/or modify it under the terms "
             "of the GNU General Public License as published by the Free Software Foundation"),
    Template("lgpl", "you can redistribute it and/or modify it under the terms of the GNU Lesser General "
             "Public License as published by the Free Software Foundation"),
    Template("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    Template("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial "
             "International License"),
    Template("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike "
             "International License"),
    Template("unlicense", "This is free and unencumbered software released into the public domain"),
)


def template_words(spark: SparkSession, templates: Sequence[Template]) -> DataFrame:
    """One row per template: template (its number), label, whole, words, length."""
    rows = F.array(*[F.struct(F.lit(i).alias("template"), F.lit(t.label).alias("label"),
                              F.lit(t.whole).alias("whole"), F.lit(t.text).alias("text"))
                     for i, t in enumerate(templates)])
    return spark.range(1).select(F.explode(rows).alias("t")).select("t.*") \
        .withColumn("words", words_of(F.col("text"))).drop("text") \
        .withColumn("length", F.size("words"))


def _gram(words: Column, first: Column, at: Column) -> list[Column]:
    """The words of the run that starts with ``first`` at place ``at``; null past the end."""
    return [first, *[F.get(words, at + F.lit(i)) for i in range(1, GRAM)]]


def _positions(templates: DataFrame) -> DataFrame:
    """One row per run of a template: hash, template, q and the run's words."""
    rows = templates.select("template", "words", F.posexplode("words").alias("q", "word"))
    words = _gram(F.col("words"), F.col("word"), F.col("q"))
    return rows.where(F.col("q") <= F.size("words") - GRAM).select(
        "template", "q", F.xxhash64(*words).alias("hash"),
        *[w.alias(f"t{i}") for i, w in enumerate(words)])


def _matches(docs: DataFrame, positions: DataFrame, small: bool) -> DataFrame:
    """One row per match (document number, place p, template, q), and one row with ``head`` for
    every document."""
    rows = docs.withColumn("row", F.monotonically_increasing_id()) \
        .withColumn("words", words_of(F.col("text")))
    # the outer form keeps Spark from filtering by the array below the projection that builds it
    runs = rows.select("row", "id", "words", F.posexplode_outer("words").alias("p", "word"))
    words = _gram(F.col("words"), F.col("word"), F.col("p"))
    # a run past the text's end holds a null and hashes like a shorter one: the words decide
    same = F.xxhash64(*words) == F.col("hash")
    for i, w in enumerate(words):
        same &= w == F.col(f"t{i}")
    found = runs.join(F.broadcast(positions) if small else positions, same, "left")
    head = F.coalesce(F.col("p"), F.lit(0)) == 0
    return found.where(head | F.col("template").isNotNull()).select(
        "row", F.when(head, F.col("id")).alias("id"), head.alias("head"),
        F.when(head, F.greatest(F.size("words"), F.lit(0))).cast("bigint").alias("n_words"),
        F.col("p"), "template", "q")


def _spans(votes: DataFrame) -> DataFrame:
    """Diagonals of a text and template merged with their neighbours: row, template, start,
    stop and covered (how many of the template's words the matches of the span cover)."""
    along = Window.partitionBy("row", "template").orderBy("diagonal", "first")
    gap = (F.col("diagonal") - F.lag("diagonal").over(along) > SLACK) | \
          (F.col("first") - F.max("last").over(
              along.rowsBetween(Window.unboundedPreceding, -1)) > REACH)
    islands = votes.withColumn("opens", F.coalesce(gap, F.lit(True)).cast("int")) \
        .withColumn("island", F.sum("opens").over(along))
    ends = islands.groupBy("row", "template", "island").agg(
        F.min("first").alias("start"), (F.max("last") + GRAM).alias("stop"))
    # each word of the template once, whatever the number of matches that cover it
    covered = islands.select("row", "template", "island", F.explode("places").alias("q")) \
        .select("row", "template", "island",
                F.explode(F.sequence(F.col("q"), F.col("q") + GRAM - 1)).alias("word")) \
        .groupBy("row", "template", "island").agg(F.size(F.collect_set("word")).alias("covered"))
    return ends.join(covered, ["row", "template", "island"]).drop("island")


def scan(docs: DataFrame, notices: Sequence[Template] = NOTICES,
         phrases: Sequence[Template] = PHRASES, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """Every row of ``docs`` with the licenses its text names.

    Returns id (named ``id_col``), n_words; places (sorted word numbers at which a phrase
    starts); base (sorted labels of the phrases found); labels (of phrases and verified notices);
    score (1 with a phrase, else the best share of a notice's words found in one span); spans
    (array of struct<start, stop, label, share>: the verified spans of notices, in order).
    Null and empty texts have no words, no labels and score 0; repeated rows and null ids each
    count on their own; other columns are not read; an empty table gives an empty one. A template
    shorter than ``GRAM`` words is never found.
    """
    spark = docs.sparkSession
    known = [*phrases, *notices]
    templates = template_words(spark, known)
    small = sum(len(t.text.split()) for t in known) <= BROADCAST_WORDS
    facts = templates.select("template", "label", "whole", "length")
    facts = F.broadcast(facts) if small else facts
    rows = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    matches = materialise(_matches(rows, _positions(templates), small), "license-matches")

    votes = matches.where(F.col("template").isNotNull()) \
        .groupBy("row", "template", (F.col("p") - F.col("q")).alias("diagonal")).agg(
            F.min("p").alias("first"), F.max("p").alias("last"), F.collect_set("q").alias("places"))
    votes = materialise(votes.join(facts, "template"), "license-votes")
    exact = votes.where(F.col("whole") & (F.size("places") == F.col("length") - GRAM + 1)) \
        .groupBy("row").agg(F.array_sort(F.collect_list(F.col("diagonal").cast("bigint"))).alias("places"),
                            F.array_sort(F.collect_set("label")).alias("base"))
    share = F.col("covered") / F.col("length")
    length = F.col("stop") - F.col("start")
    near = _spans(votes.where(~F.col("whole"))).join(facts, "template") \
        .withColumn("share", share)
    fits = (F.col("share") >= SHARE) & (length <= 2 * F.col("length"))
    verified = F.when(fits, F.struct("start", "stop", "label", "share"))
    near = near.groupBy("row").agg(
        F.max("share").alias("best"), F.array_sort(F.collect_list(verified)).alias("spans"))

    heads = matches.where("head").groupBy("row").agg(
        F.first("id", ignorenulls=True).alias("id"), F.first("n_words").alias("n_words"))
    none = F.array().cast("array<string>")
    out = heads.join(exact, "row", "left").join(near, "row", "left")
    base = F.coalesce("base", none)
    own = F.coalesce(F.transform("spans", lambda s: s["label"]), none)
    return out.select(
        F.col("id").alias(id_col), "n_words",
        F.coalesce("places", F.array().cast("array<bigint>")).alias("places"),
        base.alias("base"), F.array_sort(F.array_union(base, own)).alias("labels"),
        F.when(F.col("base").isNotNull(), F.lit(1.0)).otherwise(F.coalesce("best", F.lit(0.0)))
        .alias("score"), F.coalesce("spans", F.array().cast(near.schema["spans"].dataType)).alias("spans"))
