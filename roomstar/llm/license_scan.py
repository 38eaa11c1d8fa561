"""Licence scan by diagonal voting: DataFrame functions only, nothing runs in Python workers.

Every run of ``GRAM`` words of every text is hashed and joined to the runs of the templates. A hit
(place in the text, place in the template) votes for its diagonal, text place minus template
place: a verbatim copy of a template has all its votes on one diagonal, a copy with a few words
put in or left out has them on neighbouring ones. Votes are grouped by diagonal, diagonals at most
``GAP`` apart are merged, and a merged span is verified: at least ``MIN_COVERAGE`` of the
template's words lie in runs that occur, and the span is not longer than ``MAX_STRETCH`` times the
template. A hit counts only if the words themselves are equal, not just their hash.

Phrases are templates that count word for word: all runs on one diagonal.

A word is a run of letters, digits and non-ASCII characters; A to Z are lower-cased. Null and
empty texts have no words and get no label. Rows that repeat an id and a text are judged once and
returned as often as they came. Texts of any length are scanned whole; a text's hits are grouped by
(text, template, diagonal), so no task holds the hits of one template. An empty table gives no
rows. Columns other than the id and the text are not read.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roomstar.llm.columns import id_and_text
from roomstar.operators.joins import maybe_broadcast

WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
GRAM = 3
GAP = 2
MIN_COVERAGE = 0.8
MAX_STRETCH = 1.5

# Fixed values: (label, phrase that counts word for word).
PHRASES = (
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
)

# Fixed values: (label, sentence by which a licence is usually named or granted).
TEMPLATES = (
    ("gpl-3", "licensed under the GNU General Public License, version 3"),
    ("gpl", "free software: you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    ("lgpl", "free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files, to deal in the Software without restriction"),
    ("apache-2", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted "
            "provided that the following conditions are met"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("mpl-2", "subject to the terms of the Mozilla Public License, v. 2.0"),
    ("cc-by-nc", "licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc-by-sa", "licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("unlicense", "free and unencumbered software released into the public domain"),
)


def _lower(words: Column) -> Column:
    return F.translate(words, UPPER, LOWER)


def _words(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def _grams(texts: DataFrame) -> DataFrame:
    """Adds ``_grams``, the hash of each run of GRAM of the ``_words``; fewer words give none. The
    words are lower-cased by all of Unicode, which makes equal what is equal but for A to Z; the
    join compares the words themselves."""
    one = lambda i: F.xxhash64(*[F.get("_low", i + j) for j in range(GRAM)])
    runs = F.transform(F.sequence(F.lit(0), F.size("_low") - GRAM), one)
    return (texts.withColumn("_low", F.transform("_words", F.lower))
            .withColumn("_grams", F.when(F.size("_low") >= GRAM, runs).otherwise(F.array().cast("array<bigint>"))))


def _template_runs(spark, templates, phrases) -> tuple[DataFrame, int]:
    """(one row per run of a template, their number). Kinds are told apart by ``exact``."""
    rows = [(i, label, text, i < len(phrases)) for i, (label, text) in enumerate([*phrases, *templates])]
    total = 0
    for _, label, text, _ in rows:
        n = len(re.findall(WORD, text)) - GRAM + 1
        if n < 1:
            raise ValueError(f"template {label!r} has fewer than {GRAM} words: {text!r}")
        total += n
    made = F.array(*[F.struct(F.lit(i).alias("template"), F.lit(label).alias("label"), F.lit(text).alias("text"),
                              F.lit(exact).alias("exact")) for i, label, text, exact in rows])
    runs = (_grams(spark.range(1).select(F.inline(made)).withColumn("_words", _words(F.col("text"))))
            .withColumn("t_words", F.size("_words")).select("*", F.posexplode("_grams").alias("t_at", "t_hash")))
    return runs.select("template", "label", "exact", "t_words", "t_at", "t_hash",
                       *[_lower(F.get("_words", F.col("t_at") + j)).alias(f"_w{j}") for j in range(GRAM)]), total


def scan(docs: DataFrame, templates: Sequence[tuple[str, str]] = TEMPLATES,
         phrases: Sequence[tuple[str, str]] = PHRASES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``n_words``; ``n_base`` places of phrases with the first and last of
    them (``first_word``, ``last_word``) and their sorted labels; the sorted labels of phrases and
    verified spans; the verified spans (label, first word, end word, share of the template);
    ``score``, the greatest share of a template that lies on merged diagonals (0 without a hit)."""
    runs, n_runs = _template_runs(docs.sparkSession, templates, phrases)
    texts = _grams(id_and_text(docs, id_col, text_col).select(
        "doc_id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("_digest"), _words(F.col("text")).alias("_words")))
    # The entry in front stands for the text itself, so that texts without a hit stay.
    placed = (texts.select("doc_id", "_digest", F.size("_words").cast("long").alias("n_words"), "_words",
                           F.posexplode(F.concat(F.array(F.lit(None).cast("bigint")), F.col("_grams"))).alias("_at", "_hash"))
              .withColumn("_at", F.col("_at") - 1))
    same = F.lit(True)
    for j in range(GRAM):
        same &= _lower(F.get("_words", F.col("_at") + j)) == F.col(f"_w{j}")
    key = ["doc_id", "_digest"]
    kind = ["template", "label", "exact", "t_words"]
    votes = (placed.join(maybe_broadcast(runs, n_runs), F.col("_hash") == F.col("t_hash"), "left")
             .where((F.col("_at") < 0) | (F.col("template").isNotNull() & same))
             .groupBy(*key, *kind, (F.col("_at") - F.col("t_at")).alias("_diagonal"))
             .agg(F.max("n_words").alias("n_words"), F.collect_set("t_at").alias("_votes"),
                  F.count_if(F.col("_at") < 0).alias("_copies")))

    along = Window.partitionBy(*key, "template").orderBy("_diagonal")
    apart = F.col("_diagonal") - F.lag("_diagonal").over(along) > GAP
    merged = votes.withColumn("_apart", F.coalesce(apart, F.lit(False)).cast("int")).withColumn(
        "_span", F.sum("_apart").over(along.rowsBetween(Window.unboundedPreceding, 0)))

    whole = F.col("exact") & (F.size("_votes") == F.col("t_words") - GRAM + 1)
    covered = F.size(F.array_distinct(F.flatten(F.transform(
        F.flatten(F.collect_list("_votes")), lambda p: F.sequence(p, p + GRAM - 1)))))
    spans = merged.groupBy(*key, *kind, "_span").agg(
        F.max("n_words").alias("n_words"), F.max("_copies").alias("_copies"),
        F.min(F.col("_diagonal") + F.array_min("_votes")).alias("_first"),
        F.max(F.col("_diagonal") + F.array_max("_votes") + GRAM).alias("_end"),
        F.count_if(whole).alias("_whole"),
        F.min(F.when(whole, F.col("_diagonal"))).alias("_whole_first"),
        F.max(F.when(whole, F.col("_diagonal"))).alias("_whole_last"),
        covered.alias("_covered"))
    share = F.when(~F.col("exact"), F.col("_covered") / F.col("t_words")).when(F.col("_whole") > 0, F.lit(1.0))
    fits = F.when(F.col("exact"), F.col("_whole") > 0).otherwise(
        (F.col("_share") >= MIN_COVERAGE) & (F.col("_end") - F.col("_first") <= MAX_STRETCH * F.col("t_words")))
    found = F.struct("label", F.col("_first").cast("long").alias("first_word"),
                     F.col("_end").cast("long").alias("end_word"), F.col("_share").alias("share"))
    labels = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",")
    return (spans.withColumn("_share", share).withColumn("_fits", fits).groupBy(*key).agg(
                F.max("n_words").alias("n_words"), F.max("_copies").alias("_copies"),
                F.sum("_whole").alias("n_base"), F.min("_whole_first").cast("long").alias("first_word"),
                F.max("_whole_last").cast("long").alias("last_word"),
                labels(F.when(F.col("_whole") > 0, F.col("label"))).alias("base_labels"),
                labels(F.when(F.col("_fits"), F.col("label"))).alias("labels"),
                F.array_sort(F.collect_list(F.when(F.col("_fits"), found))).alias("spans"),
                F.coalesce(F.max("_share"), F.lit(0.0)).alias("score"))
            .select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "spans", "score",
                    F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int"))).alias("_copy"))
            .drop("_copy"))
