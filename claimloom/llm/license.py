"""License scans: phrases found word by word, and an exact set-similarity join of text blocks with notices.

The join finds every block (a line, or a paragraph of several lines) that holds at least ``THRESHOLD`` of a notice's
different words. Words are ordered by their frequency in the whole corpus, rare ones first. A block that
qualifies must share one of a notice's first words (prefix filter), have enough different words (length
filter), and leave room for enough common ones before and after the shared word (positional filter). Only what
passes all three is compared in full. Built-in expressions throughout.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom.llm.common import broadcast_if_small, lower_ascii, staged, text_or_empty

#: Phrases and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

#: Notices by label, in the wording of the public licenses. The scan takes others as well.
NOTICES = {
    "apache": (
        "Licensed under the Apache License, Version 2.0",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at",
    ),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met",
    ),
    "cc-by": (
        "This work is licensed under a Creative Commons Attribution 4.0 International License",
        "Licensed under Creative Commons Attribution 4.0",
    ),
    "cc-by-nc": (
        "Licensed under CC BY-NC 4.0",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
    ),
    "gpl": (
        "This work is licensed under the GNU General Public License, version 3",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation",
    ),
    "mit": (
        "Released under the MIT License",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the Software), to deal in the Software without restriction",
    ),
    "mpl": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    ),
}
THRESHOLD = 0.9

_BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_PARAGRAPH_END = r"\n[\x20\t\r]*\n"


def spaced_words(text: Column) -> Column:
    """The words in order, each with one space on either side; one space if there is none."""
    words = F.trim(F.regexp_replace(lower_ascii(text), _BETWEEN_WORDS, " "))
    return F.when(words == "", F.lit(" ")).otherwise(F.concat(F.lit(" "), words, F.lit(" ")))


def words_of(spaced: Column) -> Column:
    return F.filter(F.split(spaced, " "), lambda w: w != "")


def phrase_places(spaced: Column, n_words: Column, phrases: Mapping[str, str] = PHRASES) -> dict[str, Column]:
    """``n_base``, ``first_word``, ``last_word`` and ``base_labels`` (an array) from the spaced words."""
    counts, firsts, lasts, labels = [], [], [], []
    for phrase, label in phrases.items():
        inside = f" {phrase} "
        found = F.contains(spaced, F.lit(inside))
        places = F.regexp_count(spaced, F.lit(f"(?<= ){phrase}(?= )"))
        before = F.regexp_count(F.substring_index(spaced, inside, 1), F.lit(" "))
        after = F.regexp_count(F.substring_index(spaced, inside, -1), F.lit(" "))
        counts.append(F.when(found, places).otherwise(0))
        firsts.append(F.when(found, before.cast("long")))
        lasts.append(F.when(found, n_words - after - len(phrase.split())))
        labels.append(F.when(found, F.lit(label)))
    total = counts[0]
    for count in counts[1:]:
        total = total + count
    return {
        "n_base": total.cast("long"),
        "first_word": F.least(*firsts),
        "last_word": F.greatest(*lasts),
        "base_labels": F.array_distinct(F.array_compact(F.array(*labels))),
    }


def plain_words(text: str) -> list[str]:
    """The different words of a notice, in order of appearance."""
    kept = "".join(c.lower() if c.isascii() and c.isalnum() else " " if c.isascii() else c for c in text)
    return list(dict.fromkeys(kept.split()))


def _literals(words: Sequence[str]) -> Column:
    return F.array(*[F.lit(w) for w in words])


def word_frequencies(spaced: DataFrame, words: Sequence[str]) -> dict[str, int]:
    """How often the corpus has each of the notices' words; as many rows come back as there are such words."""
    every = spaced.select(F.explode(F.split("spaced", " ")).alias("word")).where(F.col("word").isin(list(words)))
    counted = every.groupBy("word").agg(F.count(F.lit(1)).alias("n")).collect()
    return dict.fromkeys(words, 0) | {r["word"]: r["n"] for r in counted}


def notice_matches(
    docs: DataFrame, notices: Mapping[str, Sequence[str]] = NOTICES, threshold: float = THRESHOLD
) -> DataFrame:
    """From ``doc_id``, ``text`` rows: a row per match with ``doc_id``, ``content`` (the text's hash), ``block``
    (text), ``label``, ``notice`` (number), ``overlap`` and ``containment``. Every match is found.

    The notices are a handful of rows that the caller gives, so their index is broadcast.
    """
    spark = docs.sparkSession
    named = [(label, plain_words(notice)) for label, group in notices.items() for notice in group]
    universe = sorted({w for _, words in named for w in words})
    whole = docs.select("doc_id", "text", spaced_words(F.col("text")).alias("spaced"))
    counts = word_frequencies(whole, universe)
    ordered = sorted(universe, key=lambda w: (counts[w], w))
    rank = {w: i for i, w in enumerate(ordered)}
    index = []
    for number, (label, words) in enumerate(named):
        words = sorted(words, key=rank.__getitem__)
        need = math.ceil(threshold * len(words) - 1e-9)
        index += [(w, number, label, p, len(words), need, words) for p, w in enumerate(words[: len(words) - need + 1])]
    prefix_words = sorted({row[0] for row in index})
    indexed = spark.createDataFrame(
        index, "word string, notice int, label string, place int, size int, need int, words array<string>"
    )
    any_prefix = " (?:" + "|".join(prefix_words) + ") "
    text = F.col("text")
    paragraphs = F.filter(F.split(text, _PARAGRAPH_END), lambda p: F.contains(p, F.lit("\n")))
    blocks = whole.where(F.col("spaced").rlike(any_prefix)).select(
        "doc_id", F.xxhash64("text").alias("content"), F.explode(F.concat(F.split(text, "\n"), paragraphs)).alias("block")
    )
    ranks = F.create_map(*[F.lit(x) for w in ordered for x in (w, rank[w])])
    hits = (
        blocks.withColumn("spaced", spaced_words(F.col("block")))
        .where(F.col("spaced").rlike(any_prefix))
        .withColumn("words", F.array_distinct(words_of(F.col("spaced"))))
        .withColumn("common", F.array_intersect("words", _literals(ordered)))
        .withColumn("places", F.array_sort(F.transform("common", lambda w: F.element_at(ranks, w))))
        .withColumn("word", F.explode(F.array_intersect("common", _literals(prefix_words))))
    )
    at = F.array_position("places", F.element_at(ranks, F.col("word"))) - 1
    before = F.least(F.col("place"), at)
    after = F.least(F.col("size") - F.col("place") - 1, F.size("places") - at - 1)
    overlap = F.size(F.array_intersect("common", "notice_words"))
    return (
        hits.join(F.broadcast(indexed.withColumnRenamed("words", "notice_words")), "word")
        .where(F.size("words") >= F.col("need"))
        .where(before + 1 + after >= F.col("need"))
        .withColumn("overlap", overlap)
        .where("overlap >= need")
        .select(
            "doc_id",
            "content",
            "block",
            "label",
            "notice",
            "overlap",
            (F.col("overlap") / F.col("size")).alias("containment"),
        )
    )


def scan(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_words``, ``n_base``, ``first_word``, ``last_word``,
    ``base_labels``, ``labels`` (sorted arrays) and ``score``: 1 with a phrase, else the largest containment, else 0.

    Null counts as empty: no words, no labels, null places. Repeated rows get the same result each. An
    empty table gives no rows; other columns are not read. Matches meet the documents by id and the text's
    hash, broadcast behind a count.
    """
    slim = docs.select(F.col(doc_id).alias("doc_id"), text_or_empty(text).alias("text"))
    found = staged(
        notice_matches(slim)
        .groupBy("doc_id", "content")
        .agg(F.collect_set("label").alias("found"), F.max("containment").alias("containment")),
        "license-matches",
    )
    hinted = broadcast_if_small(found.withColumnsRenamed({"doc_id": "found_id", "content": "found_content"}))
    spaced = F.col("spaced")
    n_words = (F.regexp_count(spaced, F.lit(" ")) - 1).cast("long")
    base = (
        slim.select("doc_id", F.xxhash64("text").alias("content"), spaced_words(F.col("text")).alias("spaced"))
        .withColumn("n_words", n_words)
        .withColumns(phrase_places(spaced, F.col("n_words")))
        .drop("spaced")
    )
    same = F.col("doc_id").eqNullSafe(F.col("found_id")) & (F.col("content") == F.col("found_content"))
    every = F.array_distinct(F.concat("base_labels", F.coalesce("found", F.array().cast("array<string>"))))
    score = F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce("containment", F.lit(0.0)))
    return base.join(hinted, same, "left").select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_sort("base_labels").alias("base_labels"),
        F.array_sort(every).alias("labels"),
        score.alias("score"),
    )
