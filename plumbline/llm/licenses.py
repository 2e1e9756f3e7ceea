"""License scan: exact set-similarity join of text blocks with license notices.

A block is a window of ``BLOCK`` words, one beginning every ``STEP`` words, so any passage of up to
``STEP`` words lies whole in some block. Longer notices, whole licenses among them, have blocks of their
own, twice as long and as far apart again and again until the step holds them. A notice is found in a block
that holds at least ``THRESHOLD`` of its distinct words. The join is exact:

- notice words are ordered by how often they occur in the whole corpus, rarest first;
- prefix filter: of n words, more than (1 - threshold) n must be missed to fail, so a block that
  reaches the threshold holds at least one of the notice's rarest n - ceil(threshold n) + 1 words;
- length filter: a block with fewer words than ceil(threshold n) cannot reach it;
- positional filter: from a prefix word on, the words still to come on either side bound the overlap.

Only rows of words that occur in some notice ever leave the scan.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import plain_words, text_of, word_count
from plumbline.session import materialize

BLOCK, STEP = 64, 32
THRESHOLD = 0.9
# Phrases of the contract and their labels (fixed values).
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
# Notices by label, in normalised words (well-known public wordings).
NOTICES = (
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this "
            "software and associated documentation files"),
    ("apache", "licensed under the apache license version 2 0"),
    ("apache", "you may not use this file except in compliance with the license you may obtain a "
               "copy of the license at"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "you can redistribute it and or modify it under the terms of the gnu general public "
            "license as published by the free software foundation"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are "
            "permitted provided that the following conditions are met"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc-by-nc", "licensed under the creative commons attribution noncommercial license"),
    ("cc0", "dedicated to the public domain under the cc0 waiver"),
    ("mpl", "subject to the terms of the mozilla public license v 2 0"),
    ("proprietary", "proprietary and confidential all rights reserved"),
)


def phrase_places(spaced: Column, phrase: str) -> tuple[Column, Column, Column]:
    """Count, first and last start (in words) of a phrase in a text of ``plain_words``."""
    padded = F.concat(F.lit(" "), spaced, F.lit(" "))
    there = F.contains(padded, F.lit(f" {phrase} "))
    pieces = F.split(padded, f" {phrase}(?= )")
    spaces = lambda text: F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))
    count = F.when(there, F.size(pieces) - 1).otherwise(F.lit(0)).cast("long")
    first = F.when(there, spaces(pieces[0])).cast("long")
    after = spaces(F.element_at(pieces, -1)) - 1
    last = F.when(there, word_count(spaced) - after - len(phrase.split())).cast("long")
    return count, first, last


def notice_index(seen: Mapping[str, int], notices: Sequence[tuple[str, str]], threshold: float):
    """The notices' words, rarest first, and per notice (label, its words in that order, needed).

    ``seen`` counts texts by word; it has at most one entry per word of the fixed notices.
    """
    members = [(label, set(notice.split())) for label, notice in notices]
    order = sorted(set().union(*[w for _, w in members]), key=lambda w: (seen.get(w, 0), w))
    return order, [(label, [w for w in order if w in words], math.ceil(threshold * len(words) - 1e-9))
                   for label, words in members]


def step_of(words: int) -> int:
    """The step between blocks for a notice of so many words: STEP, doubled until the notice fits."""
    step = STEP
    while step < words:
        step *= 2
    return step


def _links(scanned: DataFrame, step: int, indexed: Mapping[int, tuple], order: list[str]) -> DataFrame:
    """Blocks of one step that reach the threshold of a notice; ``scanned`` has doc_id, text_key, spaced."""
    literal = lambda items: F.array(*[F.lit(i) for i in items])
    prefixes = {number: words[:len(words) - needed + 1] for number, (_, words, needed) in indexed.items()}
    index = scanned.sparkSession.createDataFrame(
        [(token, number, label, at, len(words), needed, words)
         for number, (label, words, needed) in indexed.items()
         for at, token in enumerate(prefixes[number])],
        "token string, notice int, label string, at int, n_notice int, needed int, members "
        "array<string>")
    starts = F.sequence(F.lit(0), F.call_function("div", F.size("words") - 1, F.lit(step)).cast("int"))
    least = min(needed for _, _, needed in indexed.values())
    of_notices = {w for _, words, _ in indexed.values() for w in words}
    blocks = scanned.withColumn("words", F.split("spaced", " ")) \
        .where(F.arrays_overlap("words", literal(sorted({t for p in prefixes.values() for t in p})))) \
        .select("doc_id", "text_key", "words", F.explode(starts).alias("block")) \
        .withColumn("words", F.slice("words", F.col("block") * step + 1, step * BLOCK // STEP)) \
        .select("doc_id", "text_key", "block", F.size("words").alias("n_block"),
                F.array_intersect(literal([w for w in order if w in of_notices]), "words").alias("tokens")) \
        .where(F.size("tokens") >= least)
    ahead = F.least(F.col("n_notice") - F.col("at"), F.size("tokens") - F.col("b"))
    return blocks.select("*", F.posexplode("tokens").alias("b", "token")) \
        .join(F.broadcast(index), "token") \
        .where((F.col("n_block") >= F.col("needed")) & (ahead >= F.col("needed"))) \
        .withColumn("common", F.size(F.array_intersect("tokens", "members"))) \
        .where(F.col("common") >= F.col("needed")) \
        .select("doc_id", "text_key", F.lit(step).alias("step"), "block", "notice", "label",
                (F.col("common") / F.col("n_notice")).alias("containment")).distinct()


def scan_licenses(
    docs: DataFrame, notices: Sequence[tuple[str, str]] = NOTICES, threshold: float = THRESHOLD,
    phrases: Mapping[str, str] = PHRASES, text: str = "text",
) -> tuple[DataFrame, DataFrame]:
    """Returns (documents, links).

    ``documents``: one row per row of ``docs``: doc_id, n_words, n_base, first_word, last_word,
    base_labels, labels (comma-joined), score (the greatest containment found, 1 for a phrase, else 0).
    ``links``: doc_id, text_key, step, block, label, notice and containment of every block at or above the
    threshold; block n of a step begins with word n times the step. Notices may have any length. Rows with
    the same doc_id and text share their links. Null and empty texts have no words, no labels and score 0.
    Other columns of ``docs`` are ignored, so names never clash.
    """
    vocabulary = sorted({w for _, notice in notices for w in notice.split()})
    literal = lambda items: F.array(*[F.lit(i) for i in items])

    scanned = docs.select("doc_id", F.xxhash64(F.col(text).cast("string")).alias("text_key"),
                          plain_words(text_of(text)).alias("spaced"))
    found = [phrase_places(F.col("spaced"), p) for p in phrases]
    total = sum((count for count, _, _ in found), F.lit(0).cast("long"))
    base = materialize(scanned.select(
        "doc_id", "text_key", word_count(F.col("spaced")).alias("n_words"), total.alias("n_base"),
        F.least(*[f for _, f, _ in found]).alias("first_word"),
        F.greatest(*[f for _, _, f in found]).alias("last_word"),
        F.array_sort(F.array_distinct(F.array_compact(F.array(*[
            F.when(count > 0, F.lit(label)) for (count, _, _), label in zip(found, phrases.values())
        ])))).alias("base"),
        F.array_intersect(F.split("spaced", " "), literal(vocabulary)).alias("tokens")), "license-base")

    # Global order. One row per word of the fixed notices comes back, however many texts there are.
    seen = dict(base.select(F.explode("tokens").alias("token")).groupBy("token").count().collect())
    order, indexed = notice_index(seen, notices, threshold)
    by_step: dict[int, list[int]] = {}
    for number, (_, notice) in enumerate(notices):
        by_step.setdefault(step_of(len(notice.split())), []).append(number)
    found = [_links(scanned, step, {n: indexed[n] for n in numbers}, order) for step, numbers in by_step.items()]
    links = materialize(reduce(DataFrame.unionByName, found), "license-links")

    per_text = links.groupBy(F.col("doc_id").alias("l_doc"), F.col("text_key").alias("l_key")).agg(
        F.collect_set("label").alias("found"), F.max("containment").alias("best"))
    documents = base.join(
        per_text, F.col("doc_id").eqNullSafe(F.col("l_doc")) & F.col("text_key").eqNullSafe(F.col("l_key")),
        "left")
    nothing = F.array().cast("array<string>")
    documents = documents.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.array_join("base", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base", F.coalesce("found", nothing))), ",")
        .alias("labels"),
        F.greatest(F.coalesce("best", F.lit(0.0)), F.when(F.col("n_base") > 0, F.lit(1.0)))
        .alias("score"))
    return documents, links
