"""Phrase collocations against plain counting, with edge cases and any sharing of counters."""

import collections
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline.llm import collocations
from plumbline.llm.collocations import mine_collocations

NAMES = "lang string, text string"


def plain(rows, least, held=80, best=2000):
    """Every phrase counted in a dictionary."""
    found, totals = collections.Counter(), collections.Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", lowered):
            words = [w for w in re.split("[ \t]+", piece) if w]
            totals[lang] += len(words)
            for size in (1, 2, 3, 4):
                for i in range(len(words) - size + 1):
                    found[lang, tuple(words[i:i + size])] += 1
    frequent = {k: n for k, n in found.items() if len(k[1]) > 1 and n >= least}
    around = collections.defaultdict(int)
    for (lang, words), n in frequent.items():
        for size in range(2, len(words)):
            for i in range(len(words) - size + 1):
                key = lang, words[i:i + size]
                around[key] = max(around[key], n)
    rows = collections.defaultdict(list)
    for (lang, words), a in frequent.items():
        if 100 * around[lang, words] >= held * a:
            continue
        cuts = [(2_000_000 * a // (found[lang, words[:k]] + found[lang, words[k:]]), k) for k in range(1, len(words))]
        score, k = min(cuts)
        rows[lang].append((-score, -a, " ".join(words).encode(), found[lang, words[:k]], found[lang, words[k:]]))
    return {(lang, rank, p.decode(), -a, l, r, totals[lang], -s) for lang, ranked in rows.items()
            for rank, (s, a, p, l, r) in enumerate(sorted(ranked)[:best], 1)}


def mined(docs, **options):
    found = mine_collocations(docs, **options)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return [tuple(r) for r in found.collect()]


def some_rows(seed, n=120):
    rng = random.Random(seed)
    vocabulary = ["a", "b", "C", "d", "É", "é", "x" * 300, "東京", "don't"]
    rows = []
    for _ in range(n):
        words = [rng.choice(vocabulary) + rng.choice(["", "", "", "", ".", ",", "\n", "\t"])
                 for _ in range(rng.randint(0, 40))]
        rows.append((rng.choice(["en", "en", "de", None]), rng.choice([" ", "  "]).join(words)))
    return rows + [("en", None), ("de", ""), (None, " .,; \n"), ("fr", "a b"), ("en", "a b C d " * 4000)]


@pytest.mark.parametrize("least", [2, 5, 30])
def test_equals_plain_counting(spark, least):
    rows = some_rows(least)
    docs = spark.createDataFrame(rows, NAMES).repartition(5)
    found = mined(docs, least=least)
    assert len(found) == len(set(found)) and set(found) == plain(rows, least)


def test_ranks_stop_at_the_best_and_ties_go_by_phrase(spark):
    rows = [("en", phrase) for phrase in ("zz yy", "bb ab", "aa cc", "é w", "q v")] * 3
    found = mined(spark.createDataFrame(rows, NAMES), least=3, best=4)
    assert sorted(r[1:3] for r in found) == [(1, "aa cc"), (2, "bb ab"), (3, "q v"), (4, "zz yy")]
    assert set(found) == plain(rows, 3, best=4)


@pytest.mark.parametrize("size", [0, 1, 4])
def test_words_outside_the_vocabulary_count_alike(spark, monkeypatch, size):
    monkeypatch.setattr(collocations, "VOCABULARY", size)
    rows = some_rows(9)
    docs = spark.createDataFrame(rows, NAMES).repartition(3)
    assert set(mined(docs, least=10)) == plain(rows, 10)


def test_hot_pairs_dealt_by_their_third_word(spark, monkeypatch):
    monkeypatch.setattr(collocations, "HOT_SHARE", 1e-9)
    monkeypatch.setattr(collocations, "REPORTED_SHARE", 1e-9)
    monkeypatch.setattr(collocations, "VOCABULARY", 6)
    rows = some_rows(6)
    assert set(mined(spark.createDataFrame(rows, NAMES).repartition(2), least=8)) == plain(rows, 8)


def test_a_hot_language_many_parts_and_repeated_rows(spark, monkeypatch):
    rows = [("en", f"common phrase here number{i % 7}. of the") for i in range(900)] + some_rows(3, 40)
    docs = spark.createDataFrame(rows, NAMES).repartition(4)
    assert set(mined(docs, least=30)) == plain(rows, 30)


def test_empty_table_extra_and_clashing_columns(spark):
    empty = spark.createDataFrame([], NAMES)
    assert mined(empty) == []
    rows = [("en", "one two. one two")] * 3
    docs = spark.createDataFrame(rows, NAMES)
    for name in ("phrase", "W1", "n", "size", "F", "rank", "a", "score"):
        docs = docs.withColumn(name, F.lit("x"))
    assert set(mined(docs, least=4)) == plain(rows, 4)


def test_a_text_larger_than_a_part(spark, monkeypatch):
    part = collocations.Part([b"One two", b"", b"three, Two"], np.array([0, 0, 1]))
    assert part.entry_words().to_pylist() == ["one", "two", "two", "three"]
    assert part.entry_langs().tolist() == [0, 0, 1, 1] and part.entries.tolist() == [0, 1, 3, 2]
    assert part.follows.tolist() == [True, False, False, False]
    rows = [("en", "long text of words " * 300_000), ("en", "short")]  # over PART_BYTES
    assert set(mined(spark.createDataFrame(rows, NAMES))) == plain(rows, 30)
