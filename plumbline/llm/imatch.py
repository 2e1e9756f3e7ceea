"""I-Match document fingerprints.

The lexicon holds the terms whose inverse document frequency lies in a band: frequent enough to be no
accident, rare enough to say something. A text's distinct lexicon terms, sorted, are hashed whole and
for several random subsets of the lexicon, thinner and thinner, so that texts of any length have some
subsets with a few of their terms. Texts are alike as far as their subset hashes agree.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.common import plain_words, text_of
from plumbline.session import materialize

# Band of inverse document frequency, ln(texts / texts with the term): 10 % down to 0.5 % of the texts.
LEAST_IDF, MOST_IDF = math.log(10), math.log(200)
# Subsets keep one in 2 ** level of the lexicon; so many subsets of each level.
LEVELS, SUBSETS = (1, 3, 5, 7, 9), 7
# Share of a level's subsets that must hold terms before the level counts.
LIVE = 3


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _numbers(values: list) -> Column:
    """A constant array, given as one literal; Spark folds it once."""
    kind = "array<double>" if values and isinstance(values[0], float) else "array<bigint>"
    if not values:
        return F.array().cast(kind)
    return F.split(F.lit(",".join(map(repr, values))), ",").cast(kind)


def terms_of(text: Column) -> Column:
    """Distinct hashed words of a text; none for an empty one."""
    words = F.array_distinct(F.split(plain_words(text), " "))
    return F.transform(F.filter(words, lambda w: w != ""), lambda w: F.xxhash64(w))


def build_lexicon(docs: DataFrame, text: str = "text", least: float = LEAST_IDF,
                  most: float = MOST_IDF) -> list[int]:
    """Sorted hashes of the terms in the band, counted over all texts.

    A term of the band is in at least a share exp(-most) of the texts, so with d distinct terms in a mean
    text the lexicon has at most d exp(most) terms, however many texts there are.
    """
    terms = docs.select(F.explode(terms_of(text_of(text))).alias("term"))
    n = docs.count()
    found = terms.groupBy("term").agg(F.count(F.lit(1)).alias("seen")).where(
        F.log(F.lit(float(max(1, n))) / F.col("seen")).between(least, most)).select("term")
    return sorted(r["term"] for r in found.collect())


def fingerprint(terms: Column, lexicon: list[int]) -> Column:
    """Array of 1 + LEVELS x SUBSETS hashes: of all lexicon terms, then level by level of every subset.

    A subset without any of the terms has hash 0. A text without lexicon terms has the hash of all its
    terms in the first place, so it only equals texts of the same terms; without any word that is 0 too.
    """
    hashed = lambda items: F.when(F.size(items) == 0, F.lit(0).cast("bigint")).otherwise(
        F.xxhash64(items))
    # A constant set: each term is looked up, whatever the size of the lexicon. Spark numbers it once.
    in_band = lambda t: t.isin(*lexicon) if lexicon else F.lit(False)
    masks = _numbers([(1 << level) - 1 for level in LEVELS])

    def thinned(kept: Column, seed: Column) -> Column:
        drawn = F.transform(kept, lambda t: F.xxhash64(t, seed))

        def step(state: Column, mask: Column) -> Column:
            return _let(F.filter(state["left"], lambda h: h.bitwiseAND(mask) == 0),
                        lambda left: F.struct(left.alias("left"), F.array_append(
                            state["hashes"], hashed(left)).alias("hashes")))

        start = F.struct(drawn.alias("left"), F.array().cast("array<bigint>").alias("hashes"))
        return F.aggregate(masks, start, step)["hashes"]

    def whole(every: Column, kept: Column) -> Column:
        first = F.when(F.size(kept) > 0, hashed(kept)).otherwise(_let(F.array_sort(every), hashed))
        return F.concat(F.array(first), F.flatten(F.transform(
            _numbers(list(range(SUBSETS))), lambda seed: thinned(kept, seed))))

    return _let(terms, lambda every: _let(
        F.array_sort(F.filter(every, in_band)), lambda kept: whole(every, kept)))


def fingerprint_text(hashes: Column) -> Column:
    """Eight hexadecimal digits for each hash."""
    return F.array_join(F.transform(
        hashes, lambda h: F.lpad(F.lower(F.hex(h.bitwiseAND(F.lit(0xFFFFFFFF)))), 8, "0")), "")


def likeness(one: Column, other: Column) -> Column:
    """0 to 1: 1 for equal fingerprints, else the greatest share of a level's subsets that agree, among
    those with terms of either text; levels with fewer than LIVE of those do not count."""
    pairs = F.zip_with(one, other, lambda a, b: F.struct(
        ((a == b) & (a != 0)).cast("int").alias("same"), ((a != 0) | (b != 0)).cast("int").alias("live")))

    def level(pairs: Column, at: int) -> Column:
        mine = F.filter(pairs, lambda p, i: (i > 0) & ((i - 1) % len(LEVELS) == at))
        total = lambda name: F.aggregate(mine, F.lit(0), lambda n, p: n + p[name])
        return F.when(total("live") >= LIVE, total("same") / total("live")).otherwise(F.lit(0.0))

    return F.when(one == other, F.lit(1.0)).otherwise(_let(
        pairs, lambda p: F.greatest(*[level(p, at) for at in range(len(LEVELS))])))


def range_buckets(docs: DataFrame, by: str, buckets: int) -> Column:
    """Bucket number of each value of a numeric column: ranges of about equal counts, null in 0."""
    share = [i / buckets for i in range(1, buckets)]
    bounds = docs.agg(F.percentile_approx(by, share, 10 * buckets).alias("b")).first()["b"] or []
    if not bounds:
        return F.lit(0)
    # Binary search: the number of bounds at or below the value.
    literal = _numbers(list(bounds))
    steps = _numbers([1 << k for k in reversed(range(len(bounds).bit_length()))])
    found = F.aggregate(steps, F.lit(0).cast("bigint"), lambda at, step: F.when(
        F.get(literal, (at + step - 1).cast("int")) <= F.col(by), at + step).otherwise(at))
    return F.coalesce(found, F.lit(0)).cast("int")


def compare_with_edits(docs: DataFrame, lexicon: list[int], text: str = "text") -> DataFrame:
    """doc_id, n_chars, edited text, and the fingerprints of text, edited text and the next document.

    The edited text has the last quarter of the code points replaced by the first as many (or all) of
    the next document in order of doc_id; after the last comes the first. A null doc_id comes first, equal
    ones are ordered by their texts' hash. Null texts are empty. A single document follows itself.

    Documents are ranged by doc_id with one shuffle; each range gets a copy of the following range's
    first document, so the next one is always at hand.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    slim = docs.select("doc_id", text_of(text).alias("text"))
    placed = slim.withColumn("bucket", range_buckets(slim.select("doc_id"), "doc_id", 4 * parts)) \
        .withColumn("tie", F.xxhash64("text"))
    rank = F.struct(F.coalesce(F.col("doc_id").isNotNull().cast("int"), F.lit(0)).alias("known"),
                    "doc_id", "tie")
    # One row per range: its first document goes to the range before, the first range's to the last.
    firsts = placed.groupBy("bucket").agg(F.min_by(F.struct("doc_id", "text", "tie"), rank).alias("f"))
    ranges = Window.partitionBy().orderBy("bucket")
    around = materialize(firsts, "imatch-firsts")
    last = around.agg(F.max("bucket").alias("b")).first()["b"]
    # The range before each; only range numbers are ordered together, the texts stay where they are.
    before = around.select("bucket", F.coalesce(
        F.lag("bucket").over(ranges), F.lit(last)).cast("int").alias("before"))
    ahead = around.join(before, "bucket").select(F.col("before").alias("bucket"), "f.*", F.lit(1).alias("copy"))
    every = placed.withColumn("copy", F.lit(0)).unionByName(ahead) \
        .withColumn("print", fingerprint(terms_of(F.col("text")), lexicon))
    order = Window.partitionBy("bucket").orderBy("copy", F.col("doc_id").asc_nulls_first(), "tie")
    n = F.length("text")
    cut = F.floor(n / 4).cast("int")
    rows = every.withColumn("next_text", F.lead("text").over(order)) \
        .withColumn("next_print", F.lead("print").over(order)).where(F.col("copy") == 0)
    return rows.select(
        "doc_id", n.cast("long").alias("n_chars"), "print", "next_print",
        F.concat(F.substr("text", F.lit(1), n - cut), F.substr("next_text", F.lit(1), cut)).alias("edited"))


def edited_fingerprints(docs: DataFrame, text: str = "text") -> DataFrame:
    """Fingerprints of all texts and their edited texts, with the likeness to the edited text's and to
    the next document's. Other columns of ``docs`` are ignored; an empty table gives an empty result."""
    lexicon = build_lexicon(docs, text)
    compared = compare_with_edits(docs, lexicon, text)
    printed = compared.withColumn("edited_print", fingerprint(terms_of(F.col("edited")), lexicon))
    return printed.select(
        "doc_id", "n_chars", "edited", fingerprint_text(F.col("print")).alias("fingerprint"),
        fingerprint_text(F.col("edited_print")).alias("edited_fingerprint"),
        likeness(F.col("print"), F.col("edited_print")).alias("near_edited"),
        likeness(F.col("print"), F.col("next_print")).alias("near_next"))
