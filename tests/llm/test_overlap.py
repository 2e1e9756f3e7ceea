"""The exact join of shingle sets against brute force over all pairs, and planted near copies."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from plumbline.llm import overlap

SF = "/root/testdata/sf0.001"


def five_word(text):
    words = (text or "").encode().lower().split()
    return frozenset(b" ".join(words[i:i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def alike(a, b):
    return a == b or 10 * len(a & b) >= 8 * len(a | b)


def kept_by_all_pairs(texts):
    """The least id of each component, by comparing every pair."""
    ids = sorted(texts)
    sets = {i: five_word(texts[i]) for i in ids}
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for n, i in enumerate(ids):
        for j in ids[n + 1:]:
            if alike(sets[i], sets[j]):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {i for i in ids if find(i) == i}


def copies(seed):
    """Texts, and copies of copies with words changed, so that similarities lie on both sides of 0.8."""
    rng = np.random.default_rng(seed)
    words = [f"w{n}" for n in range(3000)]
    line = " ".join(rng.choice(words, 30))  # a passage that many texts share
    made = []
    for _ in range(30):
        made.append(rng.choice(words, int(rng.integers(3, 300))).tolist() + line.split() * int(rng.integers(0, 2)))
    for _ in range(150):
        one = list(made[int(rng.integers(0, len(made)))])
        for at in rng.integers(0, len(one), int(rng.integers(0, 1 + len(one) // 20))):
            one[at] = str(rng.choice(words))
        made.append(one[int(rng.integers(0, 3)):])
    return {n: " ".join(w) for n, w in enumerate(made)}


@pytest.mark.parametrize("bucket", [8192, 8])
def test_all_pairs_that_reach_the_index_are_joined(spark, monkeypatch, bucket):
    monkeypatch.setattr(overlap, "BUCKET", bucket)
    texts = copies(3)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r["doc_id"] for r in overlap.drop_near_copies(docs).collect()}
    wanted = kept_by_all_pairs(texts)
    assert got == wanted and 20 < len(wanted) < 170


def test_stage_drops_planted_near_copies_and_keeps_what_is_less_alike(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    texts = dict(rows)
    long = [i for i in sorted(texts) if len((texts[i] or "").split()) >= 60][:40]
    for n, i in enumerate(long):
        words = texts[i].split()
        words[len(words) // 2] = "planted"
        texts[10_000 + n] = " ".join(words)  # at least 51 of 61 shingles
        texts[20_000 + n] = " ".join(words[: len(words) * 7 // 10])  # at most 0.7
    schema = spark.read.parquet(f"{SF}/documents.parquet").schema
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in texts.items()], schema)
    got = {r["doc_id"] for r in corpus_pipeline.drop_near_duplicates(spark, docs, SF).collect()}
    assert got == kept_by_all_pairs(texts)
    assert not got & set(range(10_000, 10_000 + len(long)))


def test_near_copies_of_odd_rows(spark):
    rows = [(1, None, 7), (2, "", 7), (2, " \n", 7), (None, "one two", 7), (9, "ONE two", 7), (3, "x " * 30000, 7),
            (4, "a b c d e"), (4, "a b c d e"), (5, "A b c\td e")]
    docs = spark.createDataFrame([(*r, 7)[:3] for r in rows], "doc_id long, text string, fp long")
    kept = overlap.drop_near_copies(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 3, 4, 9]
    assert overlap.drop_near_copies(docs.limit(0)).collect() == []
    assert overlap.drop_near_copies(docs.where(F.col("text") == "")).count() == 1


def test_fingerprints_find_links_that_are_checked(spark, monkeypatch):
    rng = np.random.default_rng(5)
    base = rng.choice([f"w{n}" for n in range(3000)], 400).tolist()
    texts = {0: base, 1: base[1:], 2: base + ["more"], 4: rng.choice(["a", "b", "c"], 50).tolist()}
    docs = spark.createDataFrame([(n, " ".join(t)) for n, t in texts.items()], "doc_id long, text string")
    asked = []
    linked = overlap.near_links

    def spied(prints):
        asked.append(prints.count())
        return linked(prints)

    monkeypatch.setattr(overlap, "near_links", spied)
    # With the exact join shut, the fingerprints alone join what is nearly equal.
    with monkeypatch.context() as shut:
        shut.setattr(overlap, "proposed", lambda buckets, full: spark.createDataFrame([], "a long, b long"))
        assert {r["doc_id"] for r in overlap.drop_near_copies(docs).collect()} == {0, 4}
    assert 2 <= asked[0] <= 4
    # Fingerprints that are equal by force are candidates only: unlike texts stay apart.
    monkeypatch.setattr(overlap, "majority", lambda hashes: 7)
    assert {r["doc_id"] for r in overlap.drop_near_copies(docs).collect()} == {0, 4}


def test_long_rows_go_to_workers_in_small_batches(spark, monkeypatch):
    limits = ("spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch")
    before, seen, write = [spark.conf.get(name) for name in limits], set(), overlap.materialize

    @F.arrow_udf("int")
    def rows(column: pa.Array) -> pa.Array:
        return pa.array([len(column)] * len(column), pa.int32())

    def spied(df, name):
        # What a worker gets of 2,500 rows while the stage runs.
        seen.add(max(r[0] for r in spark.range(0, 2500, 1, 1).select(rows("id")).collect()))
        return write(df, name)

    monkeypatch.setattr(overlap, "materialize", spied)
    docs = spark.createDataFrame([(1, "a b c d e f"), (2, "a b c d e f"), (3, "g")], "doc_id long, text string")
    assert {r["doc_id"] for r in overlap.drop_near_copies(docs).collect()} == {1, 3}
    assert seen == {1000}
    assert [spark.conf.get(name) for name in limits] == before
