"""Every operator beside extra columns with the names of its own columns, in small and capital letters."""

import inspect
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from plumbline.llm import (
    chat, collocations, common, decontam, imatch, licenses, mixing, overlap, pii, secrets, simhash, suffix, toxicity,
    trie, urls,
)

SF = "/root/testdata/sf0.001"
TEXTS = [(1, "one two three four five six. one two three", "en"), (2, "ONE two three four five six", None),
         (2, "mail bo@example.com token = abcdef12", "de"), (None, None, "de"), (4, "mit license applies", "en")]
PAGES = [(1, "http://www.example.com/en/a?b"), (2, "https://ads.spam.net/login"), (3, None)]
TURNS = [(1, 0, "user", "hi"), (1, 1, "assistant", "yes"), (2, 0, "user", "hi"), (None, None, None, None)]


def docs(spark):
    return spark.createDataFrame(TEXTS, "doc_id long, text string, lang string").withColumn(
        "source", F.lit("s")).withColumn("n_chars", F.length("text").cast("long"))


def turns(spark):
    return spark.createDataFrame(TURNS, "conv_id long, turn long, role string, text string")


def log(spark):
    return turns(spark).select("*", F.coalesce("turn", F.lit(0)).alias("seq"), F.lit("message").alias("kind"))


def table(spark, name):
    return spark.read.parquet(f"{SF}/{name}.parquet")


# Operator: its module, its input, and the result with some columns that the extra ones have no say in.
OPERATORS = {
    "mixing": (mixing, docs, lambda s, d: mixing.mix_sources(d).select("doc_id", "size", "target", "source_size")),
    "pii": (pii, docs, lambda s, d: pii.find_personal_data(d).select("doc_id", "pii")),
    "masking": (pii, docs, lambda s, d: pii.mask_personal_data(d).select("doc_id", "text")),
    "simhash": (simhash, docs, lambda s, d: simhash.near_duplicates(d).select("doc_id", "fingerprint", "component_id")),
    "fold": (chat, log, lambda s, d: chat.fold_events(d)),
    "render": (chat, turns, lambda s, d: chat.render(d)),
    "toxicity": (toxicity, docs, lambda s, d: toxicity.score_toxicity(
        d, toxicity.train_toxicity(table(s, "documents"), table(s, "labels"))).select("doc_id", "score")),
    "decontam": (decontam, docs, lambda s, d: decontam.find_contamination(d, table(s, "benchmark")).select(
        "doc_id", "hits.n_words")),
    "cleaning": (decontam, docs, lambda s, d: decontam.remove_contamination(d, table(s, "benchmark")).select(
        "doc_id", "text")),
    "imatch": (imatch, docs, lambda s, d: imatch.edited_fingerprints(d).select("doc_id", "fingerprint", "n_chars")),
    "suffix": (suffix, docs, lambda s, d: suffix.drop_repeats(d).select("doc_id", "spans", "kept")),
    "urls": (urls, lambda s: s.createDataFrame(PAGES, "page_id long, url string"),
             lambda s, d: urls.judge_urls(d).select("page_id", "host", "path", "rule", "verdict")),
    "licenses": (licenses, docs, lambda s, d: licenses.scan_licenses(d)[0].select("doc_id", "n_words", "labels")),
    "overlap": (overlap, docs, lambda s, d: overlap.drop_near_copies(d).select("doc_id", "text")),
    "trie": (trie, turns, lambda s, d: trie.prefix_trie(trie.conversation_paths(d))),
    "collocations": (collocations, docs, lambda s, d: collocations.mine_collocations(d, least=2)),
    "secrets": (secrets, docs, lambda s, d: secrets.find_secrets(d).select("doc_id", "secrets.kind", "secrets.begin")),
    "pipeline": (corpus_pipeline, docs, lambda s, d: corpus_pipeline.drop_near_duplicates(s, d, SF).select("doc_id")),
}


def rows_of(frame):
    return sorted(map(repr, (r.asDict(recursive=True) for r in frame.collect())))


@pytest.mark.parametrize("name", OPERATORS)
def test_extra_columns_have_no_say(spark, name):
    module, make, apply = OPERATORS[name]
    given = make(spark)
    names = set(re.findall(r'"([A-Za-z_][A-Za-z0-9_]*)"', inspect.getsource(module) + inspect.getsource(common)))
    taken = {c.lower() for c in given.columns}
    extra = sorted({n.lower() for n in names} - taken)
    cased = [n.capitalize() if i % 2 else n for i, n in enumerate(extra)]
    clashing = given.select("*", *[F.lit("extra").alias(c) for c in cased])
    assert rows_of(apply(spark, clashing)) == rows_of(apply(spark, given))
