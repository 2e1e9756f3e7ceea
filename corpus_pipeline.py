"""Preparing a training corpus from ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read
again as the next stage's documents. Every stage but the last keeps the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm import decontam, mixing, overlap, pii, toxicity
from plumbline.llm.common import table
from plumbline.session import materialize


def _recounted(docs: DataFrame) -> DataFrame:
    """``n_chars`` follows the text; null for a null text."""
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression distance scores below one half."""
    return toxicity.drop_toxic(docs, toxicity.train_toxicity(docs, table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts linked by five-word shingles alike to 0.8 or more, the one with
    the smallest doc_id. SimHash fingerprints and their pivot tables find links, as in op3, here of five-word
    shingles and checked exactly; an exact join of the shingle sets adds the pairs they are too far apart for."""
    return overlap.drop_near_copies(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without benchmark passages; documents that are mostly such passages go."""
    return _recounted(decontam.remove_contamination(docs, table(spark, sf_dir, "benchmark")))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced by its kind."""
    return _recounted(pii.mask_personal_data(docs))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mix takes words from, with size, source_size, target and taken words."""
    return mixing.mix_sources(docs).where(F.col("taken") > 0)


STAGES = [
    ("toxicity", drop_toxic),
    ("near-duplicates", drop_near_duplicates),
    ("decontamination", decontaminate),
    ("personal data", mask_personal_data),
    ("mixing", mix),
]

# The stages learn models and follow chains of links, which SQL cannot express; the tests hold the
# result against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
