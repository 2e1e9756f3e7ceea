"""Filing tables and the files passed between flatten, scoring and review."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline import names
from plumbline.functions.expressions import calendar_quarter, col
from plumbline.sinks.outputs import CSV_OPTIONS, unescape_lines
from plumbline.sources.records import read_records


def load_filings_table(
    filings: DataFrame, form_type: str = names.DEFAULT_FORM, form_column: str = "form",
) -> DataFrame:
    """Filings of one form; the filter reaches the scan. `form` becomes `form_type` unless taken."""
    kept = filings.where(col(form_column) == form_type)
    if "form_type" in filings.columns:
        return kept
    return kept.withColumnRenamed(form_column, "form_type")


def save_filings_table(
    filings: DataFrame, table: str, path: str | None = None, form_column: str = "form",
    period: str = names.PERIOD,
) -> DataFrame:
    """Save filings as a table in folders by form and calendar quarter of their period.

    Rows of a folder are spread over as many tasks as they need. A table of that name is replaced.
    """
    quartered = filings.withColumn("calendar_quarter", calendar_quarter(col(period)))
    writer = quartered.hint("rebalance", col(form_column), F.col("calendar_quarter")).write \
        .mode("overwrite").format("parquet").partitionBy(form_column, "calendar_quarter")
    (writer.option("path", path) if path else writer).saveAsTable(table)
    return filings.sparkSession.table(table)


def filings_of_quarters(filings: DataFrame, quarters: DataFrame, form_type: str = names.DEFAULT_FORM,
                        form_column: str = "form") -> DataFrame:
    """Filings of one form in the quarters of a (filtered) table with a column `calendar_quarter`.

    The form is pruned when the query is planned; the quarters, one row each and so few, are broadcast and
    prune the folders when it runs.
    """
    wanted = quarters.select("calendar_quarter").distinct()
    return load_filings_table(filings, form_type, form_column).join(
        F.broadcast(wanted), "calendar_quarter", "left_semi")


def discover_features(df: DataFrame) -> list[str]:
    """Numeric columns that are not metadata, in column order; booleans are not numeric."""
    excluded = {*names.NOT_FEATURES, *names.BUNDLE_BOOKKEEPING}
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.NumericType) and f.name not in excluded]


def write_features(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Flat features as parquet, or as JSON lines with ISO dates for exchange."""
    if fmt == "json":
        df.write.option("dateFormat", "yyyy-MM-dd").option("ignoreNullFields", False).json(path)
    else:
        df.write.format(fmt).save(path)


def read_features(spark: SparkSession, path: str, schema=None, fmt: str = "parquet") -> DataFrame:
    """Flat features; records JSON may be one array or lines, of any size, and needs its schema."""
    if fmt != "json":
        return spark.read.format(fmt).load(path)
    return read_records(spark, path, schema)


def read_feature_lines(spark: SparkSession, path: str, schema) -> DataFrame:
    """Flat features written as JSON lines, split across tasks within a file."""
    return spark.read.schema(schema).json(path)


def write_feature_keys(spark: SparkSession, features: Sequence[str], path: str) -> None:
    feature_keys_frame(spark, features).coalesce(1).write.json(path)


def feature_keys_frame(spark: SparkSession, features: Sequence[str]) -> DataFrame:
    return spark.createDataFrame(list(enumerate(features)), "position int, key string")


def read_feature_keys(spark: SparkSession, path: str) -> list[str]:
    rows = spark.read.schema("position int, key string").json(path).orderBy("position").collect()
    return [r["key"] for r in rows]


def scores_schema(features: Sequence[str], n_drivers: int = names.N_DRIVERS) -> T.StructType:
    """Types of the score table, so reading it back never guesses (leading zeros, ticker "NA")."""
    fields = [(c, "string") for c in names.IDENTITY]
    fields += [(c, "integer" if c == "num_features_used" else "double") for c in names.SCORES]
    for i in range(1, n_drivers + 1):
        fields += [(f"top_driver_{i}", "string"), (f"top_driver_{i}_value", "double")]
    fields.append(("model_type", "string"))
    for of in (names.self_z, names.peer_z, names.combined_z):
        fields += [(of(f), "double") for f in features]
    fields += [("scoring_version", "string"), ("scored_at", "timestamp")]
    schema = T.StructType()
    for name, kind in fields:
        schema = schema.add(name, kind)
    return schema


def read_scores_csv(
    spark: SparkSession, path: str, features: Sequence[str], n_drivers: int = names.N_DRIVERS,
) -> DataFrame:
    """Scores written by `write_csv`: missing and empty text stay apart, line breaks come back."""
    raw = spark.read.schema(scores_schema(features, n_drivers)).options(**CSV_OPTIONS).csv(path)
    return raw.select(*[
        unescape_lines(col(f.name)).alias(f.name) if isinstance(f.dataType, T.StringType)
        else col(f.name) for f in raw.schema.fields])
