"""The flatten jobs: bundles or a filings table to a written feature table and its key list."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession

from plumbline import names
from plumbline.operators.dedup import numeric_features
from plumbline.sources.bundles import FlatFilings, load_bundles, load_packs
from plumbline.sources.tables import (
    discover_features, load_filings_table, write_feature_keys, write_features,
)


# Where the features are too many for columns, their rows lie beside the table.
CELLS = "-cells"


def flatten_bundle_folder(
    spark: SparkSession, root: str, form_type: str = names.DEFAULT_FORM,
    max_tickers: int | None = None, tickers: Sequence[str] | None = None,
    features_path: str | None = None, keys_path: str | None = None,
    file_glob: str = "*" + names.BUNDLE_SUFFIX,
) -> FlatFilings:
    """Flatten a folder of bundles; with paths, also write the features and the key list."""
    flat = load_bundles(spark, root, form_type, max_tickers, tickers, file_glob)
    return _written(spark, flat, features_path, keys_path)


def flatten_bundle_packs(
    spark: SparkSession, root: str, form_type: str = names.DEFAULT_FORM,
    max_tickers: int | None = None, tickers: Sequence[str] | None = None,
    features_path: str | None = None, keys_path: str | None = None,
) -> FlatFilings:
    """`flatten_bundle_folder` from packs (`bundles.save_packs`), for bundles too many for a file each."""
    return _written(spark, load_packs(spark, root, form_type, max_tickers, tickers), features_path, keys_path)


def flatten_filings_table(
    spark: SparkSession, filings: DataFrame, form_type: str = names.DEFAULT_FORM,
    features_path: str | None = None, keys_path: str | None = None,
) -> FlatFilings:
    """The same result from a filings table that is flat already."""
    table = load_filings_table(filings, form_type)
    features = discover_features(table)
    flat = FlatFilings(numeric_features(table, features), features)
    return _written(spark, flat, features_path, keys_path)


def _written(spark, flat: FlatFilings, features_path, keys_path) -> FlatFilings:
    if features_path:
        write_features(flat.table, features_path)
        flat = replace(flat, table=spark.read.parquet(features_path))
        if flat.cells is not None:
            write_features(flat.cells, features_path + CELLS)
            flat = replace(flat, cells=spark.read.parquet(features_path + CELLS))
    if keys_path:
        write_feature_keys(spark, flat.features, keys_path)
    return flat
