"""Filing bundles: one JSON object per file, flattened to one row per filing.

A file each costs a listing, an open and a rename, whatever its size, so bundles by the hundred thousand are
better kept as packs (`save_packs`): rows of few Parquet files that hold each bundle's path, folder and text.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass, field, replace

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from plumbline import names
from plumbline.functions.expressions import col, finite, safe_name
from plumbline.operators.groups import attach_counted, attach_small, fits_broadcast
from plumbline.operators.listed import listed_rows
from plumbline.session import materialize

# --- fixed values: the layout of a bundle --------------------------------------------------------
BUNDLE_SCHEMA = """
    selected_filing struct<form string, company_name string, cik string, report_date string,
                           filing_date string, accession_number string>,
    selected_filing_url string,
    extraction_input struct<ticker string>,
    engineered_anomaly_features variant
"""
METADATA = {
    "ticker": "extraction_input.ticker",
    "company_name": "selected_filing.company_name",
    "cik": "selected_filing.cik",
    "form_type": "selected_filing.form",
    "report_date": "selected_filing.report_date",
    "filing_date": "selected_filing.filing_date",
    "accession_number": "selected_filing.accession_number",
    "filing_url": "selected_filing_url",
}
# --- end of fixed values -------------------------------------------------------------------------

FEATURE_MAP = "engineered_anomaly_features"
SOURCE_PATH = "source_path"
FOLDER, PACK = "folder", "pack"
# Folders that bundles kept as rows are dealt over.
PACKS = 64
_CORRUPT = "_corrupt_record"
_NUMERIC = "^(TINYINT|SMALLINT|INT|BIGINT|FLOAT|DOUBLE|DECIMAL)"
# Feature keys that become columns; with more, features are rows (`FlatFilings.cells`).
MAX_KEYS = 20_000
REASONS = ("malformed", "other_form", "no_ticker", "not_listed", "over_limit", "no_features")


@dataclass(frozen=True)
class FlatFilings:
    """Flat table, ordered feature names, feature keys that shared one column name, and how many
    documents were read, accepted and left out for what reason.

    Where the documents have more than ``MAX_KEYS`` keys the table has no feature columns and ``cells`` has
    a row (ticker, report_date, source_path, feature, value) for each number there is.
    """

    table: DataFrame
    features: list[str]
    collisions: dict[str, list[str]] = field(default_factory=dict)
    counts: dict[str, int] = field(default_factory=dict)
    cells: DataFrame | None = None


def last_key_wins(spark: SparkSession) -> None:
    """A repeated key in a JSON object keeps its last value; Spark would reject the document."""
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")


def scan_bundles(
    spark: SparkSession, root: str, tickers: Sequence[str] | None = None,
    file_glob: str = "*" + names.BUNDLE_SUFFIX, ignore_unreadable: bool = False,
) -> DataFrame:
    """One row per bundle file below ``root``; with tickers, only their folders are listed.

    Folders of tickers that are not there are no error, a missing root is one.
    """
    last_key_wins(spark)
    path = root.rstrip("/")
    if tickers:
        chosen = sorted({re.sub(r"([\\*?\[\]{},])", r"\\\1", t) for t in tickers})
        path = path + "/{" + ",".join(chosen) + "}"
    schema = f"{BUNDLE_SCHEMA}, {_CORRUPT} string"
    reader = (
        spark.read.schema(schema).option("multiLine", True).option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", _CORRUPT).option("recursiveFileLookup", True)
        .option("pathGlobFilter", file_glob).option("ignoreCorruptFiles", ignore_unreadable)
    )
    try:
        return reader.json(path).select("*", F.col("_metadata.file_path").alias(SOURCE_PATH))
    except AnalysisException as missing:
        at = spark._jvm.org.apache.hadoop.fs.Path(root)
        there = at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)
        if missing.getCondition() != "PATH_NOT_FOUND" or not there:
            raise
        return spark.createDataFrame([], f"{schema}, {SOURCE_PATH} string")


def pack_of(folder: Column) -> Column:
    return F.pmod(F.xxhash64(F.coalesce(folder, F.lit(""))), F.lit(PACKS)).cast("int")


def save_packs(texts: DataFrame, root: str, json_column: str, path_column: str, folder_column: str) -> None:
    """Bundles as rows (source_path, folder, text) of Parquet files, all of a folder in one pack.

    A row without text is no bundle, as an empty file is none.
    """
    texts.where(col(json_column).isNotNull()).select(
        col(path_column).cast("string").alias(SOURCE_PATH), col(folder_column).cast("string").alias(FOLDER),
        col(json_column).alias("text"), pack_of(col(folder_column).cast("string")).alias(PACK)) \
        .repartition(PACKS, PACK).write.partitionBy(PACK).parquet(root)


def pack_folder(
    spark: SparkSession, root: str, packed: str, file_glob: str = "*" + names.BUNDLE_SUFFIX,
) -> None:
    """The bundle files below ``root`` as packs; a bundle's folder is the one its file lies in."""
    files = spark.read.text(root, wholetext=True, recursiveFileLookup=True, pathGlobFilter=file_glob)
    path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    save_packs(files.where(F.col("value").rlike(r"\S")).select(
        "value", F.col("_metadata.file_path").alias("path"), F.get(F.split(path, "/"), F.size(
            F.split(path, "/")) - 2).alias("folder")), packed, "value", "path", "folder")


def scan_packs(
    spark: SparkSession, root: str, folders: Sequence[str] | DataFrame | None = None,
    file_glob: str = "*.parquet",
) -> DataFrame:
    """The same rows as `scan_bundles` from packs; with folders, only their packs are read.

    The folders are a list or, where they are many, a table with a column ``folder``.
    """
    held = spark.read.schema(f"{SOURCE_PATH} string, {FOLDER} string, text string, {PACK} int") \
        .option("pathGlobFilter", file_glob).parquet(root)
    if isinstance(folders, DataFrame):
        # At most PACKS rows, which prune the packs at run time.
        packs = folders.select(pack_of(F.col(FOLDER).cast("string")).alias(PACK)).distinct()
        held = listed_rows(held.join(F.broadcast(packs), PACK, "left_semi"), FOLDER, folders)
    elif folders:
        held = held.where(F.col(PACK).isin([pack_of(F.lit(f)) for f in sorted(set(folders))])
                          & F.col(FOLDER).isin(sorted(set(folders))))
    return parse_bundles(held, "text", SOURCE_PATH)


def parse_bundles(texts: DataFrame, json_column: str, path_column: str) -> DataFrame:
    """The same rows as `scan_bundles` from a column of JSON text instead of files."""
    last_key_wins(texts.sparkSession)
    parsed = F.from_json(
        col(json_column), f"{BUNDLE_SCHEMA}, {_CORRUPT} string",
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT})
    return texts.select(parsed.alias("bundle"), col(path_column).alias(SOURCE_PATH)).select(
        "bundle.*", SOURCE_PATH)


def malformed_bundles(bundles: DataFrame) -> DataFrame:
    """Path, ticker if readable, and text of the documents that could not be parsed.

    The flatten skips them.
    """
    return bundles.where(F.col(_CORRUPT).isNotNull()).select(
        SOURCE_PATH, F.col(METADATA["ticker"]).alias("ticker"), _CORRUPT)


def accepted_bundles(
    bundles: DataFrame, form_type: str = names.DEFAULT_FORM, tickers: Sequence[str] | None = None,
    max_tickers: int | None = None,
) -> DataFrame:
    """Well-formed bundles of the form, with a ticker, on the allow-list, with features.

    ``max_tickers`` keeps the tickers that come first in path order. It counts before the test for
    features, so a ticker whose bundles have none still takes a place.
    """
    ticker = F.col(METADATA["ticker"])
    kept = bundles.where(
        F.col(_CORRUPT).isNull() & (F.col(METADATA["form_type"]) == form_type)
        & ticker.isNotNull() & (ticker != ""))
    if tickers:
        kept = allow_list(kept, ticker, tickers)
    if max_tickers is not None:
        kept = first_entities(kept.withColumn("__ticker", ticker), "__ticker", SOURCE_PATH,
                              max_tickers).drop("__ticker")
    # An object with at least one key; "OBJECT<>" is the empty object.
    return kept.where(F.schema_of_variant(F.col(FEATURE_MAP)).rlike("^OBJECT<.+>$"))


def allow_list(df: DataFrame, value: Column, allowed: Sequence[str]) -> DataFrame:
    return df.where(value.isin(sorted(set(allowed))))


def first_entities(df: DataFrame, entity: str, order: str, n: int) -> DataFrame:
    """All rows of the n entities whose first row comes earliest in ``order``."""
    first = df.groupBy(col(entity)).agg(F.min(col(order)).alias("__first"))
    chosen = first.orderBy("__first", col(entity)).limit(n).select(col(entity))
    return attach_small(df, chosen, [entity], n, 64, "left_semi")


def feature_key_table(bundles: DataFrame, feature_map: str = FEATURE_MAP,
                      order: str = SOURCE_PATH) -> DataFrame:
    """Every key of the feature objects: column name, first appearance, and whether it is numeric.

    A key is numeric when it has a value and all its values are numbers; numeric text, booleans and
    nested values do not count. Bookkeeping keys are left out.
    """
    entries = _entries(bundles, [col(order).alias("__order")], feature_map) \
        .select("__order", "key", F.schema_of_variant(F.col("value")).alias("kind"))
    return (
        entries.where(~F.col("key").isin(names.BUNDLE_BOOKKEEPING))
        .groupBy("key").agg(
            F.min("__order").alias("first_seen"),
            F.count_if(F.col("kind") != "VOID").alias("n_values"),
            F.count_if(F.col("kind").rlike(_NUMERIC)).alias("n_numbers"))
        .select(
            "key", safe_name(F.col("key")).alias("name"), "first_seen", "n_values",
            ((F.col("n_values") > 0) & (F.col("n_values") == F.col("n_numbers"))).alias("numeric"))
    )


def _entries(bundles: DataFrame, keep: Sequence[Column], feature_map: str = FEATURE_MAP) -> DataFrame:
    """The kept columns with ``key`` and ``value`` (variant) of every entry of the feature objects."""
    spark = bundles.sparkSession
    held = bundles.select(*keep, col(feature_map).alias("__map"))
    return held.lateralJoin(spark.tvf.variant_explode(F.col("__map").outer())).select(
        *[col(c) for c in held.columns if c != "__map"], "key", "value")


def feature_cells(bundles: DataFrame, keys: DataFrame, n_keys: int) -> DataFrame:
    """One row (ticker, report_date, source_path, feature, value) per present number of the feature objects.

    ``keys`` is the written `feature_key_table`. Of keys that clean to one name the first present value in
    key order wins, as in the wide layout; bookkeeping, metadata and unnamed keys are no features.
    """
    taken = [*METADATA, SOURCE_PATH, *names.NOT_FEATURES, *names.BUNDLE_BOOKKEEPING, ""]
    is_feature, renamed = F.col("numeric") & ~F.col("name").isin(taken), F.col("name") != F.col("key")
    numbers = keys.where(is_feature).select("key", F.col("name").alias("feature"), "first_seen", "n_values")
    found = keys.agg(F.count_if(is_feature).alias("features"), F.count_if(is_feature & renamed).alias("renamed")).first()
    # Keys that keep their names cannot share one.
    shared = found["renamed"] > 0 and numbers.select("feature").distinct().count() < found["features"]
    n_odd = n_keys - found["features"] + found["renamed"]
    keep = [F.col(METADATA[c]).alias(c) for c in ("ticker", "report_date")] + [F.col(SOURCE_PATH)]
    # Exploded, so that the filter takes the number read once and does not read it again.
    entries = _entries(bundles, keep).where(~F.col("key").isin(names.BUNDLE_BOOKKEEPING)).select(
        "ticker", "report_date", SOURCE_PATH, "key",
        F.explode(F.array(F.try_variant_get(F.col("value"), "$", "double"))).alias("value"),
    ).withColumn("value", finite(F.col("value"))).where(F.col("value").isNotNull())
    if shared or not fits_broadcast(n_odd, 160):
        cells = attach_counted(entries, numbers, "key", n_keys, 160, "n_values")
    elif n_odd:
        # Only keys that are no features or have other names are looked up.
        odd = keys.where(~is_feature | renamed).select(
            "key", F.lit(True).alias("__odd"), F.when(is_feature, F.col("name")).alias("__name"))
        cells = entries.join(F.broadcast(odd), "key", "left").withColumn(
            "feature", F.when(F.col("__odd"), F.col("__name")).otherwise(F.col("key"))) \
            .where(F.col("feature").isNotNull())
    else:
        cells = entries.withColumn("feature", F.col("key"))
    of = ["ticker", "report_date", SOURCE_PATH, "feature"]
    if shared:
        cells = cells.groupBy(*of).agg(F.min_by("value", F.struct("first_seen", "key")).alias("value"))
    return cells.select(*of, "value")


def flatten_feature_map(
    df: DataFrame, keep: Sequence[Column], key_rows: Sequence, feature_map: str = FEATURE_MAP,
    reserved: Sequence[str] = tuple(METADATA),
) -> FlatFilings:
    """One column per feature key, by one projection: no pivot and no shuffle.

    Keys that clean to the same name share a column, the first present value in key order wins, and
    they are reported. A name reserved for metadata is never overwritten.
    """
    taken = set(reserved) | {SOURCE_PATH}
    by_name: dict[str, list] = {}
    for row in sorted(key_rows, key=lambda r: (r["first_seen"], r["key"])):
        by_name.setdefault(row["name"], []).append(row)
    collisions = {n: [r["key"] for r in rows] for n, rows in by_name.items()
                  if len(rows) > 1 or n in taken}
    columns, features = [], []
    for name, rows in by_name.items():
        if name in taken or not name:
            continue
        numeric = all(r["numeric"] or not r["n_values"] for r in rows) and any(
            r["numeric"] for r in rows)
        values = [_entry(feature_map, r["key"], "double" if numeric else "string") for r in rows]
        value = F.coalesce(*[finite(v) if numeric else v for v in values])
        columns.append(value.alias(name))
        if numeric and name not in names.NOT_FEATURES and name not in names.BUNDLE_BOOKKEEPING:
            features.append(name)
    return FlatFilings(df.select(*keep, *columns), features, collisions)


def _entry(feature_map: str, key: str, kind: str) -> Column:
    """Value of one key, NULL when absent or of another type. Paths quote with either mark."""
    for mark in ('"', "'"):
        if mark not in key:
            return F.try_variant_get(col(feature_map), f"$[{mark}{key}{mark}]", kind)
    entries = col(feature_map).cast("map<string,variant>")
    return F.try_variant_get(F.try_element_at(entries, F.lit(key)), "$", kind)


def flatten_bundles(bundles: DataFrame) -> FlatFilings:
    """Flat filing table of accepted bundles: metadata, source path, and a column per feature, or a row
    per number where the features are too many for columns."""
    keep = [F.col(path).alias(name) for name, path in METADATA.items()] + [F.col(SOURCE_PATH)]
    keys = materialize(feature_key_table(bundles), "feature-keys")
    found = keys.count()
    if found > MAX_KEYS:
        return FlatFilings(bundles.select(*keep), [], cells=feature_cells(bundles, keys, found))
    # One row per distinct feature name, the size of a schema.
    return flatten_feature_map(bundles, keep, keys.collect())


def left_out(form_type: str, tickers: Sequence[str] | None) -> Column:
    """The first reason why a document is left out, limits on tickers aside; null if there is none."""
    ticker = F.col(METADATA["ticker"])
    allowed = ticker.isin(sorted(set(tickers))) if tickers else F.lit(True)
    no = lambda condition: ~F.coalesce(condition, F.lit(False))
    return (
        F.when(F.col(_CORRUPT).isNotNull(), "malformed")
        .when(no(F.col(METADATA["form_type"]) == form_type), "other_form")
        .when(no(ticker != ""), "no_ticker").when(no(allowed), "not_listed")
        .when(no(F.schema_of_variant(F.col(FEATURE_MAP)).rlike("^OBJECT<.+>$")), "no_features"))


def load_bundles(
    spark: SparkSession, root: str, form_type: str = names.DEFAULT_FORM,
    max_tickers: int | None = None, tickers: Sequence[str] | None = None,
    file_glob: str = "*" + names.BUNDLE_SUFFIX, ignore_unreadable: bool = False,
) -> FlatFilings:
    """Scan, filter and flatten the bundles below ``root``, as `flatten_counted`."""
    return flatten_counted(
        scan_bundles(spark, root, tickers, file_glob, ignore_unreadable), form_type, max_tickers, tickers)


def load_packs(
    spark: SparkSession, root: str, form_type: str = names.DEFAULT_FORM,
    max_tickers: int | None = None, tickers: Sequence[str] | None = None, file_glob: str = "*.parquet",
) -> FlatFilings:
    """`load_bundles` from packs; as there, tickers also name the folders."""
    return flatten_counted(scan_packs(spark, root, tickers, file_glob), form_type, max_tickers, tickers)


def flatten_counted(
    bundles: DataFrame, form_type: str = names.DEFAULT_FORM, max_tickers: int | None = None,
    tickers: Sequence[str] | None = None,
) -> FlatFilings:
    """Filter and flatten scanned bundles.

    The documents are parsed once, into a written table, and counted while it is written: ``documents``,
    those left out under the first of `REASONS` that holds, and those ``kept``. Only a limit on the tickers
    takes another look, at two columns.
    """
    seen, reason = Observation(), left_out(form_type, tickers)
    bundles = materialize(
        bundles.observe(
            seen, F.count(F.lit(1)).alias("documents"),
            *[F.count_if(F.coalesce(reason == r, F.lit(False))).alias(r) for r in REASONS]), "bundles")
    counts = dict(seen.get)
    accepted = accepted_bundles(bundles, form_type, tickers, max_tickers)
    if max_tickers is not None:
        within = accepted.agg(F.count(F.lit(1)).alias("kept")).first()["kept"]
        chosen = first_entities(
            bundles.where(F.coalesce(reason, F.lit("no_features")) == "no_features").select(
                F.col(METADATA["ticker"]).alias("ticker"), SOURCE_PATH, reason.alias("reason")),
            "ticker", SOURCE_PATH, max_tickers)
        empty = chosen.where(F.col("reason").isNotNull()).count()
        counts["over_limit"] = counts["documents"] - within - empty - sum(
            counts[r] for r in REASONS[:REASONS.index("over_limit")])
        counts["no_features"] = empty
    counts["kept"] = counts["documents"] - sum(counts[r] for r in REASONS)
    return replace(flatten_bundles(accepted), counts=counts)
