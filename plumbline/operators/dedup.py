"""One row per key, and counts about a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline import names
from plumbline.functions.expressions import col, finite


def first_per_key(
    df: DataFrame, keys: Sequence[str] = (names.ENTITY, names.PERIOD), order: Sequence[Column] = (),
) -> DataFrame:
    """Keep the first row of every key; missing keys count as equal to each other.

    Spark limits each map task to one row per key before the shuffle (a partial window group limit
    for ``row_number() = 1``), so a key with very many copies does not overload a task. Give
    ``order`` the listing order of the rows; by default it is the source path, then the accession
    number, where the table has them. Rows equal in that are told apart by their content.
    """
    listed = [col(c) for c in ("source_path", "accession_number") if c in df.columns]
    ranked_by = [*(list(order) or listed), F.xxhash64(*[
        col(f.name) for f in df.schema.fields if f.dataType.typeName() not in ("map", "variant")])]
    place = F.row_number().over(Window.partitionBy(*[col(k) for k in keys]).orderBy(*ranked_by))
    return df.withColumn("__place", place).where(F.col("__place") == 1).drop("__place")


def numeric_features(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Cast every feature to double and turn NaN and infinities into missing, once, at the start."""
    wanted = set(features)
    return df.select(*[
        finite(col(c)).alias(c) if c in wanted else col(c) for c in df.columns])


def feature_profile(
    df: DataFrame, features: Sequence[str], entity: str = names.ENTITY,
    keys: Sequence[str] = (names.ENTITY, names.PERIOD),
) -> DataFrame:
    """One row: rows, distinct entities, duplicate rows, number of features.

    Rows are counted per key first, so the second step sees one row per key however many copies
    there are; distinct entities are then counted on the keys.
    """
    carried = list(dict.fromkeys([*keys, entity]))
    per_key = df.groupBy(*[col(k) for k in carried]).agg(F.count(F.lit(1)).alias("__copies"))
    per_entity = per_key.groupBy(col(entity)).agg(
        F.sum("__copies").alias("__rows"), F.count(F.lit(1)).alias("__keys"))
    return per_entity.agg(
        F.coalesce(F.sum("__rows"), F.lit(0)).alias("n_rows"),
        F.count(col(entity)).alias("n_entities"),
        (F.coalesce(F.sum("__rows"), F.lit(0)) - F.coalesce(F.sum("__keys"), F.lit(0)))
        .alias("n_duplicates"),
    ).withColumn("n_features", F.lit(len(features)))
