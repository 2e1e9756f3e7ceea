"""The review pack: the most unusual filings with driver text and raw features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline import names
from plumbline.functions.expressions import col
from plumbline.operators.dedup import first_per_key
from plumbline.operators.drivers import with_driver_summary
from plumbline.operators.groups import attach_small, fits_broadcast
from plumbline.operators.ranking import top_n
from plumbline.session import materialize


def select_present(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """Project to the wanted columns in their order, leaving out those the table lacks."""
    return df.select(*[col(c) for c in wanted if c in df.columns])


def build_review_pack(
    scores: DataFrame, raw: DataFrame, features: Sequence[str], n: int = names.TOP_N,
    listing_order: Sequence[Column] = (),
) -> DataFrame:
    """Top n scores with driver summary and the raw features of the same key (first copy).

    The raw table is reduced to the top keys before it is deduplicated, so it is scanned once and
    only rows of the pack are shuffled. Missing keys match missing keys.
    """
    top = materialize(top_n(scores, n), "top-scores")
    keys = [names.ENTITY, names.PERIOD]
    wanted = top.select(*[
        c for i, k in enumerate(keys) for c in (
            F.coalesce(col(k).cast("string"), F.lit("")).alias(f"__k{i}"),
            col(k).isNull().alias(f"__null{i}"))]).distinct()
    marked = raw.select(
        "*", *[c for i, k in enumerate(keys) for c in (
            F.coalesce(col(k).cast("string"), F.lit("")).alias(f"__k{i}"),
            col(k).isNull().alias(f"__null{i}"))])
    on = ["__k0", "__null0", "__k1", "__null1"]
    raw_rows = attach_small(marked, wanted, on, n, 200, "left_semi").drop(*on)
    once = first_per_key(raw_rows, keys, listing_order).select(
        *[col(k).alias(f"__raw_{i}") for i, k in enumerate(keys)],
        *[col(f).alias(f) for f in features])
    same_key = (top[names.ENTITY].eqNullSafe(F.col("__raw_0"))
                & top[names.PERIOD].eqNullSafe(F.col("__raw_1")))
    pack = with_driver_summary(top).drop(*[f for f in features if f in top.columns])
    few = fits_broadcast(n, 64 + 8 * len(features))
    joined = pack.join(F.broadcast(once) if few else once, same_key, "left")
    return top_n(select_present(joined, [*names.PACK, *features]), n)
