"""Rows whose value stands in a list that is a table.

A short list is broadcast. A long one first reduces the rows by a bitmap of hashed values, of bounded size
and broadcast: of the rows that are not listed few are left to be shuffled with the list, which decides.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.functions.expressions import col
from plumbline.session import BROADCAST_BYTES

# Bits for each listed value, and at most: 32 MB. Where that is full the list alone decides.
BITS_EACH, MOST_BITS = 16, 1 << 28


def listed_rows(df: DataFrame, column: str, allowed: DataFrame, of: str | None = None,
                broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Rows of ``df`` whose ``column`` is among the values of ``allowed`` (its column ``of``, or of the same
    name). A missing value is in no list; repeated values in the list change nothing."""
    of = of or column
    wanted = allowed.select(col(of).cast(df.schema[column].dataType).alias(column)).where(
        col(column).isNotNull()).distinct()
    n = wanted.count()
    if n * 64 <= broadcast_bytes:
        return df.join(F.broadcast(wanted), column, "left_semi")
    bits = min(MOST_BITS, 1 << max(15, (n * BITS_EACH - 1).bit_length()))
    place = lambda: F.pmod(F.xxhash64(col(column)), F.lit(bits))
    maps = wanted.select(place().alias("__place")).groupBy(
        F.bitmap_bucket_number("__place").alias("__bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("__place")).alias("__map"))
    marked = df.withColumn("__at", place())
    marked = marked.withColumn("__bucket", F.bitmap_bucket_number("__at")) \
        .withColumn("__bit", F.bitmap_bit_position("__at"))
    byte = F.conv(F.hex(F.substring(F.col("__map"), F.call_function("div", F.col("__bit"), F.lit(8)).cast("int") + 1,
                                    F.lit(1))), 16, 10).cast("bigint")
    held = marked.join(F.broadcast(maps.withColumnRenamed("__bucket", "__of")), (F.col("__bucket") == F.col("__of")) & (
        F.getbit(byte, (F.col("__bit") % 8).cast("int")) == 1), "left_semi")
    return held.drop("__at", "__bucket", "__bit").join(wanted, column, "left_semi")
