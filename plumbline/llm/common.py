"""Column expressions shared by the text operators."""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Word characters by contract: everything but ASCII white space, or everything but ASCII
# punctuation, white space and control characters (after lower-casing A-Z).
SPACED_WORD = r"[^\x20\x09-\x0D]+"
NOT_ALNUM = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


LONG, TEXT, BYTES, DOUBLE = T.LongType(), T.StringType(), T.BinaryType(), T.DoubleType()


def rows_of(**fields: T.DataType) -> T.ArrayType:
    """Type of an array of structs."""
    return T.ArrayType(struct_of(**fields))


def struct_of(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    """A text column; null counts as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; other letters stay."""
    return F.translate(text, UPPER, LOWER)


def plain_words(text: Column) -> Column:
    """The lower-cased alphanumeric words joined by single spaces, without space at either end."""
    return F.btrim(F.regexp_replace(ascii_lower(text), NOT_ALNUM, " "), F.lit(" "))


def word_count(spaced: Column) -> Column:
    """Number of words of ``plain_words`` output."""
    spaces = F.length(spaced) - F.length(F.replace(spaced, F.lit(" "), F.lit("")))
    return F.when(spaced == "", F.lit(0)).otherwise(spaces + 1).cast("long")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def text_bytes(column: pa.Array) -> tuple[memoryview, np.ndarray]:
    """All texts of an Arrow column as one run of UTF-8 bytes, not copied, and the bounds of each.

    A null text is empty. What earlier batches held goes back to the system first.
    """
    pa.default_memory_pool().release_unused()
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    bounds = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1] \
        if len(column) else np.zeros(1, np.int64)
    data = column.buffers()[2] if len(column) else None
    run = memoryview(data)[int(bounds[0]):int(bounds[-1])] if data is not None else memoryview(b"")
    return run, bounds - bounds[0]


def ships_by_value(module_name: str) -> None:
    """Send a module's functions to the workers by value, so nothing needs installing there."""
    cloudpickle.register_pickle_by_value(sys.modules[module_name])


ships_by_value(__name__)
