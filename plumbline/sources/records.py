"""Records JSON: arrays of objects, or objects one after the other, read by many tasks.

Files are cut at every closing brace by the splittable text source. Where each piece is one flat object, as
in tables written record by record, pieces are parsed as they come. Braces inside texts and nested objects
make longer records: running sums over each split tell which pieces begin inside a text and how deep, the
sums of earlier splits are added, and the pieces of a record are put together again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.session import materialize

def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """Text between closing braces: piece, file, block (where its split begins) and at (order in a split)."""
    return spark.read.option("lineSep", "}").text(path).select(
        F.col("value").alias("piece"), F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"))


def _plain(piece):
    """Without escaped signs."""
    return F.regexp_replace(piece, r"(?s)\\.", "")


def _quotes(piece):
    """Quotation marks that are not escaped."""
    plain = _plain(piece)
    return F.length(plain) - F.length(F.replace(plain, F.lit('"'), F.lit("")))


def _opened(piece):
    """Opening braces outside texts."""
    outside = F.regexp_replace(F.regexp_replace(_plain(piece), '"[^"]*"', ""), '"[^"]*$', "")
    return F.length(outside) - F.length(F.replace(outside, F.lit("{"), F.lit("")))


def _parsed(records: DataFrame, schema: T.StructType, date_format: str) -> DataFrame:
    text = F.concat(F.regexp_replace("piece", r"^[\[\],\s]+", ""), F.lit("}"))
    return records.select(F.from_json(text, schema, {
        "mode": "FAILFAST", "dateFormat": date_format}).alias("r")).select(*[
            F.col("r").getField(f.name).alias(f.name) for f in schema.fields])


def read_records(
    spark: SparkSession, path: str, schema: T.StructType | str, date_format: str = "yyyy-MM-dd",
) -> DataFrame:
    """The objects of the files below ``path`` as rows of ``schema``, in no order.

    Keys that an object lacks are missing values, keys the schema lacks are left out. An object that is no
    JSON is an error. Empty arrays and files have no rows.
    """
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    pieces = _pieces(spark, path).withColumn("quotes", _quotes(F.col("piece"))).withColumn(
        "opened", _opened(F.col("piece")))
    flat = (F.col("quotes") % 2 == 0) & ((F.col("opened") == 1) | F.trim("piece").rlike(r"^[\[\],\s]*$"))
    if not pieces.where(~flat).limit(1).count():
        return _parsed(pieces.where(F.col("opened") == 1), schema, date_format)
    return _parsed(_joined(materialize(pieces.drop("opened"), "record-pieces")), schema, date_format)


def _joined(pieces: DataFrame) -> DataFrame:
    """One row (piece) per object of pieces that may begin inside texts and nested objects."""
    split = Window.partitionBy("file", "block").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)

    def before(rows, amount, name):
        """Add the sum of an amount over everything earlier in the file."""
        splits = materialize(rows.groupBy("file", "block").agg(F.sum(amount).alias("in_split")), "record-splits")
        sums = splits.select("file", "block", F.coalesce(F.sum("in_split").over(earlier), F.lit(0)).alias("of_splits"))
        # One row per split of 128 MB.
        return rows.withColumn("of_split", F.coalesce(F.sum(amount).over(split), F.lit(0))) \
            .join(sums, ["file", "block"]).withColumn(name, F.col("of_splits") + F.col("of_split")) \
            .drop("of_splits", "of_split")

    quoted = before(pieces, F.col("quotes"), "quotes_before").withColumn("inside", F.col("quotes_before") % 2 == 1)
    whole = F.when(F.col("inside"), F.concat(F.lit('"'), "piece")).otherwise(F.col("piece"))
    # The brace after a piece closes an object unless it stands inside a text. What follows the last brace of
    # a file closes nothing, but ends below depth 0 and so ends no record.
    closes = (F.col("quotes_before") + F.col("quotes")) % 2 == 0
    deep = materialize(quoted.withColumn("opened", _opened(whole)).withColumn("closes", closes.cast("int"))
                       .drop("quotes", "quotes_before", "inside"), "record-depths")
    deep = before(deep, F.col("opened") - F.col("closes"), "depth_before")
    ends = F.col("depth_before") + F.col("opened") - F.col("closes") == 0
    numbered = before(materialize(deep.withColumn("ends", (ends & (F.col("closes") == 1)).cast("int")), "record-ends"),
                      F.col("ends"), "number")
    step = F.struct("block", "at", "piece")
    return numbered.groupBy("file", "number").agg(
        F.sort_array(F.collect_list(step)).alias("steps"), F.max("ends").alias("ends")) \
        .where(F.col("ends") == 1).select(F.array_join(F.transform("steps", lambda s: s["piece"]), "}").alias("piece"))
