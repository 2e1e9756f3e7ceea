"""Writing and publishing result tables.

`publish_set` publishes a set of results as one: every table is written to a folder of its own, and a manifest that
names them is the last thing to appear. Readers follow the newest manifest, so they see the old set or the
new one, never half of each, and a publication that fails leaves the old set as it was.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline import names
from plumbline.functions.expressions import col

DEFAULT_OUTPUTS = (names.SCORES_TABLE, names.REVIEW_TABLE)
# Missing values are written as \N, so that an empty text is not taken for one.
CSV_OPTIONS = {"header": True, "escape": '"', "nullValue": "\\N"}


def escape_lines(text: Column) -> Column:
    """Backslash, line feed and carriage return as two-character codes: one record is one line."""
    coded = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.replace(F.replace(coded, F.lit("\n"), F.lit("\\n")), F.lit("\r"), F.lit("\\r"))


def unescape_lines(text: Column) -> Column:
    """Undo `escape_lines`. Between two coded backslashes the other two codes are read as they stand, so
    no sign of the text has to serve as a mark."""
    plain = F.transform(F.split(text, r"\\\\"), lambda piece: F.replace(
        F.replace(piece, F.lit("\\n"), F.lit("\n")), F.lit("\\r"), F.lit("\r")))
    return F.array_join(plain, "\\")


def csv_ready(df: DataFrame) -> DataFrame:
    return df.select(*[
        escape_lines(col(f.name)).alias(f.name) if isinstance(f.dataType, T.StringType) else col(f.name)
        for f in df.schema.fields])


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header line in every part; the order of rows across parts is not a contract.

    Line breaks inside texts are escaped, so files stay splittable; `read_scores_csv` undoes it.
    """
    csv_ready(df).write.options(**CSV_OPTIONS).csv(path)


def publish_output(df: DataFrame, root: str, name: str, fmt: str = "parquet") -> str:
    """Write one result below ``root``, replacing the previous one, and return where it is."""
    uri = f"{root.rstrip('/')}/{name}"
    writer = (csv_ready(df) if fmt == "csv" else df).write.mode("overwrite").format(fmt)
    if fmt == "csv":
        writer = writer.options(**CSV_OPTIONS)
    writer.save(uri)
    return uri


def publish_outputs(
    outputs: Mapping[str, DataFrame | None], root: str, fmt: str = "parquet",
    wanted: tuple[str, ...] = DEFAULT_OUTPUTS,
) -> tuple[dict[str, str], list[str]]:
    """Publish the wanted results that exist, each in the place of its last version; returns their
    locations and the names skipped. `publish_set` replaces all of them at once."""
    published = {
        name: publish_output(outputs[name], root, name, fmt)
        for name in wanted if outputs.get(name) is not None}
    return published, [name for name in wanted if name not in published]


MANIFESTS = "_published"


def publish_set(
    outputs: Mapping[str, DataFrame | None], root: str, fmt: str = "parquet",
    wanted: tuple[str, ...] = DEFAULT_OUTPUTS,
) -> tuple[dict[str, str], list[str]]:
    """Publish the wanted results that exist as one set; returns their locations and the names skipped.

    Earlier sets stay until `prune_published`. Of two jobs that publish at once one fails and changes
    nothing.
    """
    root = root.rstrip("/")
    chosen = {name: outputs[name] for name in wanted if outputs.get(name) is not None}
    skipped = [name for name in wanted if name not in chosen]
    if not chosen:
        return {}, skipped
    spark = next(iter(chosen.values())).sparkSession
    version = published_versions(spark, root)
    following = (version[-1] if version else 0) + 1
    folder = f"set-{following:08d}-{uuid.uuid4().hex}"
    published = {name: publish_output(df, f"{root}/{folder}", name, fmt) for name, df in chosen.items()}
    manifest = {"version": following, "format": fmt, "tables": {name: f"{folder}/{name}" for name in published}}
    _put_new(spark, f"{root}/{MANIFESTS}/{following:08d}.json", json.dumps(manifest, indent=1))
    return published, skipped


def published_versions(spark: SparkSession, root: str) -> list[int]:
    """Versions that have a manifest, oldest first."""
    fs, at = _file_system(spark, f"{root.rstrip('/')}/{MANIFESTS}")
    if not fs.exists(at):
        return []
    found = [s.getPath().getName() for s in fs.listStatus(at)]
    return sorted(int(n[:-5]) for n in found if n.endswith(".json") and n[:-5].isdigit())


def published_set(spark: SparkSession, root: str, version: int | None = None) -> dict:
    """The manifest of a version, the newest by default: version, format and tables by name."""
    versions = published_versions(spark, root)
    if not versions:
        raise FileNotFoundError(f"nothing is published below {root}")
    at = f"{root.rstrip('/')}/{MANIFESTS}/{version or versions[-1]:08d}.json"
    return json.loads(spark.read.text(at, wholetext=True).first()[0])


def read_published(spark: SparkSession, root: str, name: str, version: int | None = None,
                   schema: T.StructType | None = None) -> DataFrame:
    """One table of a published set. CSV needs its schema; line breaks inside texts come back."""
    found = published_set(spark, root, version)
    at = f"{root.rstrip('/')}/{found['tables'][name]}"
    if found["format"] != "csv":
        return spark.read.format(found["format"]).load(at)
    raw = spark.read.schema(schema).options(**CSV_OPTIONS).csv(at)
    return raw.select(*[unescape_lines(col(f.name)).alias(f.name) if isinstance(f.dataType, T.StringType)
                        else col(f.name) for f in raw.schema.fields])


def prune_published(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Delete all but the newest ``keep`` sets, and what publications that failed have left; returns the
    folders deleted. Not while another job publishes."""
    root = root.rstrip("/")
    versions = published_versions(spark, root)
    kept = {path.split("/")[0] for v in versions[-max(1, keep):]
            for path in published_set(spark, root, v)["tables"].values()}
    fs, at = _file_system(spark, root)
    # Manifests go first: a set without one is not seen any more.
    for v in versions[:-max(1, keep)]:
        fs.delete(_file_system(spark, f"{root}/{MANIFESTS}/{v:08d}.json")[1], False)
    names_there = [s.getPath().getName() for s in fs.listStatus(at)] if fs.exists(at) else []
    gone = sorted(n for n in names_there if n.startswith("set-") and n not in kept)
    for n in gone:
        fs.delete(_file_system(spark, f"{root}/{n}")[1], True)
    return gone


def _file_system(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def _put_new(spark: SparkSession, path: str, text: str) -> None:
    """A file that appears whole, and only if there is none of its name."""
    fs, at = _file_system(spark, path)
    _, part = _file_system(spark, f"{path}.{uuid.uuid4().hex}.part")
    out = fs.create(part)
    out.write(bytearray(text.encode()))
    out.close()
    if fs.exists(at) or not fs.rename(part, at):
        fs.delete(part, False)
        raise FileExistsError(f"{path} was published by another job")
