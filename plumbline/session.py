"""Session settings and the shared scratch area.

Multi-pass jobs (quantile refinement, the covariance fit, ranking) cut their lineage by writing a
parquet table to the folder named by ``spark.checkpoint.dir``. A written table survives the loss of
an executor and is read back with column pruning, which a row-format checkpoint is not.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Scratch tables this process has written, by the application that wrote them.
_WRITTEN: dict[str, list[str]] = {}

# Tables with at most this many bytes may be broadcast; anything larger is shuffled.
BROADCAST_BYTES = 64 * 1024 * 1024

# Rows and bytes of one batch that goes to a Python worker where rows are long; Spark's own limits let ten
# thousand rows through, which a task holds several times over, in the executor and in its worker.
BATCH_ROWS, BATCH_BYTES = 1000, 4 * 1024 * 1024


def local_session(cores: str = "*", app: str = "plumbline") -> SparkSession:
    """Session for tests and the benchmark; a cluster brings its own session."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", os.environ.get("PLUMBLINE_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Small local data should still use every core.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        .config("spark.sql.files.openCostInBytes", str(128 * 1024))
        # Without a call-site lookup per column expression, wide plans build several times faster.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables.

    Uses ``spark.checkpoint.dir`` when the session names one. Only a local-mode session without the
    setting gets a temporary folder; on a cluster the setting is required, since a machine-local
    folder is invisible to the other machines.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="plumbline-"))
        root = spark.sparkContext.getCheckpointDir()
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    path = f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"
    _WRITTEN.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def release_scratch(spark: SparkSession) -> int:
    """Delete the scratch tables of this application and return how many there were.

    Results read them until they are written themselves, so call it after the last result is.
    """
    paths = _WRITTEN.pop(spark.sparkContext.applicationId, [])
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for path in paths:
        at = jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(conf).delete(at, True)
    return len(paths)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and return a scan of the written table."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Jobs started inside send long rows to Python workers in batches of ``BATCH_ROWS`` and ``BATCH_BYTES``.

    The session's own limits are back afterwards.
    """
    limits = {"spark.sql.execution.arrow.maxRecordsPerBatch": str(BATCH_ROWS),
              "spark.sql.execution.arrow.maxBytesPerBatch": f"{BATCH_BYTES}b"}
    before = {name: spark.conf.get(name) for name in limits}
    for name, most in limits.items():
        spark.conf.set(name, most)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
