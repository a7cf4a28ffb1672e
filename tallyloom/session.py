"""Session settings and reliable staging of intermediate frames."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def build_session(app: str = "tallyloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs are designed for.

    Adaptive execution re-plans joins from measured sizes and splits skewed
    join partitions; nothing here depends on a given cluster size.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # Checkpointed files go when their frame is no longer referenced.
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the shared folder named in ``spark.checkpoint.dir``; where it is unset, one below the warehouse."""
    context = spark.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(shared_root(spark))
    return context.getCheckpointDir()


def shared_root(spark: SparkSession) -> str:
    """The folder that the driver and all executors see."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    return named or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_staged"


def open_store(uri: str):
    """The file system of a URI and the path in it."""
    from pyarrow import fs

    if "://" not in uri:
        return fs.LocalFileSystem(), uri.removeprefix("file:")
    return fs.FileSystem.from_uri(uri)


def write_shared(df: DataFrame, name: str) -> str:
    """Write a small frame to a new folder that all executors see, and return it, for tasks to :func:`read_shared`."""
    folder = f"{shared_root(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(folder)
    return folder


def read_shared(folder: str):
    """In a task: all rows of a folder of :func:`write_shared` as an Arrow table."""
    from pyarrow import dataset

    store, path = open_store(folder)
    return dataset.dataset(path, filesystem=store, format="parquet").to_table()


def stage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and go on from there.

    Used where a frame is read again by several jobs (iterations, fits): a lost
    executor then costs a re-read of the written rows, not of the whole lineage,
    and every later job sees the very same rows.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stage_compact(df: DataFrame) -> DataFrame:
    """As :func:`stage` for frames as large as the input: compressed columns, of which a read takes those it needs.

    They take a fraction of the disk of checkpointed rows; the partitions are those of the reader.
    """
    folder = f"{shared_root(df.sparkSession).rstrip('/')}/staged-{uuid.uuid4().hex}"
    # In row groups that are small enough for a file of a few to be read by several tasks.
    df.write.options(**{"compression": "zstd", "parquet.block.size": 4 << 20}).parquet(folder)
    # What was shuffled for it is deleted once the JVM has found that nothing refers to it.
    df.sparkSession.sparkContext._jvm.System.gc()
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def checked_broadcast(df: DataFrame, max_rows: int = 100_000) -> DataFrame:
    """Stage a lookup frame and hint a broadcast only if it has at most ``max_rows`` rows.

    Above that the frame is returned unhinted, and Spark joins it by shuffling.
    """
    return broadcast_staged(stage(df), max_rows)


def broadcast_staged(staged: DataFrame, max_rows: int = 100_000) -> DataFrame:
    """As :func:`checked_broadcast`, for a frame that is staged already."""
    return F.broadcast(staged) if staged.count() <= max_rows else staged
