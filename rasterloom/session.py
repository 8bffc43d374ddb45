"""Session settings and the shared folder that written tables and checkpoints use."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

# Proven upper bound, in bytes, of what one join may broadcast.
BROADCAST_BYTES = 64 * 1024 * 1024


def build_session(app_name: str, master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """A session with adaptive execution and Arrow batches sized for image rows."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    spark = (
        builder.config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        # rows hold whole images: bound the batches handed to kernels by bytes
        .config("spark.sql.execution.arrow.maxBytesPerBatch", str(64 * 1024 * 1024))
        .getOrCreate()
    )
    set_shuffle_partitions(spark, shuffle_partitions)
    return spark


def set_shuffle_partitions(spark: SparkSession, n: int | None) -> None:
    """Set the shuffle parallelism only when one is given."""
    if n is not None:
        spark.conf.set("spark.sql.shuffle.partitions", str(n))


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor reaches: ``spark.checkpoint.dir``, else one of our own.

    The cluster names the folder. Where it names none, one machine takes a
    temporary folder, once per application; on a cluster that is an error,
    since executors would each write to a disk of their own.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", "")
        if not named and not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="rasterloom-"))
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for a table inside the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise to the shared folder, so that a lost executor costs no recompute."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def payload_bytes(df: DataFrame):
    """Aggregate expression: an upper estimate of the bytes a frame's rows hold."""
    per_row = F.lit(16 * len(df.columns)).cast("long")
    for field in df.schema.fields:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            per_row = per_row + F.coalesce(F.octet_length(field.name), F.lit(0))
        elif isinstance(field.dataType, T.ArrayType):
            per_row = per_row + F.greatest(F.size(field.name), F.lit(0)) * 16
    return F.coalesce(F.sum(per_row), F.lit(0))


def broadcast_within(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast only after measuring that ``df`` stays within ``limit`` bytes.

    The side is materialised once, so measuring and joining do not compute it
    twice. Beyond the limit it is returned unhinted: Spark then shuffles both
    sides and adaptive execution splits the keys that hold too many rows.
    """
    held = cut_lineage(df)
    size = held.agg(payload_bytes(held).alias("bytes")).first()["bytes"]
    return F.broadcast(held) if size <= limit else held
