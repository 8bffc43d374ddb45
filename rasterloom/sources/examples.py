"""Sharded training data as Parquet, one folder per split and shard."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from rasterloom.functions.hashing import salt
from rasterloom.operators.exports import SHARD_MANIFEST
from rasterloom.sources.tables import prepare_target, read_manifest

MANIFEST_DIR = "shard_manifest.parquet"

# Part files that each shard is cut into, each written by its own task. Raise it with the
# input: three splits of 16 shards are else 48 files, whatever they hold.
FILES_PER_SHARD = 4


def export_shards(df: DataFrame, path: str, n: int | None = None, files_per_shard: int = FILES_PER_SHARD) -> DataFrame:
    """Write the part files of every (split, shard) and return the shard manifest.

    A salt from the image id cuts a shard into ``files_per_shard`` parts, or
    fewer if it has few rows. Rows per file come from the footers.
    """
    missing = F.raise_error(F.lit("processed_bytes must not be null"))
    checked = F.when(F.col("processed_bytes").isNull(), missing).otherwise(F.col("processed_bytes"))
    keys = [F.col("split"), F.col("shard_id")]
    if files_per_shard > 1:
        keys.append(salt(F.col("image_id"), files_per_shard))
    rows = df.withColumn("processed_bytes", checked)
    rows = rows.repartition(n, *keys) if n else rows.repartition(*keys)
    rows.write.mode("overwrite").partitionBy("split", "shard_id").parquet(prepare_target(path))
    return shard_manifest(df.sparkSession, path)


def shard_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Rows of every part file of an export; reads file footers, no column data."""
    file_path = F.col("_metadata.file_path")
    relative = F.regexp_extract(file_path, r"(split=[^/]*/shard_id=[^/]*/[^/]+)$", 1)
    return (
        spark.read.parquet(path)
        .groupBy("split", F.col("shard_id").cast("int").alias("shard_id"), relative.alias("relative_path"))
        .agg(F.count("*").alias("rows_written"))
    )


def write_shard_manifest(counts: DataFrame, path: str, export_id: str) -> None:
    """One row per part file."""
    rows = counts.withColumn("export_id", F.lit(export_id)).select(*SHARD_MANIFEST)
    rows.write.mode("overwrite").parquet(f"{path}/{MANIFEST_DIR}")


def read_examples(spark: SparkSession, path: str, limit: int | None = None) -> DataFrame:
    """Exported rows with the byte length in place of the bytes; all of them, or a preview of ``limit``."""
    rows = read_manifest(spark, path).select(
        "image_id", "split", "split_id",
        F.col("label_idx").cast("int").alias("label_idx"),
        F.col("shard_id").cast("int").alias("shard_id"),
        F.octet_length("processed_bytes").alias("image_bytes_len"),
    )
    return rows.limit(limit) if limit is not None else rows
