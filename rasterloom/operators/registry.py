"""Version registries: one small row per version of a produced table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Row, SparkSession, functions as F

from rasterloom.sources.tables import read_manifest

# Columns of the three registries. Settings that decide the pixels
# are columns of the transform registry too, so the row alone reproduces a version.
TRANSFORM_REGISTRY = (
    "transform_version string, generated_at timestamp, target_width int, target_height int,"
    " resize_strategy string, image_mode string, image_format string, foreground_threshold int,"
    " foreground_crop_enabled boolean, foreground_crop_margin int, foreground_mask_enabled boolean,"
    " intensity_normalization_enabled boolean, partition_by string, partitions int,"
    " shuffle_partitions int, rows_written long, input_manifest_path string,"
    " output_manifest_path string, output_images_path string, debug_export_path string,"
    " debug_export_n int, debug_export_per_class int, debug_export_seed int"
)
SPLIT_REGISTRY = (
    "split_id string, generated_at timestamp, seed int, train_ratio double, val_ratio double,"
    " test_ratio double, rows_total long, rows_train long, rows_val long, rows_test long,"
    " input_manifest_path string, output_manifest_path string, output_splits_path string,"
    " partition_by string, partitions int, shuffle_partitions int"
)
EXPORT_REGISTRY = (
    "export_id string, generated_at timestamp, seed int, n_shards int, rows_total long,"
    " rows_train long, rows_val long, rows_test long, distinct_labels int,"
    " input_manifest_path string, output_path string, current_output_path string,"
    " output_format string, compression string, partition_by string, partitions int,"
    " shuffle_partitions int"
)


def registry_row(spark: SparkSession, schema: str, values: dict[str, object]) -> DataFrame:
    """One registry row; columns without a value are null."""
    names = [column.split()[0] for column in schema.split(",")]
    unknown = sorted(set(values) - set(names))
    if unknown:
        raise ValueError(f"not registry columns: {', '.join(unknown)}")
    return spark.createDataFrame([Row(*[values.get(name) for name in names])], schema)


def upsert_registry(rows: DataFrame, key: str, path: str) -> None:
    """Replace the rows of the keys given, keep all others."""
    (
        rows.repartition(key)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(key)
        .parquet(path)
    )


def append_registry(rows: DataFrame, path: str) -> None:
    """Add rows; earlier rows of the same key stay."""
    rows.write.mode("append").parquet(path)


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    """All versions, newest first."""
    return read_manifest(spark, path).orderBy(F.desc("generated_at"))


def current_version(registry: DataFrame, column: str = "output_path") -> DataFrame:
    """Path of the newest version: the table that ``current`` stands for."""
    return registry.agg(F.max_by(column, "generated_at").alias(f"current_{column}"))


def read_current(spark: SparkSession, path: str, column: str = "output_path") -> DataFrame:
    """The table that the newest registry row points at: what ``current`` stands for."""
    newest = current_version(read_registry(spark, path), column).first()[0]
    if newest is None:
        raise ValueError(f"no version in {path}")
    return read_manifest(spark, newest)
