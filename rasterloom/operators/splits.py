"""Hash splits, shards and their names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from rasterloom.functions import hashing
from rasterloom.functions.checks import name_or_none, positive_int, require_cols, split_ratios

# Split names, default shares and seed, and the parts of generated names.
SPLITS = ("train", "val", "test")
DEFAULT_RATIOS = (0.7, 0.15, 0.15)
DEFAULT_SEED = 42
NAME_TIME = "yyyyMMdd'T'HHmmss'Z'"
SPLIT_PREFIX = "split_seed"
EXPORT_PREFIX = "training_tfrecord_seed"


def assign_split(
    df: DataFrame, ratios=DEFAULT_RATIOS, seed: int = DEFAULT_SEED, split_id: str | None = None
) -> DataFrame:
    """Add split and lineage columns; a row's split depends on its id and the seed only."""
    require_cols(df, ["image_id"])
    train, val, test = split_ratios(ratios)
    key = hashing.split_key(F.col("image_id"), seed)
    return df.withColumns(
        {
            "split": F.when(key < train, "train").when(key < train + val, "val").otherwise("test"),
            "split_id": F.lit(name_or_none(split_id)).cast("string"),
            "split_seed": F.lit(seed).cast("int"),
            "split_ratios": F.lit(f"{train:.4f}/{val:.4f}/{test:.4f}"),
        }
    )


def split_name(seed: Column, ratios: list[Column], generated_at: Column, given: Column | None = None) -> Column:
    """Identifier of a split; a given one wins unless it is blank."""
    tags = [F.bround(share * 100).cast("int").cast("string") for share in ratios]
    made = F.concat(
        F.lit(SPLIT_PREFIX), seed.cast("string"), F.lit("_r"), F.concat_ws("_", *tags),
        F.lit("_"), F.date_format(generated_at, NAME_TIME),
    )
    return _given_or(given, made)


def export_name(seed: Column, n_shards: Column, generated_at: Column, given: Column | None = None) -> Column:
    """Identifier of an export; a given one wins unless it is blank."""
    made = F.concat(
        F.lit(EXPORT_PREFIX), seed.cast("string"), F.lit("_n"), n_shards.cast("string"),
        F.lit("_"), F.date_format(generated_at, NAME_TIME),
    )
    return _given_or(given, made)


def _given_or(given: Column | None, made: Column) -> Column:
    return made if given is None else F.coalesce(F.nullif(F.trim(given), F.lit("")), made)


def export_rows(df: DataFrame, export_id: str, seed: int = DEFAULT_SEED, n_shards: int = 16) -> DataFrame:
    """Projection of the training manifest with shard and export lineage."""
    positive_int(n_shards, "n_shards")
    columns = ["image_id", "processed_bytes", "label_idx", "split", "split_id"]
    require_cols(df, columns, "training manifest")
    return df.select(
        *columns,
        hashing.shard_id(F.col("image_id"), seed, n_shards).alias("shard_id"),
        F.lit(export_id).alias("export_id"),
        F.lit(seed).cast("int").alias("shard_seed"),
        F.lit(n_shards).cast("int").alias("n_shards"),
    )


def counts_by_split(df: DataFrame) -> DataFrame:
    """``(split, rows, rows_total)`` for the three splits; an absent split counts 0."""
    per_split = [F.count_if(F.col("split") == name).alias(name) for name in SPLITS]
    total = sum((F.col(name) for name in SPLITS[1:]), F.col(SPLITS[0]))
    pairs = F.array(*[F.struct(F.lit(name).alias("split"), F.col(name).alias("rows")) for name in SPLITS])
    return df.agg(*per_split).select(F.inline(pairs), total.alias("rows_total"))
