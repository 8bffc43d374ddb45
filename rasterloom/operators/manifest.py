"""From a file listing to a labelled manifest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from rasterloom.functions import paths
from rasterloom.functions.checks import require_cols
from rasterloom.session import broadcast_within

# Column sets of the manifests.
BRONZE = ["image_id", "raw_path", "pathology", "label_idx", "modality", "file_size"]
EXPORT_INPUT = ["image_id", "processed_bytes", "label_idx", "split", "split_id"]


def keep_images(files: DataFrame) -> DataFrame:
    """Rows of a listing whose ``path`` is a visible image file."""
    return files.where(paths.is_image(F.col("path")))


def enrich_manifest(files: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Ids, class, modality and size derived from ``path`` and ``length``; ``keep`` passes columns on."""
    require_cols(files, ["path", "length"], "file listing")
    path = F.col("path")
    return files.select(
        paths.image_id(path).alias("image_id"),
        path.alias("raw_path"),
        paths.pathology(paths.parent_dir(path)).alias("pathology"),
        paths.modality(paths.parent_dir(path)).alias("modality"),
        F.col("length").cast("long").alias("file_size"),
        *keep,
    )


def has_class(df: DataFrame) -> DataFrame:
    """Rows with a usable class name."""
    return df.where(F.col("pathology") != "")


def has_label(df: DataFrame) -> DataFrame:
    """Rows with a label index."""
    return df.where(F.col("label_idx").isNotNull())


def normal_only(df: DataFrame, label_idx: int) -> DataFrame:
    """Rows of the normal class."""
    return df.where(F.col("label_idx") == label_idx)


def label_mapping(df: DataFrame) -> DataFrame:
    """``(pathology, label_idx)``: distinct class names in binary order, numbered from 0.

    The window runs over the distinct names only, one row per class directory;
    the rows of the manifest are reduced by a partial aggregate before that.
    """
    names = has_class(df).select("pathology").distinct()
    rank = F.row_number().over(Window.orderBy("pathology"))
    return names.select("pathology", (rank - 1).alias("label_idx"))


def attach_labels(df: DataFrame, mapping: DataFrame) -> DataFrame:
    """Left join to the mapping; a class without a label gets null.

    The mapping is measured before it is broadcast, so the manifest is not
    shuffled while the class list is small, and still joins when it is not.
    """
    return df.join(broadcast_within(mapping), "pathology", "left")


def build_manifest(files: DataFrame) -> DataFrame:
    """Bronze manifest of a file listing: one row per image."""
    rows = enrich_manifest(keep_images(files))
    return attach_labels(rows, label_mapping(rows)).select(*BRONZE)


def select_manifest(df: DataFrame, columns: list[str] = BRONZE) -> DataFrame:
    """Fixed projection, plus ``request_id`` when the rows belong to requests."""
    require_cols(df, columns)
    carried = [name for name in ("request_id",) if name in df.columns and name not in columns]
    return df.select(*carried, *columns)


def optional_col(df: DataFrame, name: str, kind: str | T.DataType) -> Column:
    """The column cast to ``kind``, or a typed null when the frame lacks it."""
    held = F.col(name) if name in df.columns else F.lit(None)
    return held.cast(kind).alias(name)
