"""Columns derived from file paths."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The layout `<root>/<pathology> <modality>/<file>` of a raw tree.
IMAGE_FILE = r"(?i)\.(jpg|jpeg|png)$"
FILE_NAME = r"([^/\\]+)$"
PARENT_DIR = r"[/\\]([^/\\]+)[/\\][^/\\]+$"
MODALITY = r"(T1C\+|T1|T2)$"
PATHOLOGY = r"^(.*)\s+(?:T1C\+|T1|T2)$"


def parent_dir(path: Column) -> Column:
    """Name of the directory that holds the file."""
    return F.regexp_extract(path, PARENT_DIR, 1)


def modality(directory: Column) -> Column:
    """Modality suffix of a class directory, null when it has none.

    Null rather than an empty string: an empty partition value would come back
    from a partitioned table as null anyway.
    """
    return F.nullif(F.regexp_extract(directory, MODALITY, 1), F.lit(""))


def pathology(directory: Column) -> Column:
    """Class name: the directory without its modality, or the whole directory."""
    return F.coalesce(F.nullif(F.regexp_extract(directory, PATHOLOGY, 1), F.lit("")), directory)


def image_id(path: Column) -> Column:
    """SHA-256 hex of the path as Spark lists it, for manifests and requests alike."""
    return F.sha2(path, 256)


def is_image(path: Column) -> Column:
    """Image extension in any case, and not a hidden file."""
    return path.rlike(IMAGE_FILE) & ~F.regexp_extract(path, FILE_NAME, 1).startswith(".")


def local_path(uri: Column) -> Column:
    """``file:`` URI to a percent-decoded path that keeps its host; others unchanged.

    For the percent-encoded spellings (``image.origin``, ``_metadata.file_path``)
    only. A plus sign and a percent sign that starts no escape stay themselves.
    """
    # file:///a and file:/a give /a, file://host/a gives //host/a
    rest = F.regexp_replace(F.regexp_replace(uri, r"^file:", ""), r"^//(?=/)", "")
    guarded = F.regexp_replace(F.replace(rest, F.lit("+"), F.lit("%2B")), r"%(?![0-9A-Fa-f]{2})", "%25")
    return F.when(uri.startswith("file:"), F.url_decode(guarded)).otherwise(uri)


def partition_value(value: Column) -> Column:
    """A value that is safe as one directory level."""
    return F.translate(value, "/", "_")


def request_paths(root: str, request_id: Column) -> dict[str, Column]:
    """Locations that belong to one request."""
    home = F.concat_ws("/", F.lit(root), request_id)
    # File and directory names below a request's folder.
    names = {
        "raw_dir": "raw",
        "metadata_path": "metadata.json",
        "status_path": "status.json",
        "manifest_bronze_path": "manifest_bronze.parquet",
        "manifest_silver_path": "manifest_silver.parquet",
        "predictions_path": "predictions.parquet",
        "artifacts_dir": "artifacts",
        "result_path": "result.json",
        "error_path": "error.json",
    }
    return {key: F.concat_ws("/", home, F.lit(name)) for key, name in names.items()}
