"""Accounting of a sharded export."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rasterloom.operators.splits import SPLITS

# Columns of the shard manifest.
SHARD_MANIFEST = ["export_id", "split", "shard_id", "relative_path", "rows_written"]


def rows_by_split(df: DataFrame, name: str) -> DataFrame:
    """Input rows per split."""
    return df.groupBy("split").agg(F.count("*").alias(name))


def written_by_split(manifest: DataFrame, name: str = "rows_written") -> DataFrame:
    """Written rows per split, from the shard manifest."""
    return manifest.groupBy("split").agg(F.sum("rows_written").alias(name))


def files_by_split(manifest: DataFrame) -> DataFrame:
    """Files per split."""
    return manifest.groupBy("split").agg(F.count("*").alias("files"))


def fill_counts(df: DataFrame, names: list[str]) -> DataFrame:
    """A count that is missing on one side of a join is 0."""
    return df.na.fill(0, names)


def reconcile(input_counts: DataFrame, output_counts: DataFrame) -> DataFrame:
    """Splits whose ``input_count`` and ``output_count`` differ; none means all rows arrived.

    Both sides are already aggregated to one row per split.
    """
    both = input_counts.join(output_counts, "split", "full")
    counts = ["input_count", "output_count"]
    return fill_counts(both, counts).where(F.col(counts[0]) != F.col(counts[1]))


def split_files(manifest: DataFrame, root: str) -> DataFrame:
    """``(split, file)`` sorted; splits other than the three are dropped.

    One row per file: the list of a split stays a distributed table, since it
    grows with the export.
    """
    return (
        manifest.where(F.col("split").isin(*SPLITS))
        .select("split", F.concat_ws("/", F.lit(root), "relative_path").alias("file"))
        .orderBy("split", "file")
    )
