"""Parquet tables: manifests, partitioned writes and published versions."""

from __future__ import annotations

import posixpath
import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from rasterloom.functions.checks import require_partition_cols
from rasterloom.functions.hashing import salt

INFERENCE = "spark.sql.sources.partitionColumnTypeInference.enabled"

# Sort columns inside manifest files.
FILE_ORDER = ["pathology", "modality", "raw_path"]


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Parquet scan that keeps partition values as text, so class ``007`` stays ``007``."""
    before = spark.conf.get(INFERENCE)
    spark.conf.set(INFERENCE, "false")
    try:
        return spark.read.parquet(path)
    finally:
        spark.conf.set(INFERENCE, before)


def repartition_by(df: DataFrame, n: int | None, cols: list[str]) -> DataFrame:
    """Repartition by a number, by columns, by both, or not at all."""
    if n is None:
        return df.repartition(*cols) if cols else df
    return df.repartition(n, *cols)


def spread(df: DataFrame, n: int | None, cols: list[str], id_col: str = "image_id", pieces: int | None = None) -> DataFrame:
    """Repartition by ``cols``, but let each value reach up to ``pieces`` tasks.

    Hashing by three split names alone would send 70 % of the images through
    one task; the salt comes from the id, so the spread is reproducible.
    """
    if not cols or id_col not in df.columns:
        return repartition_by(df, n, cols)
    parts = pieces or n or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(c) for c in cols] + [salt(F.col(id_col), parts)]
    return df.repartition(n, *keys) if n else df.repartition(*keys)


def sort_in_files(df: DataFrame, cols: list[str] = FILE_ORDER) -> DataFrame:
    """Sort inside each task by the columns that exist, for tight row-group statistics."""
    known = [c for c in cols if c in df.columns]
    return df.sortWithinPartitions(*known) if known else df


def out_of_order(held: DataFrame, cols: list[str]) -> DataFrame:
    """Rows of written files that stand before a smaller row, counted per value of the first of ``cols`` (nulls first).

    Rows are compared while the files are scanned, batch by batch; only the ends
    of each piece of consecutive rows of one value are joined to their successors,
    so no file, and no order of its rows, has to fit a task.
    """
    rows = held.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at"), *cols)
    fields = [rows.schema[c] for c in cols]
    ends = [T.StructField(f"{side}_{f.name}", f.dataType) for side in ("first", "last") for f in fields]
    schema = T.StructType([T.StructField("file", T.StringType()), T.StructField("start", T.LongType()), T.StructField("stop", T.LongType()), *ends, T.StructField("wrong", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            below, above = batch.slice(0, batch.num_rows - 1), batch.slice(1)
            at = batch.column("at").to_numpy()
            cut = (np.diff(at) != 1) | ~_same(below.column("file"), above.column("file")) | ~_same(below.column(cols[0]), above.column(cols[0]))
            starts = np.append(0, np.flatnonzero(cut) + 1)
            stops = np.append(starts[1:], batch.num_rows)
            falls = np.append(0, np.cumsum(_greater([below.column(c) for c in cols], [above.column(c) for c in cols]) & ~cut))
            sides = [batch.take(pa.array(which)).column(c) for which in (starts, stops - 1) for c in cols]
            yield pa.RecordBatch.from_arrays(
                [batch.column("file").take(pa.array(starts)), pa.array(at[starts]), pa.array(at[stops - 1] + 1), *sides, pa.array(falls[stops - 1] - falls[starts])],
                names=schema.names,
            )

    pieces = rows.mapInArrow(run, schema)
    after = pieces.select("file", F.col("start").alias("stop"), F.struct(*[f"first_{c}" for c in cols]).alias("following"))
    met = pieces.join(after, ["file", "stop"], "left")
    wrong = F.col("wrong") + F.coalesce(F.struct(*[f"last_{c}" for c in cols]) > F.col("following"), F.lit(False)).cast("long")
    return met.groupBy(F.col(f"first_{cols[0]}").alias(cols[0])).agg(F.sum(wrong).alias("out_of_order"))


def _same(one: pa.Array, other: pa.Array) -> np.ndarray:
    """Whether values are equal; nulls are."""
    both_null = pc.and_(pc.is_null(one), pc.is_null(other))
    return pc.or_(pc.fill_null(pc.equal(one, other), False), both_null).to_numpy(zero_copy_only=False)


def _greater(ones: list[pa.Array], others: list[pa.Array]) -> np.ndarray:
    """Whether rows are greater, by their first differing column; a null is less than a value."""
    found, even = np.zeros(len(ones[0]), bool), np.ones(len(ones[0]), bool)
    for one, other in zip(ones, others):
        more = pc.or_(pc.fill_null(pc.greater(one, other), False), pc.and_(pc.is_valid(one), pc.is_null(other)))
        found |= even & more.to_numpy(zero_copy_only=False)
        even &= _same(one, other)
    return found


def write_partitioned(df: DataFrame, path: str, partition_by: list[str] = (), mode: str = "overwrite") -> int:
    """Write Parquet and return the rows written, counted while they are written."""
    require_partition_cols(df, partition_by)
    seen = Observation(f"written-{uuid.uuid4().hex}")
    writer = df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(prepare_target(path))
    return seen.get["rows"]


def prepare_target(path: str, current: str | None = None) -> str:
    """Refuse a filesystem root, and an output that is its own ``current`` version."""
    scheme, place = re.match(r"(?:([^/:]*:)(//[^/]*)?)?(.*)", path, re.S).group(1, 3)
    if posixpath.normpath("/" + place if scheme or place.startswith("/") else place).strip("/") in ("", "."):
        raise ValueError(f"refusing to replace a filesystem root: {path!r}")
    if current is not None and posixpath.normpath(current) == posixpath.normpath(path):
        raise ValueError("the current path must differ from the output path")
    return path


def write_predictions(df: DataFrame, path: str, n: int | None = None, partition_by: list[str] = ()) -> int:
    """Write predictions, partitioned as asked; returns the rows written."""
    require_partition_cols(df, partition_by)
    return write_partitioned(spread(df, n, list(partition_by)), path, list(partition_by))
