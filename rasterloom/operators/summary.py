"""Dataset summary: one pass over the manifest, everything else from its small counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from rasterloom.operators.manifest import has_label
from rasterloom.operators.splits import SPLITS
from rasterloom.session import cut_lineage

# Columns of the written summary.
SUMMARY = (
    "export_id string, generated_at timestamp, seed int, n_shards int, rows_total long,"
    " rows_by_split map<string,long>, files_total long, files_by_split map<string,long>,"
    " distinct_labels int, labels array<struct<label_idx:int,pathology:string>>,"
    " label_counts_by_split map<string,map<string,long>>, input_manifest_path string,"
    " output_path string, current_output_path string, shard_manifest_path string, dataset_summary_path string,"
    " output_format string, compression string, image_height int, image_width int, channels int"
)
IMAGE_SPEC = ["new_height", "new_width", "channels"]


def label_cells(df: DataFrame) -> DataFrame:
    """Rows per (split, label, class) with the range of image shapes in each.

    The only aggregate that reads the manifest; map-side partial counts keep a
    dominant class from reaching one task as rows.
    """
    sums = [F.count("*").alias("rows")]
    if set(IMAGE_SPEC) <= set(df.columns):
        spec = F.struct(*IMAGE_SPEC)
        sums += [F.min(spec).alias("least_spec"), F.max(spec).alias("most_spec")]
    return df.groupBy("split", "label_idx", "pathology").agg(*sums)


def index_labels(cells: DataFrame) -> DataFrame:
    """Add ``label_idx`` to aggregated rows: the rank of the class name, from 0.

    The same numbers as ``label_mapping``, without its second reading of the
    manifest and without a join. ``cells`` has a few rows per class.
    """
    usable = F.coalesce(F.col("pathology") != "", F.lit(False))
    rank = F.dense_rank().over(Window.partitionBy(usable).orderBy("pathology")) - 1
    return cells.withColumn("label_idx", F.when(usable, rank))


def label_counts_by_split(cells: DataFrame) -> DataFrame:
    """``(split, label_idx, rows)``, null labels dropped."""
    return has_label(cells).groupBy("split", "label_idx").agg(F.sum("rows").alias("rows"))


def label_rows(df: DataFrame) -> DataFrame:
    """Distinct ``(label_idx, pathology)`` by label, null labels dropped."""
    return has_label(df).select("label_idx", "pathology").distinct().orderBy("label_idx", "pathology")


def distinct_labels(df: DataFrame) -> DataFrame:
    """Number of labels: with null as one value, and without."""
    values = df.select("label_idx").distinct()
    return values.agg(
        F.count("*").alias("distinct_labels"), F.count("label_idx").alias("distinct_non_null_labels")
    )


def image_spec(cells: DataFrame) -> DataFrame:
    """One row ``(image_height, image_width, channels)``: the only shape, or nulls."""
    return cells.agg(_only_spec(cells).alias("spec")).select(*_spec_columns())


def _only_spec(cells: DataFrame) -> Column:
    if "least_spec" not in cells.columns:
        return F.max(F.lit(None).cast("struct<new_height:int,new_width:int,channels:int>"))
    return F.when(F.min("least_spec") == F.max("most_spec"), F.min("least_spec"))


def _spec_columns() -> list[Column]:
    # Names of the image shape in the summary.
    names = dict(zip(IMAGE_SPEC, ("image_height", "image_width", "channels")))
    return [F.col(f"spec.{ours}").alias(name) for ours, name in names.items()]


def dataset_summary(cells: DataFrame, shard_manifest: DataFrame, lineage: dict[str, object]) -> DataFrame:
    """One row with nested counts.

    ``cells`` has a row per split and class. It is materialised, so that the
    parts of the summary do not each read the manifest again.
    """
    cells = cut_lineage(cells)
    per_split = label_counts_by_split(cells).groupBy("split").agg(
        F.map_from_entries(
            F.array_sort(F.collect_list(F.struct(F.col("label_idx").cast("string"), "rows")))
        ).alias("per_label")
    )
    # every split has a key, also one without rows
    none = F.create_map().cast("map<string,bigint>")
    nested = per_split.agg(
        F.create_map(
            *[
                part
                for name in SPLITS
                for part in (F.lit(name), F.coalesce(F.max_by("per_label", F.when(F.col("split") == name, 1)), none))
            ]
        ).alias("label_counts_by_split")
    )
    named = F.when(F.col("label_idx").isNotNull(), F.struct("label_idx", "pathology"))
    counts = cells.agg(
        *[_sum_where(F.col("rows"), name).alias(f"rows_{name}") for name in SPLITS],
        (F.count_distinct("label_idx") + F.max(F.col("label_idx").isNull().cast("int"))).cast("int").alias("distinct_labels"),
        F.array_sort(F.collect_set(named)).alias("labels"),
        _only_spec(cells).alias("spec"),
    )
    files = shard_manifest.agg(*[F.count_if(F.col("split") == name).alias(f"files_{name}") for name in SPLITS])
    # the other one-row results come in as scalar subqueries, not as joins
    whole = counts.withColumns({"files": files.select(F.struct("*")).scalar(), "label_counts_by_split": nested.scalar()})
    row = whole.select("*", "files.*")
    return row.select(
        *[F.lit(value).alias(name) for name, value in lineage.items()],
        _three_way("rows", "total"),
        _three_way("rows", "map"),
        _three_way("files", "total"),
        _three_way("files", "map"),
        "distinct_labels",
        "labels",
        "label_counts_by_split",
        *_spec_columns(),
    )


def _sum_where(value: Column, split: str) -> Column:
    return F.coalesce(F.sum(F.when(F.col("split") == split, value)), F.lit(0))


def _three_way(what: str, form: str) -> Column:
    if form == "total":
        return (F.col(f"{what}_train") + F.col(f"{what}_val") + F.col(f"{what}_test")).alias(f"{what}_total")
    pairs = [part for name in SPLITS for part in (F.lit(name), F.col(f"{what}_{name}"))]
    return F.create_map(*pairs).alias(f"{what}_by_split")


def write_summary(row: DataFrame, path: str) -> None:
    """Write the one-row summary as JSON."""
    row.coalesce(1).write.mode("overwrite").json(path)


def read_summary(spark: SparkSession, path: str) -> DataFrame:
    """The summary written with an export; a missing one is an error when it is read."""
    return spark.read.schema(SUMMARY).json(path)


def label_of(labels: DataFrame, name: str) -> DataFrame:
    """Label of a class by trimmed name: one row, null when no class has the name."""
    found = F.trim("pathology") == F.lit(name.strip())
    return labels.agg(F.min(F.when(found, F.col("label_idx"))).alias("label_idx"))


def num_classes(labels: DataFrame, given: int | None = None) -> DataFrame:
    """Given number, else highest label + 1, else distinct labels with null as one; no row at all is an error."""
    seen = F.count_distinct("label_idx") + F.max(F.col("label_idx").isNull().cast("int"))
    none = F.raise_error(F.lit("no labels to infer the number of classes from"))
    inferred = F.coalesce(F.max("label_idx") + 1, seen.cast("int"), none.cast("int"))
    value = F.lit(given).cast("int") if given is not None else inferred
    return labels.agg(value.alias("num_classes"))


def label_count(counts: DataFrame, wanted: DataFrame) -> DataFrame:
    """Rows of each wanted ``(split, label_idx)``: 0 when the split lacks the label, null for no split.

    The three splits are always known, also one without rows.
    """
    rows = F.when(F.col("split").isin(*SPLITS), F.coalesce("rows", F.lit(0)))
    return wanted.join(counts, ["split", "label_idx"], "left").withColumn("rows", rows)


def steps(rows: Column, batch_size: int) -> Column:
    """Batches that cover ``rows``, at least one."""
    return F.greatest(F.lit(1), F.ceil(rows / batch_size)).cast("long")
