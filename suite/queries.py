"""Queries by name: each takes a session and the folder of the tables, and returns rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rasterloom.functions import paths
from rasterloom.operators import (
    exports, images as image_ops, manifest as manifests, models, registry, requests as request_ops,
    sampling, scoring, splits, statistics, summary, training,
)
from rasterloom.operators.images import TransformOptions
from rasterloom.plans import jobs
from rasterloom.session import cut_lineage, scratch_path
from rasterloom.sources import examples, tables
from rasterloom.streaming import requests as serving
from rasterloom.streaming.status import follow_status
from suite import views
from suite.views import in_split, silver, table

SIDE = 8
NORMAL = 0
CLASSES = 10


def _hex(column: str, name: str | None = None) -> Column:
    return F.hex(column).alias(name or column)


def _rounded(*names: str) -> list[Column]:
    return [F.round(name, 6).alias(name) for name in names]


# -- manifest ------------------------------------------------------------------------------


def manifest_scan_filter(spark: SparkSession, sf: str) -> DataFrame:
    """Image files of the listing, from a manifest written and read back."""
    path = scratch_path(spark, "listing")
    tables.write_partitioned(views.manifest(spark, sf), path)
    return manifests.keep_images(tables.read_manifest(spark, path)).select("doc_id", "path", "length")


def manifest_row_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Rows listed and rows kept."""
    listing = views.manifest(spark, sf)
    return listing.agg(
        F.count("*").alias("rows_listed"), F.count_if(paths.is_image(F.col("path"))).alias("rows_kept")
    )


def manifest_enrich(spark: SparkSession, sf: str) -> DataFrame:
    return manifests.enrich_manifest(manifests.keep_images(views.manifest(spark, sf)))


def label_mapping(spark: SparkSession, sf: str) -> DataFrame:
    return manifests.label_mapping(manifest_enrich(spark, sf)).orderBy("label_idx")


def bronze(spark: SparkSession, sf: str) -> DataFrame:
    return manifests.build_manifest(views.manifest(spark, sf))


def manifest_labelled(spark: SparkSession, sf: str) -> DataFrame:
    """Bronze manifest, written by class and modality and read back."""
    path = scratch_path(spark, "bronze")
    by = ["pathology", "modality"]
    tables.write_partitioned(tables.sort_in_files(tables.spread(bronze(spark, sf), None, by)), path, by)
    return tables.read_manifest(spark, path).select(*manifests.BRONZE)


def uri_paths(spark: SparkSession, sf: str) -> DataFrame:
    """Path spellings: raw, percent-encoded, with empty authority, with a host, without a scheme."""
    rows = views.manifest(spark, sf)
    bare = F.regexp_replace("path", "^file:", "")
    encoded = F.replace(F.replace(bare, F.lit(" "), F.lit("%20")), F.lit("Class"), F.lit("Cl%61ss"))
    prefixes = {"short": "file:", "long": "file://", "host": "file://host", "bare": "", "stray": "file:"}
    variants = F.array(
        *[
            F.struct(
                F.lit(name).alias("spelling"),
                F.concat(F.lit(prefix), encoded, F.lit("%zz%" if name == "stray" else "")).alias("uri"),
            )
            for name, prefix in prefixes.items()
        ]
    )
    return rows.select("doc_id", F.inline(variants)).select(
        "doc_id", "spelling",
        paths.local_path(F.col("uri")).alias("local"),
        paths.partition_value(F.col("uri")).alias("partition_value"),
        manifests.optional_col(rows, "request_id", "string"),
    )


def manifest_preview(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.preview(manifest_enrich(spark, sf), 10)


def preview_membership(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of a preview, and how many of them the manifest has."""
    rows = manifest_enrich(spark, sf)
    shown = sampling.preview(rows, 10)
    known = rows.select("image_id", F.lit(1).alias("known")).distinct()
    return shown.join(known, "image_id", "left").agg(F.count("*").alias("shown"), F.count("known").alias("known"))


def manifest_reconciled(spark: SparkSession, sf: str) -> DataFrame:
    """Silver rows and dead letters of a manifest whose images are partly gone, in a tree that holds others too."""
    path = F.concat(F.lit("file:/raw/_NORMAL/"), F.col("vec_id"), F.lit(".png")).alias("path")
    given = views.images(spark, sf).select("vec_id", path, F.lit(64).alias("length"), "label_idx", "height", "width", F.lit(1).alias("channels"), F.col("pixels").alias("data"))
    bronze = jobs.wanted_images(manifests.enrich_manifest(given.where("vec_id % 5 <> 0"), keep=("label_idx",)))
    tree = given.where("vec_id % 7 <> 0")
    options = TransformOptions(SIDE, SIDE, "stretch")
    made = image_ops.transform_images(jobs.manifest_images(bronze, tree), options)
    gone = image_ops.transform_images(jobs.missing_images(bronze, made), options).withColumn("error", F.lit("missing image"))
    return made.unionByName(gone).select("image_id", "label_idx", F.octet_length("processed_bytes").alias("size"), "error")


# -- splits and shards ---------------------------------------------------------------------


def split_manifest(spark: SparkSession, sf: str) -> DataFrame:
    """Split bronze rows without the label join, for queries that aggregate first."""
    return splits.assign_split(manifest_enrich(spark, sf), split_id="s1")


def split_assignment(spark: SparkSession, sf: str) -> DataFrame:
    return split_manifest(spark, sf).select("image_id", "split", "split_id", "split_seed", "split_ratios")


def split_counts(spark: SparkSession, sf: str) -> DataFrame:
    return splits.counts_by_split(split_manifest(spark, sf))


def split_label_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Rows per split, label, class and modality: one reading, labels numbered after the aggregate."""
    counts = split_manifest(spark, sf).groupBy("split", "pathology", "modality").agg(F.count("*").alias("rows"))
    return summary.index_labels(counts).select("split", "label_idx", "pathology", "modality", "rows")


def split_registry_names(spark: SparkSession, sf: str) -> DataFrame:
    """Names of the splits and exports that each order stands for."""
    val = (F.col("o_orderkey") % 3 + 1) * 0.05
    rows = table(spark, sf, "orders").select(
        "o_orderkey", F.col("o_custkey").alias("seed"), F.col("o_orderdate").alias("at"),
        (1 - 2 * val).alias("train"), val.alias("val"), (F.col("o_orderkey") % 64 + 1).alias("n_shards"),
        F.when(F.col("o_orderstatus") == "O", F.lit("  ")).when(F.col("o_orderstatus") == "P", F.lit(" given ")).alias("given"),
    )
    ratios = [F.col("train"), F.col("val"), F.col("val")]
    return rows.select(
        "o_orderkey",
        splits.split_name(F.col("seed"), ratios, F.col("at"), F.col("given")).alias("split_id"),
        splits.export_name(F.col("seed"), F.col("n_shards"), F.col("at"), F.col("given")).alias("export_id"),
    )


def wide_key_split(spark: SparkSession, sf: str) -> DataFrame:
    """Split and shard sizes of every line item, hashed by order key and line number."""
    key = F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))
    rows = table(spark, sf, "lineitem").select(F.sha2(key, 256).alias("image_id"))
    return (
        splits.assign_split(rows)
        .withColumn("shard_id", splits.hashing.shard_id(F.col("image_id"), 42, 16))
        .groupBy("split", "shard_id").agg(F.count("*").alias("rows"))
    )


def export_input(spark: SparkSession, sf: str) -> DataFrame:
    """Export rows of the documents' manifest; the document text stands for image bytes."""
    rows = manifests.keep_images(views.manifest(spark, sf, "text")).select(
        "doc_id",
        paths.image_id(F.col("path")).alias("image_id"),
        (F.col("doc_id") % 20).cast("int").alias("label_idx"),
        F.encode("text", "UTF-8").alias("processed_bytes"),
    )
    return splits.export_rows(splits.assign_split(rows, split_id="s1"), "e1")


def shard_assignment(spark: SparkSession, sf: str) -> DataFrame:
    rows = splits.assign_split(
        manifest_enrich(spark, sf).withColumns(
            {"processed_bytes": F.lit(None).cast("binary"), "label_idx": F.lit(None).cast("int")}
        ),
        split_id="s1",
    )
    return splits.export_rows(rows, "e1").drop("processed_bytes", "label_idx")


def export_parquet_shards(spark: SparkSession, sf: str) -> DataFrame:
    """Shard manifest of a Parquet export, written next to it and read back."""
    path = scratch_path(spark, "shards")
    counts = examples.export_shards(export_input(spark, sf), path, files_per_shard=1)
    examples.write_shard_manifest(counts, path + "-manifest", "e1")
    written = spark.read.parquet(f"{path}-manifest/{examples.MANIFEST_DIR}")
    totals = exports.written_by_split(written, "rows_in_split").join(exports.files_by_split(written), "split")
    folder = F.regexp_replace("relative_path", "/[^/]+$", "").alias("folder")
    return written.join(totals, "split").select(
        "export_id", "split", "shard_id", folder, "rows_written", "rows_in_split", "files"
    )


def export_example_shards(spark: SparkSession, sf: str) -> DataFrame:
    """Training rows written in three files per shard and read back whole."""
    path = scratch_path(spark, "examples")
    examples.export_shards(export_input(spark, sf), path, files_per_shard=3)
    return examples.read_examples(spark, path)


def _fake_write(df: DataFrame) -> DataFrame:
    """Shard manifest rows of a split manifest without its T2 images."""
    kept = df.where(F.coalesce(F.col("modality") != "T2", F.lit(True)))
    return kept.withColumn("shard_id", splits.hashing.shard_id(F.col("image_id"), 42, 16)).groupBy(
        "split", "shard_id"
    ).agg(F.count("*").alias("rows_written"))


def export_reconcile(spark: SparkSession, sf: str) -> DataFrame:
    """Splits whose written rows differ from the input: T2 images are left out, test goes missing."""
    rows = split_manifest(spark, sf)
    written = exports.written_by_split(_fake_write(rows).where(F.col("split") != "test"), "output_count")
    return exports.reconcile(exports.rows_by_split(rows, "input_count"), written)


def split_files(spark: SparkSession, sf: str) -> DataFrame:
    rows = split_manifest(spark, sf).withColumn("shard_id", splits.hashing.shard_id(F.col("image_id"), 42, 16))
    shards = rows.select("split", "shard_id").distinct()
    relative = F.format_string("split=%s/shard_id=%d/part-%05d.tfrecord", "split", "shard_id", "shard_id")
    return exports.split_files(shards.withColumn("relative_path", relative), "/data/e1")


# -- summary -------------------------------------------------------------------------------


def _summary_cells(spark: SparkSession, sf: str) -> DataFrame:
    sized = split_manifest(spark, sf).withColumns(
        {"new_height": F.lit(224), "new_width": F.lit(224), "channels": F.lit(1), "label_idx": F.lit(None).cast("int")}
    )
    return summary.index_labels(summary.label_cells(sized))


def _summary_row(spark: SparkSession, sf: str) -> DataFrame:
    shards = _fake_write(split_manifest(spark, sf))
    return summary.dataset_summary(_summary_cells(spark, sf), shards, {"export_id": "e1", "seed": 42, "n_shards": 16})


def dataset_summary(spark: SparkSession, sf: str) -> DataFrame:
    """The one-row summary, flattened to one row per split and label."""
    return _flat_summary(_summary_row(spark, sf))


def summary_stored(spark: SparkSession, sf: str) -> DataFrame:
    """The summary as it is read back from the file that an export writes."""
    path = scratch_path(spark, "summary")
    summary.write_summary(_summary_row(spark, sf), path)
    return _flat_summary(summary.read_summary(spark, path))


def _flat_summary(row: DataFrame) -> DataFrame:
    per_split = row.select("*", F.explode("label_counts_by_split").alias("split", "per_label"))
    return per_split.select("*", F.explode("per_label").alias("label", "rows")).select(
        "export_id", "seed", "n_shards", "rows_total", "files_total", "distinct_labels", "split",
        F.col("rows_by_split")[F.col("split")].alias("rows_in_split"),
        F.col("files_by_split")[F.col("split")].alias("files_in_split"),
        F.col("label").cast("int").alias("label_idx"),
        F.filter("labels", lambda x: x["label_idx"] == F.col("label").cast("int"))[0]["pathology"].alias("pathology"),
        "rows", "image_height", "image_width", "channels",
    )


def label_inventory(spark: SparkSession, sf: str) -> DataFrame:
    return summary.label_rows(_summary_cells(spark, sf))


def distinct_labels(spark: SparkSession, sf: str) -> DataFrame:
    """Labels of all files when text files carry none: null counts once, or not at all."""
    rows = manifests.enrich_manifest(views.manifest(spark, sf)).select(
        F.when(~F.col("raw_path").endswith(".txt"), F.crc32("pathology")).alias("label_idx")
    )
    return summary.distinct_labels(rows)


def label_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """Label, number of classes, rows and steps of the normal class and of every other one, by split."""
    cells = cut_lineage(_summary_cells(spark, sf))
    labels = summary.label_rows(cells)
    counts = summary.label_counts_by_split(cells)
    names = F.explode(F.array(*[F.lit(name) for name in (*splits.SPLITS, "holdout")])).alias("split")
    wanted = labels.select(names, "label_idx").unionByName(
        labels.agg((F.max("label_idx") + 1).alias("label_idx")).select(names, "label_idx")
    )
    return summary.label_count(counts, wanted).withColumns(
        {
            "normal_idx": summary.label_of(labels, " _NORMAL ").scalar(),
            "absent_idx": summary.label_of(labels, "no such class").scalar(),
            "num_classes": summary.num_classes(labels).scalar(),
            "steps": summary.steps(F.col("rows"), 4),
        }
    )


# -- registries ----------------------------------------------------------------------------


def _versions(spark: SparkSession, sf: str) -> DataFrame:
    """A version per event type and tier of values."""
    tier = F.when(F.col("value") > 250, 2).when(F.col("value") > 100, 1).otherwise(0)
    order = F.struct("ts", "event_id")
    return (
        table(spark, sf, "events")
        .groupBy(F.col("event_type").alias("version"), tier.alias("tier"))
        .agg(F.max_by(F.struct("ts", "event_id"), order).alias("last"), F.count("*").alias("rows_written"))
        .select(
            "version", "tier", F.col("last.ts").alias("generated_at"), "rows_written",
            F.concat(F.lit("/out/"), F.col("last.event_id").cast("string")).alias("output_path"),
        )
    )


def registry_latest(spark: SparkSession, sf: str) -> DataFrame:
    """Three upserts of versions taken from events, read back newest first."""
    path = scratch_path(spark, "registry")
    for step in range(3):
        registry.upsert_registry(_versions(spark, sf).where(F.col("tier") == step), "version", path)
    return _with_current(registry.read_registry(spark, path))


def registry_appended(spark: SparkSession, sf: str) -> DataFrame:
    """The same versions appended: those of one name stay side by side."""
    path = scratch_path(spark, "registry")
    for step in range(3):
        registry.append_registry(_versions(spark, sf).where(F.col("tier") == step), path)
    return _with_current(registry.read_registry(spark, path))


def _with_current(rows: DataFrame) -> DataFrame:
    return rows.withColumn("current_output_path", registry.current_version(rows).scalar())


def files_in_order(spark: SparkSession, sf: str) -> DataFrame:
    """Lines dealt by return flag and sorted in files: files a flag lies in, and rows that stand before a smaller order."""
    path = scratch_path(spark, "lines")
    rows = table(spark, sf, "lineitem").select("l_returnflag", "l_orderkey", "l_linenumber")
    tables.sort_in_files(tables.repartition_by(rows, 4, ["l_returnflag"]), ["l_returnflag", "l_orderkey", "absent"]).write.parquet(path)
    held = spark.read.parquet(path)
    counts = held.groupBy("l_returnflag").agg(F.count("*").alias("rows"), F.count_distinct("_metadata.file_path").alias("files"))
    wrong = tables.out_of_order(held, ["l_returnflag", "l_orderkey"]).withColumnRenamed("l_returnflag", "flag")
    return counts.join(wrong, F.col("l_returnflag").eqNullSafe(F.col("flag"))).drop("flag")


# -- samples and statistics ----------------------------------------------------------------


def sample_per_class(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.sample_per_class(manifest_enrich(spark, sf), 5, 42, method="md5").select("image_id", "pathology")


def sample_n(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.sample_n(manifest_enrich(spark, sf), 100, 42, method="md5").select("image_id", "pathology")


def class_counts(spark: SparkSession, sf: str) -> DataFrame:
    return statistics.class_counts(manifest_enrich(spark, sf))


def class_balance(spark: SparkSession, sf: str) -> DataFrame:
    row = statistics.class_balance(manifest_enrich(spark, sf).groupBy("pathology").agg(F.count("*").alias("images")))
    return row.select(*_rounded("mean_images", "median_images"), "min_images", "max_images", *_rounded("std_images"))


def image_dims(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "documents").select(
        (F.col("n_chars") % 640).alias("width"), (F.col("n_chars") % 480).alias("height")
    )
    found = statistics.describe_dims(rows, ["width", "height"])
    return found.select("dimension", *_rounded(*[c for c in found.columns if c != "dimension"]))


def best_epoch(spark: SparkSession, sf: str) -> DataFrame:
    """Events as the history of one run per event type; a run stops after 50 epochs without a better value."""
    history = table(spark, sf, "events").select(
        F.col("event_type").alias("run"), F.col("event_id").alias("epoch"), F.col("value").alias("metric")
    )
    highest = statistics.best_epoch(history, "max", 50, width=5000).withColumn("mode", F.lit("max"))
    lowest = statistics.best_epoch(history, "min").withColumn("mode", F.lit("min"))
    return highest.unionByName(lowest)


# -- image kernels -------------------------------------------------------------------------


def gray_from_bgr(spark: SparkSession, sf: str) -> DataFrame:
    """Grey levels of colour images whose three channels are shifted copies."""
    digits = F.hex("pixels")

    def shifted(by: int) -> Column:
        return F.concat(F.substring(digits, 2 * by + 1, 128), F.substring(digits, 1, 2 * by))

    def pixel(channel: Column, i: Column) -> Column:
        return channel.substr(i * 2 + 1, F.lit(2))

    channels = [shifted(by) for by in range(3)]
    rows = views.images(spark, sf).withColumns({f"c{by}": channel for by, channel in enumerate(channels)})
    data = F.array_join(
        F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: F.concat(*[pixel(F.col(f"c{c}"), i) for c in range(3)])), ""
    )
    colour = rows.select("vec_id", "height", "width", F.lit(3).alias("channels"), F.unhex(data).alias("data"))
    return image_ops.gray_pixels(colour).select("vec_id", _hex("pixels"))


def foreground_mask(spark: SparkSession, sf: str) -> DataFrame:
    """Components and filled masks at four thresholds; nothing is brighter than 255."""
    levels = F.explode(F.array(*[F.lit(t) for t in (12, 100, 128, 255)])).alias("threshold")
    rows = views.images(spark, sf).select("vec_id", "pixels", "height", "width", levels)
    return image_ops.foreground_masks(rows, "threshold").select("vec_id", "threshold", _hex("component"), _hex("mask"))


def _prepared(spark: SparkSession, sf: str, **options) -> DataFrame:
    rows = views.images(spark, sf).select("vec_id", "pixels", "height", "width")
    return image_ops.prepare_images(rows, TransformOptions(**options)).select(
        "vec_id", _hex("prepared"), "prepared_height", "prepared_width"
    )


def foreground_crop(spark: SparkSession, sf: str) -> DataFrame:
    narrow = _prepared(spark, sf, threshold=128, crop=True, margin=1).withColumn("margin", F.lit(1))
    return narrow.unionByName(_prepared(spark, sf, threshold=128, crop=True).withColumn("margin", F.lit(4)))


def normalize_mask(spark: SparkSession, sf: str) -> DataFrame:
    whole = _prepared(spark, sf, threshold=255, normalized=True, masked=True).withColumn("threshold", F.lit(255))
    masked = _prepared(spark, sf, threshold=100, normalized=True, masked=True).withColumn("threshold", F.lit(100))
    return masked.unionByName(whole).select("vec_id", "threshold", "prepared")


def _resized(spark: SparkSession, sf: str, strategy: str, sizes: list[tuple[int, int]]) -> DataFrame:
    targets = F.inline(
        F.array(*[F.struct(F.lit(w).alias("new_width"), F.lit(h).alias("new_height")) for w, h in sizes])
    )
    rows = views.images(spark, sf).select("vec_id", "pixels", "height", "width", targets)
    made = image_ops.resize_images(rows, "new_width", "new_height", strategy)
    return made.select("vec_id", "new_width", "new_height", _hex("resized"))


def resize_stretch(spark: SparkSession, sf: str) -> DataFrame:
    return _resized(spark, sf, "stretch", [(4, 4), (6, 6), (12, 10)])


def resize_center_crop(spark: SparkSession, sf: str) -> DataFrame:
    return _resized(spark, sf, "center_crop", [(6, 3), (3, 5)])


def resize_keep_aspect_pad(spark: SparkSession, sf: str) -> DataFrame:
    return _resized(spark, sf, "keep_aspect_pad", [(6, 4), (12, 10)])


def silver_transform(spark: SparkSession, sf: str) -> DataFrame:
    """Decoded images to silver rows: crop, normalise, mask, shrink to fit and pad."""
    decoded = views.images(spark, sf).select(
        "vec_id", "image_id", "label_idx", F.col("pixels").alias("data"), "height", "width", F.lit(1).alias("channels"),
        F.concat(F.lit("file:/raw/"), F.col("vec_id").cast("string"), F.lit(".png")).alias("raw_path"),
    )
    options = TransformOptions(6, 4, "keep_aspect_pad", 128, crop=True, normalized=True, masked=True, margin=1)
    made = image_ops.transform_images(decoded, options)
    return made.select(
        "image_id", "raw_path", "label_idx", _hex("processed_bytes"), "processed_file_size", "orig_width",
        "orig_height", "new_width", "new_height", "channels", "transform_version", "error",
    )


def shape_check(spark: SparkSession, sf: str) -> DataFrame:
    """Images of label 3 lose four pixels, images of label 5 all of them."""
    cut = F.when(F.col("label_idx") == 3, F.substring("processed_bytes", 1, 60)).when(
        F.col("label_idx") != 5, F.col("processed_bytes")
    )
    rows = silver(spark, sf).select("vec_id", cut.alias("processed_bytes"))
    return image_ops.check_shape(rows, SIDE, SIDE).select("vec_id", "error")


# -- models and scores ---------------------------------------------------------------------


def _means(rows: DataFrame) -> models.ClassMeans:
    return models.fit_class_means(in_split(rows, "train"), SIDE, SIDE)


def class_means(spark: SparkSession, sf: str) -> DataFrame:
    """Images and mean brightness per class of the training split, from the vector sums."""
    sums = models.class_sums(in_split(silver(spark, sf), "train"), SIDE, SIDE)
    total = F.aggregate("mean", F.lit(0.0), lambda a, v: a + v)
    return sums.select("label_idx", "images", F.round(total / 64, 6).alias("brightness"),
                       F.round(F.get("mean", F.lit(9)), 6).alias("pixel_9"))


def _shown(pictures: DataFrame, *names: str) -> DataFrame:
    return pictures.select("vec_id", *[_hex(name) for name in names])


def error_maps(spark: SparkSession, sf: str) -> DataFrame:
    """Reconstruction and scaled error of each image under the mean of the normal class."""
    rows = silver(spark, sf)
    made = scoring.artifacts(rows, reconstructor=_means(rows).reconstructor(NORMAL))
    return _shown(made, "reconstruction", "error_map")


def overlay(spark: SparkSession, sf: str) -> DataFrame:
    """Red overlay where the error is above 0.25; none when it never is."""
    rows = silver(spark, sf)
    made = scoring.artifacts(rows, reconstructor=_means(rows).reconstructor(NORMAL), threshold=F.lit(0.25))
    return _shown(made, "anomaly_overlay")


def saliency(spark: SparkSession, sf: str) -> DataFrame:
    rows = silver(spark, sf)
    return _shown(scoring.artifacts(rows, classifier=_means(rows).classifier()), "gradcam", "gradcam_overlay")


def classify_topk(spark: SparkSession, sf: str) -> DataFrame:
    """Top 5 classes of each image, through the JSON text and back."""
    rows = silver(spark, sf)
    text = scoring.classify(rows, _means(rows).classifier(), 5).select(
        "vec_id", "classifier_pred_idx", "classifier_pred_label", "classifier_confidence",
        F.to_json("topk").alias("classifier_topk_json"),
    )
    return scoring.parse_topk(text).select(
        "vec_id", "classifier_pred_idx", "classifier_pred_label", *_rounded("classifier_confidence"),
        "rank", "label_idx", "label_name", *_rounded("probability"),
    )


def classifier_eval(spark: SparkSession, sf: str) -> DataFrame:
    rows = silver(spark, sf)
    ranked = scoring.classify(in_split(rows, "test"), _means(rows).classifier())
    scores = statistics.evaluate(ranked.withColumn("pred_idx", F.col("classifier_pred_idx")))
    return scores.select("rows", *_rounded("accuracy", "loss"))


def image_error_stats(spark: SparkSession, sf: str) -> DataFrame:
    rows = silver(spark, sf)
    return scoring.image_errors(rows, _means(rows).reconstructor(NORMAL)).select(
        "vec_id", *_rounded("max_error", "mean_error")
    )


def _thresholds(rows: DataFrame, model: models.Reconstructor) -> DataFrame:
    return scoring.run_calibration(in_split(rows, "train"), in_split(rows, "val"), model, NORMAL)


def threshold_calibration(spark: SparkSession, sf: str) -> DataFrame:
    rows = silver(spark, sf)
    info = _thresholds(rows, _means(rows).reconstructor(NORMAL))
    exact = ["normal_images_evaluated", "normal_label_idx", "normal_label_name", "image_height", "image_width"]
    return info.select(*_rounded(*[c for c in info.columns if c not in exact]), *exact)


def anomaly_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Every image under the four threshold modes."""
    rows = silver(spark, sf)
    model = _means(rows).reconstructor(NORMAL)
    info = _thresholds(rows, model).first().asDict()
    modes = ("strict", "p99", "p95", "custom")
    limits = F.array(*[scoring.pick_threshold(F.lit(mode), F.lit(0.25), info) for mode in modes])
    counted = scoring.kernel_scores(rows.select("vec_id", "processed_bytes", limits.alias("limits")), None, model, "limits")
    # images are scored once; the modes part only afterwards
    named = F.array(*[F.lit(mode) for mode in modes]).alias("mode")
    each = counted.select("vec_id", "max_error", F.inline(F.arrays_zip(named, F.col("limits").alias("anomaly_threshold"), F.col("anomalous_pixel_counts").alias("anomalous_pixel_count"))))
    scored = scoring.with_anomaly(each, SIDE * SIDE)
    size = scoring.total_pixels(
        F.lit(None).cast("int"), F.lit(None).cast("int"), F.lit(None).cast("int"), F.lit(None).cast("int"),
        F.col("anomalous_pixel_count"), F.col("anomaly_ratio"),
    )
    return scored.select(
        "vec_id", "mode", *_rounded("max_error", "anomaly_threshold"), "anomaly_is_detected",
        "anomalous_pixel_count", *_rounded("anomaly_ratio"), size.alias("total_pixels"),
    )


def _predictions(rows: DataFrame, folder: str) -> DataFrame:
    means = _means(rows)
    model = means.reconstructor(NORMAL)
    info = _thresholds(rows, model).first().asDict()
    return scoring.predict(
        rows, means.classifier(), model, scoring.pick_threshold(F.lit("p95"), F.lit(None).cast("double"), info),
        ("classification", "anomaly_autoencoder"), 3, folder, True,
    )


def predictions(spark: SparkSession, sf: str) -> DataFrame:
    """The predictions table, written by transform version and read back, with the labels of its top k."""
    path = scratch_path(spark, "predictions")
    made = _predictions(silver(spark, sf), "/out/artifacts")
    tables.write_predictions(made, path, 8, ["transform_version"])
    rows = tables.read_manifest(spark, path)
    held = {key: F.col(key) for key in ("image_id", *scoring.ARTIFACT_SUFFIX)}
    shown = {key: scoring.artifact_path(held, key, F.lit("/req")) for key in ("anomaly_overlay_path", "gradcam_path")}
    labels = F.array_join(F.transform(F.from_json("classifier_topk_json", scoring.TOPK), lambda e: e["label_idx"].cast("string")), ",")
    real = ("classifier_confidence", "anomaly_max_error", "anomaly_threshold", "anomaly_ratio")
    return rows.select(
        *[c for c in scoring.PREDICTIONS if c not in (*real, "classifier_topk_json")],
        *_rounded(*real), labels.alias("topk_labels"),
        *[value.alias(f"shown_{key}") for key, value in shown.items()],
    )


def fitted_classifier(spark: SparkSession, sf: str) -> DataFrame:
    """Training history of the logistic classifier: accuracy and loss per penalty."""
    rows = silver(spark, sf)
    model = models.fit_classifier(in_split(rows, "train"), in_split(rows, "val"), SIDE, SIDE, (0.01, 0.1), 20)
    return spark.createDataFrame(model.history, "epoch long, accuracy double, loss double, penalty double")


TRAINING = training.Plan(epochs=4, rate=0.5, penalties=(0.01,), adam=False)


def _trained(rows: DataFrame) -> training.Network:
    return training.train(in_split(rows, "train"), in_split(rows, "val"), CLASSES, SIDE, SIDE, TRAINING)


def trained_classifier(spark: SparkSession, sf: str) -> DataFrame:
    """Best class of every image under the best epoch of a few full-batch steps."""
    rows = silver(spark, sf)
    found = scoring.classify(rows, _trained(rows), 1)
    return found.select("vec_id", F.col("classifier_pred_idx").alias("pred_idx"), *_rounded("classifier_confidence"))


def training_history(spark: SparkSession, sf: str) -> DataFrame:
    """Accuracy and loss of both splits after each epoch."""
    made = spark.createDataFrame(_trained(silver(spark, sf)).history, "epoch int, penalty double, accuracy double, loss double, val_accuracy double, val_loss double")
    return made.select("epoch", "penalty", *_rounded("accuracy", "loss", "val_accuracy", "val_loss"))


def fitted_reconstructor(spark: SparkSession, sf: str) -> DataFrame:
    """Errors of every image under the principal components of the normal class."""
    rows = silver(spark, sf)
    model = models.fit_reconstructor(in_split(rows, "train"), NORMAL, SIDE, SIDE, 8)
    return scoring.image_errors(rows, model).select("vec_id", *_rounded("max_error", "mean_error"))


def full_reconstructor(spark: SparkSession, sf: str) -> DataFrame:
    """With as many components as pixels every image is rebuilt without error."""
    rows = silver(spark, sf)
    model = models.fit_reconstructor(in_split(rows, "train"), NORMAL, SIDE, SIDE, SIDE * SIDE)
    return scoring.image_errors(rows, model).select("vec_id", *_rounded("max_error", "mean_error"))


# -- requests ------------------------------------------------------------------------------


def latest_status(spark: SparkSession, sf: str) -> DataFrame:
    return request_ops.latest_status(views.requests(spark, sf)).select("request_id", "status", "updated_at")


def _open(spark: SparkSession, sf: str) -> DataFrame:
    """Latest state of each request with its newest overrides."""
    rows = request_ops.latest_status(views.requests(spark, sf), ["threshold_mode", "custom_threshold"])
    number = F.regexp_extract("request_id", r"(\d+)$", 1).cast("int")
    return rows.withColumns(
        {
            "input_manifest_path": F.when(number % 7 == 0, F.concat(F.lit("/given/"), F.col("request_id"))),
            "has_silver": number % 5 == 0,
        }
    )


def status_merge(spark: SparkSession, sf: str) -> DataFrame:
    """Latest status with the newest value of each extra field, followed as a stream of events."""
    return follow_status(spark, f"{sf}/events.parquet", views.REQUESTS, ["threshold_mode", "custom_threshold"])


def status_machine(spark: SparkSession, sf: str) -> DataFrame:
    """The same states, from a state machine that forgets requests which have ended."""
    return follow_status(spark, f"{sf}/events.parquet", views.REQUESTS, ["threshold_mode", "custom_threshold"], machine=True)


def pending_requests(spark: SparkSession, sf: str) -> DataFrame:
    """Bronze rows of the pending requests, and why some have none."""
    waiting = cut_lineage(request_ops.pending(_open(spark, sf)))
    files = request_ops.raw_files(views.uploads(spark, sf))
    to_build = request_ops.needs_transform(waiting, files).select("request_id", F.lit(True).alias("to_build"))
    rows = request_ops.request_bronze(waiting, files)
    return rows.join(to_build, "request_id", "left").withColumn("to_build", F.coalesce("to_build", F.lit(False)))


def request_settings(spark: SparkSession, sf: str) -> DataFrame:
    base = {
        "top_k": 5, "threshold_mode": "strict", "write_visual_artifacts": True, "master": "local[1]",
        "partitions": 1, "partition_by": [], "enabled_outputs": ["classification", "anomaly_autoencoder"],
    }
    rows = request_ops.effective_settings(_open(spark, sf), base)
    places = paths.request_paths("/requests", F.col("request_id"))
    manifest = request_ops.input_manifest(
        F.col("input_manifest_path"), F.col("has_silver"), places["manifest_silver_path"], "/base/silver.parquet"
    )
    return rows.select(
        "request_id", "top_k", "threshold_mode", "custom_threshold", "write_visual_artifacts", "master", "partitions",
        F.array_join("partition_by", ",").alias("partition_by"), F.array_join("enabled_outputs", ",").alias("enabled_outputs"),
        manifest.alias("input_manifest"), *[place.alias(name) for name, place in places.items()],
    )


def request_results(spark: SparkSession, sf: str) -> DataFrame:
    """Result records: every image is scored for the request that shares its number."""
    rows = silver(spark, sf).withColumn("request_id", F.concat(F.lit("r"), F.col("vec_id").cast("string")))
    made = _predictions(rows, "/out/artifacts")
    shown = request_ops.results(_open(spark, sf), made, "/requests")
    first = F.col("first_prediction")
    return shown.select(
        "request_id", "status", "input_manifest_path", "predictions_path", "artifacts_dir", "rows",
        first["image_id"].alias("image_id"), first["classifier_pred_idx"].alias("classifier_pred_idx"),
        F.round(first["anomaly_max_error"], 6).alias("anomaly_max_error"),
    )


def served_requests(spark: SparkSession, sf: str) -> DataFrame:
    """The request stream, end to end: every request scores the images of one class.

    Requests come from the events with their newest overrides, go through the
    inbox, and are answered in micro-batches; every third is submitted again
    with other settings, which changes nothing. Shown are the state each ends
    in and what its predictions add up to.
    """
    root = scratch_path(spark, "service")
    rows = silver(spark, sf)
    rows.write.partitionBy("label_idx").parquet(f"{root}/silver")
    means = _means(rows)
    model = means.reconstructor(NORMAL)
    service = serving.Service(
        inbox=f"{root}/inbox", requests_root=f"{root}/requests", output=f"{root}/out",
        classifier=means.classifier(), reconstructor=model, thresholds=_thresholds(rows, model).first().asDict(),
        options=TransformOptions(SIDE, SIDE, "stretch"),
        base={"threshold_mode": "strict", "top_k": 1, "enabled_outputs": ["classification", "anomaly_autoencoder"]},
    )
    number = F.regexp_extract("request_id", r"(\d+)$", 1).cast("long")
    wanted = request_ops.latest_status(views.requests(spark, sf), ["threshold_mode", "custom_threshold"]).select(
        "request_id", "threshold_mode", "custom_threshold",
        # class 10 does not exist, so these requests fail
        F.concat(F.lit(f"{root}/silver/label_idx="), (number % 11).cast("string")).alias("input_manifest_path"),
    )
    serving.submit(wanted, service)
    serving.serve(spark, service, None).awaitTermination()
    again = wanted.where(number % 3 == 0).withColumns({"threshold_mode": F.lit("custom"), "custom_threshold": F.lit(-1.0)})
    again.write.mode("append").option("maxRecordsPerFile", serving.REQUESTS_PER_FILE).json(service.inbox)
    serving.serve(spark, service, None).awaitTermination()
    states = request_ops.latest_status(serving.status_events(spark, service.output)).select("request_id", "status")
    scored = serving.batch_table(spark, service.output, "scored").where("error IS NULL")
    sums = scored.groupBy("request_id").agg(
        F.count("*").alias("rows"),
        F.round(F.max("anomaly_threshold"), 6).alias("anomaly_threshold"),
        F.sum("anomalous_pixel_count").alias("anomalous_pixels"),
        F.count_if("anomaly_is_detected").alias("flagged"),
        F.sum("classifier_pred_idx").alias("class_sum"),
    )
    return states.join(sums, "request_id", "left")


def open_requests(spark: SparkSession, sf: str) -> DataFrame:
    return request_ops.open_requests(request_ops.latest_status(views.requests(spark, sf)))


QUERIES = {
    fn.__name__: fn
    for fn in (
        split_label_counts, manifest_scan_filter, manifest_row_counts, manifest_enrich, label_mapping,
        manifest_labelled, uri_paths, manifest_preview, split_assignment, split_counts, split_registry_names,
        wide_key_split, shard_assignment, export_parquet_shards, export_example_shards, export_reconcile,
        split_files, dataset_summary, label_inventory, distinct_labels, label_lookup, registry_latest, registry_appended, summary_stored, files_in_order,
        sample_per_class, sample_n, class_counts, class_balance, image_dims, best_epoch, gray_from_bgr,
        foreground_mask, foreground_crop, normalize_mask, resize_stretch, resize_center_crop,
        resize_keep_aspect_pad, silver_transform, shape_check, class_means, error_maps, overlay, saliency,
        classify_topk, classifier_eval, image_error_stats, threshold_calibration, anomaly_scores, predictions,
        fitted_classifier, trained_classifier, training_history, fitted_reconstructor, full_reconstructor, preview_membership,
        manifest_reconciled, latest_status, status_merge, status_machine, pending_requests,
        request_settings, request_results, open_requests, served_requests,
    )
}
