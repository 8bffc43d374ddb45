"""Sharded exports: round trip, reconciliation."""

import glob

import pytest
from pyspark.sql import functions as F

from rasterloom.operators import exports, splits
from rasterloom.sources import examples


def rows(spark, n=300):
    base = spark.range(n).select(
        F.sha2(F.col("id").cast("string"), 256).alias("image_id"),
        F.encode(F.repeat(F.col("id").cast("string"), (F.col("id") % 50 + 1).cast("int")), "UTF-8").alias("processed_bytes"),
        (F.col("id") % 7).cast("int").alias("label_idx"),
    )
    return splits.export_rows(splits.assign_split(base, split_id="s"), "e", n_shards=4)


@pytest.mark.parametrize("pieces", [1, 3])
def test_round_trip(spark, tmp_path, pieces):
    path = str(tmp_path / "out")
    source = rows(spark)
    manifest = examples.export_shards(source, path, 8, pieces)
    got = {(r.split, r.shard_id): r.n for r in manifest.groupBy("split", "shard_id").agg(F.sum("rows_written").alias("n")).collect()}
    want = {(r.split, r.shard_id): r["count"] for r in source.groupBy("split", "shard_id").count().collect()}
    assert got == want
    per_shard = manifest.groupBy("split", "shard_id").count().agg(F.max("count")).first()[0]
    assert per_shard == 1 if pieces == 1 else per_shard > 1
    for relative in (r.relative_path for r in manifest.collect()):
        assert glob.glob(f"{path}/{relative}")
    back = examples.read_examples(spark, path)
    same = ["image_id", "split", "split_id", "label_idx", "shard_id"]
    assert sorted(map(tuple, back.select(*same).collect())) == sorted(map(tuple, source.select(*same).collect()))
    assert back.agg(F.sum("image_bytes_len")).first()[0] == source.agg(F.sum(F.octet_length("processed_bytes"))).first()[0]
    assert examples.read_examples(spark, path, limit=20).count() == 20


def test_overwrite_replaces(spark, tmp_path):
    path = str(tmp_path / "out")
    examples.export_shards(rows(spark), path)
    examples.export_shards(rows(spark, 50), path)
    assert examples.read_examples(spark, path).count() == 50


def test_null_bytes_fail(spark, tmp_path):
    broken = rows(spark, 20).withColumn("processed_bytes", F.when(F.col("label_idx") != 3, F.col("processed_bytes")))
    with pytest.raises(Exception, match="processed_bytes must not be null"):
        examples.export_shards(broken, str(tmp_path / "out"))


def test_complete_export_reconciles(spark, tmp_path):
    source = rows(spark)
    manifest = examples.export_shards(source, str(tmp_path / "out"))
    left = exports.rows_by_split(source, "input_count")
    assert exports.reconcile(left, exports.written_by_split(manifest, "output_count")).count() == 0
    missing = exports.reconcile(left.where("split <> 'val'"), exports.written_by_split(manifest, "output_count")).first()
    assert (missing.split, missing.input_count) == ("val", 0)


def test_shard_manifest_and_split_files(spark, tmp_path):
    path = str(tmp_path / "out")
    examples.write_shard_manifest(examples.export_shards(rows(spark), path), path + "-m", "e9")
    manifest = spark.read.parquet(f"{path}-m/{examples.MANIFEST_DIR}")
    assert manifest.columns == ["export_id", "split", "shard_id", "relative_path", "rows_written"]
    files = exports.split_files(manifest.withColumn("split", F.regexp_replace("split", "val", "other")), path).collect()
    assert {f.split for f in files} == {"train", "test"}
    assert [tuple(f) for f in files] == sorted(tuple(f) for f in files)
