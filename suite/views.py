"""Views of the given tables as a listing, as images and as requests, in both engines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from rasterloom.functions.paths import image_id
from rasterloom.operators.splits import assign_split

# A file listing from documents: hidden files, other extensions, four modalities, a normal class.
MANIFEST = """
SELECT doc_id, 'file:/raw/' || (CASE WHEN source='src0' THEN '_NORMAL' ELSE 'Class ' || source END)
 || (CASE doc_id % 5 WHEN 0 THEN ' T1' WHEN 1 THEN ' T1C+' WHEN 2 THEN ' T2' WHEN 3 THEN 'T1' ELSE '' END) || '/'
 || (CASE WHEN doc_id % 17 = 0 THEN '.' ELSE '' END) || 'img_' || CAST(doc_id AS VARCHAR(20))
 || (CASE doc_id % 7 WHEN 0 THEN '.png' WHEN 1 THEN '.JPEG' WHEN 2 THEN '.txt' ELSE '.jpg' END) AS path,
 n_chars AS length FROM documents"""

# Status events and setting overrides of requests from events.
REQUESTS = """
SELECT event_id, ts, 'r' || CAST(user_id AS VARCHAR(20)) AS request_id,
 CASE event_type WHEN 'signup' THEN 'pending' WHEN 'view' THEN 'queued' WHEN 'click' THEN 'running_inference'
                 WHEN 'purchase' THEN 'done' ELSE 'failed' END AS status,
 CASE WHEN value > 250 THEN 'p99' WHEN value > 100 THEN 'custom' END AS threshold_mode,
 CASE WHEN value > 100 AND value <= 250 THEN value / 100 END AS custom_threshold FROM events"""

# Raw files of requests from documents: some requests get one, others none or several.
UPLOADS = """
SELECT 'file:/requests/r' || CAST(n_chars % 1500 AS VARCHAR(20)) || '/raw/scan_' || CAST(doc_id AS VARCHAR(20)) || '.png' AS path,
 n_chars AS length FROM documents"""


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _over(spark: SparkSession, sf: str, name: str, text: str) -> DataFrame:
    # the FROM clause binds to the table of this scale factor
    return spark.sql(text.replace(f"FROM {name}", f"FROM {{{name}}}"), **{name: table(spark, sf, name)})


def manifest(spark: SparkSession, sf: str, *more: str) -> DataFrame:
    """The listing, with further columns of ``documents``."""
    return _over(spark, sf, "documents", MANIFEST.replace(" FROM documents", "".join(f", {name}" for name in more) + " FROM documents"))


def requests(spark: SparkSession, sf: str) -> DataFrame:
    return _over(spark, sf, "events", REQUESTS)


def uploads(spark: SparkSession, sf: str) -> DataFrame:
    return _over(spark, sf, "documents", UPLOADS)


def images(spark: SparkSession, sf: str) -> DataFrame:
    """Embeddings as 8x8 grey images: ``(vec_id, label_idx, image_id, pixels, height, width)``."""
    low = F.array_min("embedding").cast("double")
    high = F.array_max("embedding").cast("double")
    level = F.transform(
        "embedding", lambda e: F.floor((e.cast("double") - F.col("low")) / (F.col("high") - F.col("low")) * 255)
    )
    return (
        table(spark, sf, "embeddings")
        .select("vec_id", F.col("label").alias("label_idx"), "embedding", low.alias("low"), high.alias("high"))
        .select(
            "vec_id",
            "label_idx",
            image_id(F.col("vec_id").cast("string")).alias("image_id"),
            F.unhex(F.array_join(F.transform(level, lambda v: F.lpad(F.hex(v), 2, "0")), "")).alias("pixels"),
            F.lit(8).alias("height"),
            F.lit(8).alias("width"),
        )
    )


def silver(spark: SparkSession, sf: str) -> DataFrame:
    """The images as split silver rows."""
    rows = images(spark, sf).select(
        "vec_id", "image_id", "label_idx",
        F.concat(F.lit("file:/raw/"), F.col("vec_id").cast("string"), F.lit(".png")).alias("raw_path"),
        F.col("pixels").alias("processed_bytes"),
        F.lit("v1").alias("transform_version"),
    )
    return assign_split(rows, split_id="s1")


def in_split(df: DataFrame, name: str) -> DataFrame:
    return df.where(F.col("split") == name)
