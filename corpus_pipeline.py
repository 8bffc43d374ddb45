"""A corpus from raw documents to token ids: five stages, each written and read again.

toxicity: documents scored toxic go. lines: lines that many documents hold go,
but for one document. near_duplicates: one document of each group stays, the
one with the least id (rows without id, or of equal id and text, count as one
group member each; ties stay in order of text). benchmarks: documents that hold
a benchmark item go. tokens: ids and decoded text of what is left.

Null texts count as empty in every stage; they have no tokens. Tables without
rows, or without labels or items, give what is left by stages that then find
nothing. Columns of any name pass through all stages but the last as they are;
``text`` and ``n_chars`` follow the lines that go.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from rasterloom.llm import bpe, decontaminate, lines, simhash, toxicity
from rasterloom.llm.training import id_remainder
from rasterloom.session import scratch_path

# The remainder of crc32(id) modulo 5 whose labels are never learned from.
HELD_OUT, FOLDS = 0, 5


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    marks = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", F.col("toxic").alias("label"))
    net = toxicity.fit(docs, marks, F.coalesce(id_remainder(FOLDS) != HELD_OUT, F.lit(True)))
    return toxicity.score(docs, net).where("score < 0.5").select("row.*")


def lines_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without their dropped lines; ``n_chars``, where there is one, follows."""
    new = {"text": F.col("kept"), "n_chars": F.length("kept").cast("long")}
    columns = [new[name].alias(name) if name in new else F.col(f"row.`{name}`").alias(name) for name in docs.columns]
    return lines.dedup_lines(docs).select(*columns)


def near_duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of each group of texts alike to 0.8: fingerprints meet, pigeonring chains prune, sets of shingles decide."""
    return simhash.one_of_each(docs)


def benchmarks_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.without_items(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokens_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    from public_tokenizers import path

    encoded = bpe.encode(docs, bpe.Vocabulary(path("word_bpe_49k.json")))
    return encoded.select("doc_id", "n_tokens", "ids", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("toxicity", toxicity_stage),
    ("lines", lines_stage),
    ("near_duplicates", near_duplicates_stage),
    ("benchmarks", benchmarks_stage),
    ("tokens", tokens_stage),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what the last one returns."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
