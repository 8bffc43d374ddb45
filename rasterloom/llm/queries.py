"""One query per operator over its whole table, and the SQL for those that SQL can express."""

from __future__ import annotations

import zlib

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

import corpus_pipeline
from rasterloom.llm import align, bpe, decontaminate, fingerprints, language, lines, periodic, quality, secrets, simhash, substrings, toxicity, warc
from rasterloom.llm.training import id_remainder


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def held_out(remainder: int, divisor: int) -> Column:
    return F.coalesce(id_remainder(divisor) == remainder, F.lit(False))


def predicted(score: str = "score") -> Column:
    return (F.col(score) >= 0.5).cast("int").alias("predicted")


def op1_fingerprints(spark: SparkSession, sf: str) -> DataFrame:
    return fingerprints.edited_likeness(table(spark, sf, "documents"))


def op2_quality(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    marks = table(spark, sf, "labels").select("doc_id", F.col("quality").alias("label"))
    scored = quality.score(docs, *quality.fit(docs, marks, ~held_out(1, 3)))
    return scored.select(F.col("row.doc_id").alias("doc_id"), "score").select("doc_id", held_out(1, 3).alias("held_out"), "score", predicted())


def op3_secrets(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    found = secrets.findings(docs, secrets.update_ledger(docs))
    base = F.filter("spans", lambda span: span["kind"] < len(secrets.BASE))
    counts = [secrets.count_of("spans", i).alias(f"n_{rule.kind}") for i, rule in enumerate(secrets.BASE)]
    return found.select("doc_id", *counts, F.sha2(secrets.listed(base), 256).alias("base_sha256"), secrets.listed(F.col("spans")).alias("spans"))


def op4_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    kept = lines.dedup_lines(table(spark, sf, "documents"))
    return kept.select(F.col("row.doc_id").alias("doc_id"), "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op5_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    return decontaminate.find_items(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


def op6_bpe(spark: SparkSession, sf: str, path: str | None = None) -> DataFrame:
    encoded = bpe.encode(table(spark, sf, "documents"), bpe.Vocabulary(path or vocabulary_path()))
    return encoded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def vocabulary_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op7_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    marks = table(spark, sf, "labels").select("doc_id", F.col("toxic").alias("label"))
    scored = toxicity.score(docs, toxicity.fit(docs, marks, ~held_out(0, 5)))
    return scored.select(F.col("row.doc_id").alias("doc_id"), "score").select("doc_id", held_out(0, 5).alias("held_out"), "score", predicted())


def op8_warc(spark: SparkSession, sf: str) -> DataFrame:
    return warc.derive(warc.responses(table(spark, sf, "pages")))


def op9_simhash(spark: SparkSession, sf: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf, "documents"))
    return found.select("doc_id", simhash.digits(F.col("fp")).alias("fingerprint"), "component_id")


def op10_language(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    found = language.predict(docs, language.fit(docs, ~held_out(1, 3)))
    return found.select("doc_id", held_out(1, 3).alias("held_out"), "lang_pred", "score", "rejected")


def op11_substrings(spark: SparkSession, sf: str) -> DataFrame:
    found = substrings.dedup_substrings(table(spark, sf, "documents"))
    removed = F.aggregate(F.zip_with("starts", "ends", lambda start, end: end - start), F.lit(0).cast("long"), lambda total, size: total + size)
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("starts").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op12_alignment(spark: SparkSession, sf: str) -> DataFrame:
    return align.aligned(table(spark, sf, "documents"), align.Pair(vocabulary_path("byte_bpe_50k.json"), vocabulary_path("piece_bpe_32k.model")))


def planted_repeats(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """Every tenth text by crc32 of the id gets a repeating tail."""
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def op13_periodic_runs(spark: SparkSession, sf: str) -> DataFrame:
    found = periodic.detect(table(spark, sf, "documents"), planted_repeats)
    best = F.array_max(F.transform("runs", lambda run: F.struct(run["length"].alias("length"), (-run["start"]).alias("start"), (-run["period"]).alias("period"))))
    listed = F.concat_ws("", F.transform("runs", lambda run: F.concat(run["start"], F.lit(","), run["length"], F.lit(","), run["period"], F.lit("\n"))))
    columns = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    return columns.select(
        "doc_id",
        "n_runs",
        (-F.col("best.start")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"),
        F.expr("1000 * best.length DIV -best.period").alias("exponent_milli"),
        "runs_sha256",
        "collapsed_sha256",
    )


def pipeline(spark: SparkSession, sf: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf)


QUERIES = {
    query.__name__: query
    for query in (
        op1_fingerprints, op2_quality, op3_secrets, op4_line_dedup, op5_decontamination, op6_bpe, op7_toxicity, op8_warc, op9_simhash,
        op10_language, op11_substrings, op12_alignment, op13_periodic_runs, pipeline,
    )
}


def _spans_sql(i: int, rule: secrets.Rule) -> str:
    pattern = rule.pattern.replace("'", "''")
    return f"""
SELECT doc_id, '{rule.kind}' AS kind, {i} AS k, unnest(range(1, len(m) + 1)) AS i, m, v, g, {rule.least} AS least FROM (
  SELECT doc_id, regexp_extract_all(t, '{pattern}', 0) AS m, regexp_extract_all(t, '{pattern}', {rule.group}) AS v,
         string_split_regex(t, '{pattern}') AS g FROM d)"""


SECRETS_SQL = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
h AS ({" UNION ALL ".join(_spans_sql(i, rule) for i, rule in enumerate(secrets.RULES))}),
s AS (
  SELECT doc_id, kind, k,
         (coalesce(list_sum(list_transform(g[1:i], lambda x: length(x))), 0) + coalesce(list_sum(list_transform(m[1:i-1], lambda x: length(x))), 0))::BIGINT AS b,
         length(m[i]) AS n
  FROM h WHERE length(v[i]) >= least),
p AS (
  SELECT doc_id, count(*) FILTER (k = 0) AS n_assign, count(*) FILTER (k = 1) AS n_access, count(*) FILTER (k = 2) AS n_hex,
         string_agg(kind || ':' || b || ':' || (b + n), ',' ORDER BY b, k) FILTER (k < {len(secrets.BASE)}) AS base,
         string_agg(kind || ':' || b || ':' || (b + n), ',' ORDER BY b, k) AS spans
  FROM s GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN p USING (doc_id)
"""

LINES_SQL = f"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS i FROM d),
k AS (SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
s AS (SELECT key, max(doc_id) AS top FROM k WHERE length(key) >= {lines.MIN_CHARS} GROUP BY key HAVING count(DISTINCT doc_id) >= {lines.MIN_DOCS}),
j AS (SELECT k.doc_id, k.line, k.i, s.top IS NOT NULL AND k.doc_id <> s.top AS gone FROM k LEFT JOIN s USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM j GROUP BY doc_id
"""

ORACLE = {"op3_secrets": SECRETS_SQL, "op4_line_dedup": LINES_SQL}
