"""Secret scans over a ledger of blobs, with DataFrame functions only.

A blob is the SHA-256 of a text. The ledger records which blobs were scanned
under which rule versions and the spans found. An update scans one row per blob
that lacks a rule, with the lacking rules only, and adds rows; findings join
back to every place that holds the blob. Blobs and places are small rows: a
blob at a third of all places is counted with partial minima and joined under
adaptive skew handling, while texts are shuffled once, by row.

A span in the ledger names the rule and version that found it. Findings take
the spans of the given rules alone, so an upgraded rule replaces its old spans
and rules may be added or moved; a ledger row that is there twice counts once.

Spans are code points, end exclusive. Matches are leftmost and do not overlap
within a kind; those too short are dropped after matching. Null texts count as
empty and have no spans.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from rasterloom.llm.texts import keyed


@dataclass(frozen=True)
class Rule:
    """A kind of secret. What ``group`` matched must have ``least`` characters."""

    kind: str
    version: int
    pattern: str
    group: int = 0
    least: int = 1

    @property
    def name(self) -> str:
        return f"{self.kind}:{self.version}"


# The kinds in the order of their spans.
BASE = (
    Rule("assign", 1, r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", 1, r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", 1, r"[0-9a-f]{24,}", 0, 24),
)
MORE = (
    Rule("github", 1, r"gh[pousr]_[A-Za-z0-9]{36,}", 0, 40),
    Rule("pem", 1, r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1),
)
RULES = BASE + MORE

SPANS = "array<struct<start:bigint,rule:string,end:bigint>>"
LEDGER = f"blob binary, rules array<string>, spans {SPANS}"


def blob_of(text: str) -> Column:
    return F.unhex(F.sha2(F.col(text), 256))


def places(history: DataFrame) -> DataFrame:
    """Every row of the history with the blob it holds."""
    return keyed(history).select("rid", "rkey", "doc_id", blob_of("text").alias("blob"))


def hits(rule: Rule) -> Column:
    """Lengths of the stretch before each match, of the match, and of its group."""
    found = F.regexp_extract_all("text", F.lit(rule.pattern), F.lit(0))
    measured = F.arrays_zip(
        F.transform(found, F.length).alias("size"),
        F.transform(F.split("text", rule.pattern, -1), F.length).alias("gap"),
        F.transform(F.regexp_extract_all("text", F.lit(rule.pattern), F.lit(rule.group)), F.length).alias("value"),
    )
    return F.when(F.size(found) > 0, measured)


def update_ledger(history: DataFrame, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows to add to the ledger for the blobs and rule versions of the history it lacks."""
    every = F.array(*[F.lit(rule.name) for rule in rules])
    first = places(history).groupBy("blob").agg(F.min(F.struct("rid", "rkey")).alias("at"))
    if ledger is None:
        lacking = first.withColumn("rules", every)
    else:
        done = ledger.groupBy("blob").agg(F.flatten(F.collect_set("rules")).alias("done"))
        lacking = first.join(done, "blob", "left").withColumn("rules", F.array_except(every, F.coalesce("done", F.array().cast("array<string>"))))
        lacking = lacking.where(F.size("rules") > 0)
    todo = lacking.select(F.col("at.rid").alias("rid"), F.col("at.rkey").alias("rkey"), "blob", "rules")

    texts = keyed(history).select("rid", "rkey", "text").join(todo, ["rid", "rkey"])
    # naming the blob keeps the patterns behind the join, so that copies of a blob are not scanned
    each = F.array(
        *[
            F.struct(F.lit(i).alias("kind"), F.lit(rule.least).alias("least"), F.when(F.array_contains("rules", rule.name) & F.col("blob").isNotNull(), hits(rule)).alias("hits"))
            for i, rule in enumerate(rules)
        ]
    )
    rows = texts.select("blob", F.filter(each, lambda one: one["hits"].isNotNull()).alias("found")).where(F.size("found") > 0)
    matches = rows.dropDuplicates(["blob"]).select("blob", F.explode("found").alias("of")).select("blob", "of.kind", "of.least", F.posexplode("of.hits").alias("n", "hit"))
    whole = matches.where(F.col("hit.size").isNotNull())
    ends = F.expr("sum(hit.gap + hit.size) OVER (PARTITION BY blob, kind ORDER BY n)")
    spans = (
        whole.withColumn("end", ends)
        .where(F.col("hit.value") >= F.col("least"))
        .select("blob", F.struct((F.col("end") - F.col("hit.size")).alias("start"), F.get(every, "kind").alias("rule"), "end").alias("span"))
        .groupBy("blob")
        .agg(F.array_sort(F.collect_list("span")).alias("spans"))
    )
    empty = F.array().cast(SPANS)
    return todo.select("blob", "rules").join(spans, "blob", "left").select("blob", "rules", F.coalesce("spans", empty).alias("spans"))


def findings(history: DataFrame, ledger: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``doc_id`` and the ``spans`` that the given rules found in every row of the history, by start and kind (place in ``rules``)."""
    names = F.array(*[F.lit(rule.name) for rule in rules])
    spans = F.transform("spans", lambda span: F.struct(span["start"].alias("start"), (F.array_position(names, span["rule"]) - 1).cast("int").alias("kind"), span["end"].alias("end")))
    current = ledger.select("blob", F.filter(spans, lambda span: span["kind"] >= 0).alias("spans"))
    held = current.groupBy("blob").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("spans")))).alias("spans"))
    return places(history).join(held, "blob", "left").select("doc_id", "spans")


def count_of(spans: str, kind: int) -> Column:
    """How many of the spans are of one kind."""
    return F.size(F.filter(spans, lambda span: span["kind"] == kind)).cast("long")


def listed(spans: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """``kind:start:end`` of the spans, comma-joined."""
    names = F.array(*[F.lit(rule.kind) for rule in rules])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")
