"""What the classifiers share: who may be learned from, bounded samples, sums of task partials."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from rasterloom.llm.texts import whole_text
from rasterloom.session import broadcast_within

SAMPLE_SEED = 20


def id_remainder(divisor: int) -> Column:
    """crc32 of the id as text, modulo; null for a null id."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % divisor


def share(seed: int = SAMPLE_SEED) -> Column:
    """A number in 0..1 from the id, the same for any order and partitioning."""
    return F.shiftrightunsigned(F.xxhash64(F.col("doc_id"), F.lit(seed)), 24) / F.lit(float(1 << 40))


def one_label(labels: DataFrame, label: str) -> DataFrame:
    """One row per id; where rows disagree the larger label counts."""
    return labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(label).alias("label"))


def sample(docs: DataFrame, marks: DataFrame, bound: int) -> DataFrame:
    """``text``, ``label`` and ``weight`` of about ``bound`` marked documents, each label's share equal.

    ``marks`` has ``doc_id`` and ``label``. The weight is the number of marked
    rows of that label per row taken. Only the taken ids, of a proven bound,
    are sent to the documents, which are not shuffled.
    """
    counts = {row["label"]: row["count"] for row in marks.groupBy("label").count().collect()}
    each = bound / max(1, len(counts))
    rate, weight = F.lit(0.0), F.lit(1.0)
    for label, count in counts.items():
        own = min(1.0, each / count)
        rate = F.when(F.col("label") == F.lit(label), own).otherwise(rate)
        weight = F.when(F.col("label") == F.lit(label), 1 / own).otherwise(weight)
    taken = marks.withColumn("weight", weight).where(share() < rate)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    return texts.join(F.broadcast(taken.limit(2 * bound)), "doc_id").select("doc_id", "text", "label", "weight")


def labelled(docs: DataFrame, marks: DataFrame) -> DataFrame:
    """``text``, ``label`` and a ``weight`` of 1 of every marked document; ids are sent to the documents while they are few."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    return texts.join(broadcast_within(marks.select("doc_id", "label")), "doc_id").select("doc_id", "text", "label", F.lit(1.0).alias("weight"))


def block_sums(rows: DataFrame, length: int, measure: Callable[[], Callable[[pa.RecordBatch, np.ndarray], None]], block: int = 16_384) -> np.ndarray:
    """Sum over all rows of a vector of fixed ``length``, which tasks add up in place.

    ``measure()`` returns a function that adds a batch to the vector. Each task
    sends its vector once, in blocks; blocks are added as a stream, and only
    the sums, of fixed size, come to the driver.
    """

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        add, total, used = measure(), np.zeros(length, np.float64), False
        for batch in batches:
            add(batch, total)
            used = used or batch.num_rows > 0
        if used:
            yield from emitted({at: total[at : at + block] for at in range(0, length, block)})

    def emitted(blocks: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
        for at, values in blocks.items():
            yield pa.RecordBatch.from_arrays([pa.array([at], pa.int64()), pa.array([values.astype(np.float32).tobytes()], pa.binary())], names=["at", "sums"])

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for at, raw in zip(batch.column("at").to_pylist(), batch.column("sums").to_pylist()):
                values = np.frombuffer(raw, np.float32)
                totals[at] = totals[at] + values if at in totals else values.astype(np.float64)
        yield from emitted(totals)

    schema = "at long, sums binary"
    result = np.zeros(length, np.float64)
    for row in rows.mapInArrow(partial, schema).repartition("at").mapInArrow(merged, schema).collect():
        values = np.frombuffer(row["sums"], np.float32)
        result[row["at"] : row["at"] + len(values)] = values
    return result


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def temperature(logits: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> float:
    """The divisor of the logits, from a fixed grid, with the least weighted log loss."""
    if not len(logits):
        return 1.0
    grid = np.exp(np.linspace(np.log(0.1), np.log(20), 60))
    losses = [float((weights * np.logaddexp(0, np.where(labels > 0, -1, 1) * logits / t)).sum()) for t in grid]
    return float(grid[int(np.argmin(losses))])
