"""Sums of long vectors over all rows: every task adds up its own, and the tasks' sums are merged in a tree."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

# Values of a block, and groups of tasks that are merged before all are.
BLOCK, GROUPS = 1 << 14, 64

PARTIAL = "at long, part int, total binary"


def _batch(at: list[int], part: int, totals: list[np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(at, pa.int64()), pa.array([part] * len(at), pa.int32()), pa.array([each.tobytes() for each in totals], pa.binary())],
        names=["at", "part", "total"],
    )


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of one place added up as a stream; a task holds one vector at most."""
    totals: dict[int, np.ndarray] = {}
    for batch in batches:
        for at, raw in zip(batch.column("at").to_pylist(), batch.column("total").to_pylist()):
            values = np.frombuffer(raw, np.float64)
            totals[at] = totals[at] + values if at in totals else values
    for at, values in totals.items():
        yield _batch([at], 0, [values])


def vector_sum(rows: DataFrame, length: int, start: Callable[[], Callable[[pa.RecordBatch, np.ndarray], None]]) -> np.ndarray:
    """Sum of a vector of ``length`` over all rows; zeros without rows.

    ``start`` runs once per task and returns what adds a batch to the task's
    vector. Scans keep all their tasks. A vector travels in blocks, so its
    merging is spread over ``GROUPS`` tasks a block, then one; only the sum
    comes to the driver.
    """

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        add, total, used = start(), np.zeros(length), False
        for batch in batches:
            add(batch, total)
            used = used or batch.num_rows > 0
        part = TaskContext.get().partitionId() % GROUPS
        for at in range(0, length if used else 0, BLOCK):
            yield _batch([at], part, [total[at : at + BLOCK]])

    by_group = rows.mapInArrow(partial, PARTIAL).repartition("at", "part").mapInArrow(_merged, PARTIAL)
    result = np.zeros(length)
    for row in by_group.repartition("at").mapInArrow(_merged, PARTIAL).collect():  # one row per block
        values = np.frombuffer(row["total"], np.float64)
        result[row["at"] : row["at"] + len(values)] = values
    return result
