"""Bridge between Arrow batches and numpy stacks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, types as T

from rasterloom.functions.kernels import STACK_PIXELS


def with_kernel(
    df: DataFrame,
    fields: list[T.StructField],
    start: Callable[[], Callable[[pa.RecordBatch], list]],
    drop: tuple[str, ...] = (),
) -> DataFrame:
    """Append columns that a kernel computes batch by batch.

    ``start`` runs once per task and returns the kernel, which maps a batch to
    one list or array per field. The other columns pass through untouched,
    except those to ``drop``: pixels that only the kernel needs do not travel
    back to the JVM.
    """
    kept = [field for field in df.schema.fields if field.name not in drop]
    held = [i for i, name in enumerate(df.columns) if name not in drop]
    names = [field.name for field in kept + fields]
    kinds = [_arrow_type(field.dataType) for field in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kernel = start()
        for batch in batches:
            made = [pa.array(values, kind) for values, kind in zip(kernel(batch), kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in held] + made, names=names)

    return df.mapInArrow(run, T.StructType(kept + fields))


def _arrow_type(kind: T.DataType) -> pa.DataType:
    # The Spark types that kernels produce.
    plain = {
        T.BinaryType(): pa.binary(),
        T.StringType(): pa.string(),
        T.IntegerType(): pa.int32(),
        T.LongType(): pa.int64(),
        T.DoubleType(): pa.float64(),
        T.BooleanType(): pa.bool_(),
    }
    return pa.list_(_arrow_type(kind.elementType)) if isinstance(kind, T.ArrayType) else plain[kind]


def per_row(batch: pa.RecordBatch, given: str | int) -> np.ndarray:
    """A constant or a column as one integer per row; null counts as -1."""
    if isinstance(given, int):
        return np.full(batch.num_rows, given, np.int64)
    return batch.column(given).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)


def stacks(
    batch: pa.RecordBatch, pixels: str, height: str | int, width: str | int, channels: str | int = 1
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and ``(n, h, w, channels)`` stacks of the equally sized images of a batch.

    Sizes are column names or constants. Rows whose pixels are null or do not
    fill their shape are in no stack. A stack holds a bounded number of pixels;
    a larger group of rows comes as several stacks.
    """
    held = batch.column(pixels)
    shape = np.stack([per_row(batch, size) for size in (height, width, channels)], axis=1)
    length = pa.compute.binary_length(held).fill_null(-1).to_numpy(zero_copy_only=False)
    usable = np.flatnonzero((shape > 0).all(axis=1) & (shape.prod(axis=1) == length))
    kinds, member = np.unique(shape[usable], axis=0, return_inverse=True)
    for k, kind in enumerate(kinds):
        rows = usable[np.ravel(member) == k]
        step = max(1, STACK_PIXELS // int(kind.prod()))
        for at in range(0, len(rows), step):
            some = rows[at : at + step]
            joined = b"".join(held[int(i)].as_buffer() for i in some)
            yield some, np.frombuffer(joined, np.uint8).reshape(len(some), *kind)


def gray_stacks(batch: pa.RecordBatch, pixels: str, height: str | int, width: str | int):
    """As ``stacks``, for one-channel images: ``(n, h, w)``."""
    for rows, stack in stacks(batch, pixels, height, width):
        yield rows, stack[..., 0]
