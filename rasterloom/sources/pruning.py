"""Files that a scan opens: a bit field of hashed ids, tested on each path before its file is opened.

Spark evaluates conditions on ``_metadata.file_path`` while it plans a scan, so
files whose ids are not in the field never become part of a task. A field has a
bounded number of ids; more ids are taken in several passes over one listing.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

# Ids of one field at most, and bits per id: two bits of each are set, so 0.4 % of other files pass at most.
FIELD_IDS, BITS_PER_ID = 1 << 17, 32
PASS_SEED = 77


def passes(ids: int, field_ids: int = FIELD_IDS) -> int:
    """Fields that so many ids take."""
    return -(-ids // field_ids)


def of_pass(id_col: str, number: int, of: int) -> Column:
    """Whether an id belongs to a pass, by its hash."""
    return F.pmod(F.xxhash64(id_col, F.lit(PASS_SEED)), F.lit(of)) == number


def _places(id_: Column, bits: int) -> list[Column]:
    hashed = F.xxhash64(id_)
    return [part.bitwiseAND(F.lit(bits - 1)) for part in (hashed, F.shiftrightunsigned(hashed, 32))]


def bit_field(ids: DataFrame, column: str, about: int) -> bytes:
    """The field of about so many ids, of a proven size: a byte per four ids, 1 MiB at most for ``FIELD_IDS``."""
    bits = 1 << max(13, (about * BITS_PER_ID - 1).bit_length())
    place = F.explode(F.array(*_places(F.col(column), bits))).alias("place")
    rows = ids.select(place).select(F.shiftright("place", 3).alias("byte"), F.col("place").bitwiseAND(F.lit(7)).alias("bit"))
    by_byte = rows.distinct().groupBy("byte").agg(F.sum(F.pow(F.lit(2), F.col("bit"))).cast("int").alias("set")).toArrow()
    field = np.zeros(bits // 8, np.uint8)
    field[by_byte.column("byte").to_numpy()] = by_byte.column("set").to_numpy().astype(np.uint8)
    return field.tobytes()


def in_field(field: bytes, id_: Column) -> Column:
    """Whether both bits of an id are set."""
    held, whole = F.lit(True), F.lit(bytearray(field))
    for place in _places(id_, 8 * len(field)):
        one = F.substr(whole, F.shiftright(place, 3).cast("int") + 1, F.lit(1))
        held = held & (F.getbit(F.conv(F.hex(one), 16, 10).cast("long"), place.bitwiseAND(F.lit(7)).cast("int")) == 1)
    return held
