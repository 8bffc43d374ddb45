"""One-permutation MinHash fingerprints of documents.

Each shingle of five words is hashed once; its hash names a bin and a value,
and a bin keeps its least value. An empty bin takes the value of a filled one,
chosen by hashing its own number until a filled bin is met (optimal
densification), so that two texts fill it alike as often as they are alike.
Only a few low bits of each value are stored. Two different values agree in
them by chance; ``likeness`` takes that share off.

Null texts count as empty. A text without words has a fingerprint of zeros,
which is like itself (1) and like no other (0). Equal texts have equal
fingerprints. Rows are ordered by id and then by text; rows without id come first.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rasterloom.llm.texts import NO_ID, keyed, mixed, shingle_hashes, shuffle_width, sliced

UNFILLED = np.uint64(0xFFFFFFFFFFFFFFFF)
RANDOM_PROBES = 64


@dataclass(frozen=True)
class Sketch:
    """``bins`` (a power of two) values of ``bits`` (1, 2, 4 or 8) bits from shingles of ``words`` words."""

    words: int = 5
    bins: int = 512
    bits: int = 4

    def values(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Densified values, a row per text, and which texts have any word."""
        return self.table(*shingle_hashes(texts, self.words), len(texts))

    def table(self, hashes: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """As ``values``, from shingle hashes and the text each is from."""
        width = np.uint64(self.bins.bit_length() - 1)
        table = np.full(n * self.bins, UNFILLED, np.uint64)
        np.minimum.at(table, owner * self.bins + (hashes & np.uint64(self.bins - 1)).astype(np.int64), hashes >> width)
        table = table.reshape(n, self.bins)
        filled = table != UNFILLED
        worded = filled.any(axis=1)
        self._densify(table, filled, worded)
        return table, worded

    def _densify(self, table: np.ndarray, filled: np.ndarray, worded: np.ndarray) -> None:
        row, column = np.nonzero(~filled & worded[:, None])
        numbers = np.arange(self.bins, dtype=np.uint64)
        attempt = 0
        while len(row):
            # after the random probes a sweep over all bins ends the search
            if attempt < RANDOM_PROBES:
                probe = (mixed(numbers * np.uint64(RANDOM_PROBES) + np.uint64(attempt + 1)) % np.uint64(self.bins)).astype(np.int64)
            else:
                probe = (numbers.astype(np.int64) + attempt) % self.bins
            met = filled[row, probe[column]]
            table[row[met], column[met]] = table[row[met], probe[column[met]]]
            row, column = row[~met], column[~met]
            attempt += 1

    def low_bits(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        table, worded = self.values(texts)
        low = (table & np.uint64((1 << self.bits) - 1)).astype(np.uint8)
        low[~worded] = 0
        return low, worded

    def packed(self, low: np.ndarray) -> list[str]:
        """Hexadecimal strings of the values, the first bin in the highest bits."""
        each = 8 // self.bits
        parts = low.reshape(len(low), -1, each)
        shifts = np.arange(each - 1, -1, -1, dtype=np.uint8) * np.uint8(self.bits)
        rows = np.bitwise_or.reduce(parts << shifts, axis=2).astype(np.uint8)
        return [row.tobytes().hex() for row in rows]

    def likeness(self, one: np.ndarray, other: np.ndarray, worded_one: np.ndarray, worded_other: np.ndarray) -> np.ndarray:
        """Share of agreeing values, less the share that agrees by chance, cut to 0..1."""
        chance = 2.0**-self.bits
        agree = (one == other).mean(axis=1) if len(one) else np.zeros(0)
        like = np.clip((agree - chance) / (1 - chance), 0, 1)
        return np.where(worded_one & worded_other, like, (worded_one == worded_other).astype(float))


def fingerprints(docs: DataFrame, sketch: Sketch = Sketch()) -> DataFrame:
    """``doc_id``, ``n_chars`` (code points) and ``fingerprint`` of every row. No shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in sliced(batches):
            texts = part.column("text").to_pylist()
            low, _ = sketch.low_bits(texts)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(map(len, texts), pa.int64()), pa.array(sketch.packed(low), pa.string())],
                names=["doc_id", "n_chars", "fingerprint"],
            )

    return keyed(docs).select("doc_id", "text").mapInArrow(run, "doc_id long, n_chars long, fingerprint string")


def in_order(docs: DataFrame) -> DataFrame:
    """Rows ranged and sorted by id, each range followed by the first rows of the next one.

    ``ghost`` marks those copies; the last range is followed by the first rows
    of all. The ends of the ranges are quantiles of the ids, as many as there
    are shuffle partitions. They are ids that occur, so no range is empty, and
    the text is shuffled once.
    """
    rows = keyed(docs).select("rid", "doc_id", "text")
    n = shuffle_width(docs.sparkSession)
    shares = [i / n for i in range(1, n)] or [0.5]
    found = rows.agg(F.min("rid").alias("least"), F.percentile_approx("rid", shares, 20 * n).alias("ends")).first()
    ends = np.array(sorted({found["least"], *(found["ends"] or [])} - {None}) or [NO_ID], np.int64)

    @F.pandas_udf("int")
    def place(ids: pd.Series) -> pd.Series:
        return pd.Series((np.searchsorted(ends, ids.to_numpy(), "right") - 1).astype(np.int32))

    @F.pandas_udf("boolean")
    def opens(ids: pd.Series) -> pd.Series:
        return pd.Series(np.isin(ids.to_numpy(), ends))

    own = F.struct(F.col("at").alias("range"), F.lit(False).alias("ghost"))
    before = F.struct(((F.col("at") + len(ends) - 1) % len(ends)).cast("int").alias("range"), F.lit(True).alias("ghost"))
    placed = (
        rows.withColumns({"at": place("rid"), "opens": opens("rid")})
        .withColumn("place", F.explode(F.when(F.col("opens"), F.array(own, before)).otherwise(F.array(own))))
        .select("place.range", "place.ghost", "rid", "doc_id", "text")
    )
    return placed.repartitionById(len(ends), F.col("range")).sortWithinPartitions("range", "ghost", "rid", "text").drop("rid")


def edited(text: str, following: str) -> str:
    """The last quarter of the text's code points replaced by as many from the start of the next."""
    quarter = len(text) // 4
    return text[: len(text) - quarter] + following[:quarter]


EDITED_SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
EDITED_COLUMNS = [field.split()[0] for field in EDITED_SCHEMA.split(", ")]


def edited_likeness(docs: DataFrame, sketch: Sketch = Sketch()) -> DataFrame:
    """Fingerprints of every text and of its edited text, and the likeness to that and to the next text.

    The next text follows in order of id; after the last comes the first.
    """

    def pairs(ids: list, texts: list[str]) -> pa.RecordBatch:
        """Rows for all but the last text, which only follows the one before it."""
        low, worded = sketch.low_bits(texts)
        changed = [edited(text, after) for text, after in zip(texts, texts[1:])]
        low_changed, worded_changed = sketch.low_bits(changed)
        digests = [hashlib.sha256(text.encode()).hexdigest() for text in changed]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(ids[:-1], pa.int64()),
                pa.array(map(len, texts[:-1]), pa.int64()),
                pa.array(digests, pa.string()),
                pa.array(sketch.packed(low[:-1]), pa.string()),
                pa.array(sketch.packed(low_changed), pa.string()),
                pa.array(sketch.likeness(low[:-1], low_changed, worded[:-1], worded_changed), pa.float64()),
                pa.array(sketch.likeness(low[:-1], low[1:], worded[:-1], worded[1:]), pa.float64()),
            ],
            names=EDITED_COLUMNS,
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list = []
        texts: list[str] = []
        closed = False
        held = None  # the range that is being read
        for part in sliced(batches):
            for range_, ghost, doc_id, text in zip(*(part.column(name).to_pylist() for name in ("range", "ghost", "doc_id", "text"))):
                if range_ != held:
                    held, closed, ids, texts = range_, False, [], []
                if not closed:
                    ids.append(doc_id)
                    texts.append(text)
                    if ghost:
                        yield pairs(ids, texts)
                        closed = True
            if not closed and len(texts) > 1:
                yield pairs(ids, texts)
                ids, texts = ids[-1:], texts[-1:]

    return in_order(docs).mapInArrow(run, EDITED_SCHEMA)
