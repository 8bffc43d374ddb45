"""Row keys, bounded batches and whole-batch hashing of words that the text operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Bytes of text that one numpy pass works on; a longer text is a pass of its own.
SLICE_BYTES = 1 << 20
# Stands for a null id wherever rows are ordered or joined by id.
NO_ID = -(1 << 63)

# Odd multiplier of the polynomial hash, its inverse modulo 2^64, and the mixer's constants.
BASE = 0x9E3779B97F4A7C15
BASE_INVERSE = pow(BASE, -1, 1 << 64)
MIX_1, MIX_2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)

# The six ASCII blanks, space and U+0009 to U+000D.
BLANKS = b" \t\n\v\f\r"
_BLANK_BYTES = [BLANKS[i : i + 1] for i in range(len(BLANKS))]


def whole_text() -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col("text"), F.lit(""))


def row_id() -> Column:
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID).cast("long"))


def text_key() -> Column:
    """Tells rows of one id apart. Only together with the id it names a row."""
    return F.xxhash64(F.col("doc_id"), whole_text())


def keyed(docs: DataFrame, *more: Column) -> DataFrame:
    """``rid``, ``rkey``, ``doc_id`` and whole ``text`` of every row.

    Rows that agree in id and text have one key; whatever is derived from the
    text is then the same for them.
    """
    return docs.select(row_id().alias("rid"), text_key().alias("rkey"), F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"), *more)


def packed(docs: DataFrame) -> DataFrame:
    """As ``keyed``, with all columns of the input kept as one struct ``row``.

    Columns of any name pass through untouched, since none meets ours.
    """
    return keyed(docs, F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("row"))


def struct_of(docs: DataFrame) -> DataFrame:
    """All columns of the input as one struct ``row``; ``text_of`` finds its text in a batch."""
    return docs.select(F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("row"))


def text_of(batch: pa.RecordBatch) -> pa.Array:
    """The texts of a batch of ``struct_of``, null as empty."""
    return batch.column("row").field("text").fill_null("")


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def sliced(batches: Iterator[pa.RecordBatch], column: str | Callable[[pa.RecordBatch], pa.Array] = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows in batches of about ``limit`` bytes of one column (a name, or what finds it), one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        texts = batch.column(column) if isinstance(column, str) else column(batch)
        sizes = pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.cumsum(sizes + 1)
        at = 0
        while at < batch.num_rows:
            done = int(ends[at - 1]) if at else 0
            to = max(at + 1, int(np.searchsorted(ends, done + limit, "right")))
            yield batch.slice(at, to - at)
            at = to


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values so that every bit depends on every other."""
    values = values ^ (values >> np.uint64(33))
    values = values * MIX_1
    values = values ^ (values >> np.uint64(33))
    values = values * MIX_2
    return values ^ (values >> np.uint64(33))


class Powers:
    """Powers of the base and of its inverse, extended as longer buffers come."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = 1 << max(16, (n - 1).bit_length())
            factors = np.full((2, size), [[BASE], [BASE_INVERSE]], np.uint64)
            factors[:, 0] = 1
            self.up, self.down = np.cumprod(factors, axis=1)
        return self.up[:n], self.down[:n]


POWERS = Powers()


def run_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of every byte run ``data[start:end]``; equal runs have equal hashes.

    Runs are in order of start. Long buffers are worked on in blocks of runs,
    so that memory beside the buffer is bounded.
    """
    if len(data) <= 2 * SLICE_BYTES or len(starts) < 2:
        return _block_hashes(data, starts, ends)
    cuts = np.flatnonzero(np.diff(starts // SLICE_BYTES)) + 1
    found = []
    for own_starts, own_ends in zip(np.split(starts, cuts), np.split(ends, cuts)):
        low = int(own_starts[0])
        found.append(_block_hashes(data[low : int(own_ends.max())], own_starts - low, own_ends - low))
    return np.concatenate(found)


def _block_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    up, down = POWERS.to(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * down[starts])


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The texts in one buffer, each followed by a line feed, and where each begins."""
    lengths = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    return np.frombuffer(b"\n".join(texts) + b"\n", np.uint8), np.cumsum(lengths) - lengths


def pieces(text: bytes, owner: int, limit: int = SLICE_BYTES) -> Iterator[tuple[int, bytes]]:
    """``owner`` with each piece of a text, cut at ASCII blanks about every ``limit`` bytes; one piece if it is short."""
    at = 0
    while len(text) - at > limit:
        blank = max(text.rfind(each, at, at + limit) for each in _BLANK_BYTES)
        if blank < 0:
            later = [place for each in _BLANK_BYTES if (place := text.find(each, at + limit)) >= 0]
            if not later:
                break
            blank = min(later)
        yield owner, text[at : blank + 1]
        at = blank + 1
    yield owner, text[at:]


def grouped(parts: Iterable[tuple[int, bytes]], limit: int = SLICE_BYTES) -> Iterator[list[tuple[int, bytes]]]:
    """The pieces in lists of about ``limit`` bytes."""
    held, size = [], 0
    for part in parts:
        if held and size + len(part[1]) > limit:
            yield held
            held, size = [], 0
        held.append(part)
        size += len(part[1])
    if held:
        yield held


def runs(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true values."""
    edges = np.flatnonzero(np.diff(inside.astype(np.int8), prepend=0, append=0))
    return edges[::2], edges[1::2]


def spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The numbers from each start on, ``counts`` of them, one after the other."""
    firsts = np.cumsum(counts) - counts
    return np.arange(int(counts.sum())) + np.repeat(starts - firsts, counts)


_BLANK = np.zeros(256, bool)
_BLANK[list(BLANKS)] = True


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, A-Z lower-cased and split at ASCII blanks, and the text each is from."""
    data, begins = joined([text.encode().lower() for text in texts])
    starts, ends = runs(~_BLANK[data])
    return run_hashes(data, starts, ends), np.searchsorted(begins, starts, "right") - 1


def shingle_hashes(texts: list[str], words: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``words`` words, repeats included, and the text each is from.

    A text with fewer words is one shingle of all its words; one without words
    has none.
    """
    hashes, owner = word_hashes(texts)
    factors = mixed(np.arange(1, words + 1, dtype=np.uint64)) | np.uint64(1)
    counts = np.bincount(owner, minlength=len(texts))
    first = np.cumsum(counts) - counts
    n = max(0, len(hashes) - words + 1)
    total = np.zeros(n, np.uint64)
    for i in range(words):
        total += hashes[i : i + n] * factors[i]
    whole = owner[:n] == owner[words - 1 :] if n else np.zeros(0, bool)
    found, of = [total[whole]], [owner[:n][whole]]
    for i in np.flatnonzero((counts > 0) & (counts < words)):
        own = hashes[first[i] : first[i] + counts[i]]
        found.append(np.array([(own * factors[: counts[i]]).sum(dtype=np.uint64)], np.uint64))
        of.append(np.array([i]))
    return mixed(np.concatenate(found)), np.concatenate(of)
