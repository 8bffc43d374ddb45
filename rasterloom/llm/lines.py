"""Removal of lines that many documents hold, as bitmaps of the lines to keep.

A line's key is the line without ASCII blanks at its ends and with A-Z
lower-cased. Keys of enough code points are hashed, one row per key and row of
the table, ranged by hash and id and sorted by hash, then id downwards. One
stream over the sorted rows sees the largest id of a key first and drops the
key's lines in all others, once it has met enough documents. A range may begin
or end within a key; a first look at the ends of all ranges settles those keys,
so a line that a third of all documents hold is spread over many tasks.

Null and empty texts are one empty line. Rows of one id are one document; null
ids are one document, below all others.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from rasterloom.llm.texts import packed, shuffle_width, sliced
from rasterloom.session import cut_lineage

MIN_CHARS, MIN_DOCS = 40, 5

KEYS = "k1 long, k2 long, rid long, rkey long, n_lines int, at array<int>"
COLUMNS = ("k1", "k2", "rid", "rkey", "n_lines", "at")


def line_key(line: bytes, min_chars: int = MIN_CHARS) -> bytes | None:
    """The key, if it has enough code points."""
    if len(line) < min_chars:
        return None
    key = line.strip().lower()
    if len(key) < min_chars or len(key) < 4 * min_chars and len(key.decode()) < min_chars:
        return None
    return key


def line_keys(rows: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """A row per text and key: the key's hash, the number of lines, and where its lines stand."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in sliced(batches):
            of, digests, sizes, places = [], [], [], []
            for row, text in enumerate(part.column("text").to_pylist()):
                lines = text.encode().split(b"\n")
                found: dict[bytes, list[int]] = {}
                for number, line in enumerate(lines):
                    if (key := line_key(line, min_chars)) is not None:
                        found.setdefault(xxhash.xxh3_128_digest(key), []).append(number)
                of += [row] * len(found)
                sizes += [len(lines)] * len(found)
                digests += found.keys()
                places += found.values()
            halves = np.frombuffer(b"".join(digests), ">i8").astype(np.int64).reshape(-1, 2)
            of = pa.array(of, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(halves[:, 0]),
                    pa.array(halves[:, 1]),
                    part.column("rid").take(of),
                    part.column("rkey").take(of),
                    pa.array(sizes, pa.int32()),
                    pa.array(places, pa.list_(pa.int32())),
                ],
                names=list(COLUMNS),
            )

    return rows.mapInArrow(run, KEYS)


def key_ranges(keys: DataFrame) -> DataFrame:
    """The rows ranged and sorted, written to the shared folder so that both looks see the same ranges."""
    n = shuffle_width(keys.sparkSession)
    ranged = keys.repartitionByRange(n, "k1", "k2", F.desc("rid"))
    return cut_lineage(ranged.sortWithinPartitions("k1", "k2", F.desc("rid"), "rkey"))


def streamed(batches: Iterator[pa.RecordBatch], columns: tuple[str, ...]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(batch.column(name).to_pylist() for name in columns))


def border_keys(ranges: DataFrame) -> dict[tuple[int, int], tuple[int, int]]:
    """For the keys at the ends of all ranges: their largest id and number of documents.

    Two short rows per range come to the driver, whatever the input holds.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = []
        for key, rows in groupby(streamed(batches, ("k1", "k2", "rid")), key=lambda row: row[:2]):
            count, last, top = 0, None, None
            for _, _, rid in rows:
                if count == 0 or rid != last:
                    count, last, top = count + 1, rid, rid if top is None else top
            kept = kept[:1] + [(TaskContext.get().partitionId(), *key, count, top, last)]
        made = [pa.array(column, pa.int64()) for column in zip(*kept)] or [pa.array([], pa.int64())] * 6
        yield pa.RecordBatch.from_arrays(made, names=["range", "k1", "k2", "docs", "top", "last"])

    ends = ranges.select("k1", "k2", "rid").mapInArrow(run, "range long, k1 long, k2 long, docs long, top long, last long").collect()
    found: dict[tuple[int, int], tuple[int, int]] = {}
    below = None
    for end in sorted(ends, key=lambda row: (row["range"], row["k1"], row["k2"])):
        key = end["k1"], end["k2"]
        top, docs = found.get(key, (end["top"], 0))
        # the ranges may part the rows of one id
        again = docs > 0 and below == end["top"]
        found[key] = top, docs + end["docs"] - again
        below = end["last"]
    return found


def dropped_lines(ranges: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """The rows of ``ranges`` whose lines go."""
    borders = border_keys(ranges)

    def choose(key: tuple[int, int], rows: Iterator[tuple]) -> Iterator[tuple]:
        top, docs = borders.get(key, (None, None))
        if docs is not None and docs < min_docs:
            return
        met, last, waiting = 0, None, []
        for row in rows:
            rid = row[2]
            if met == 0 or rid != last:
                met, last = met + 1, rid
            if top is None:
                top = rid
            if rid == top:
                continue
            if docs is not None or met >= min_docs:
                yield from waiting
                waiting = []
                yield row
            else:
                waiting.append(row)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for key, rows in groupby(streamed(batches, COLUMNS), key=lambda row: row[:2]):
            for row in choose(key, rows):
                held.append(row[2:])
                if len(held) == 10_000:
                    yield batch_of(held)
                    held = []
        if held:
            yield batch_of(held)

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int32()))
        return pa.RecordBatch.from_arrays([pa.array(column, kind) for column, kind in zip(zip(*rows), kinds)], names=list(COLUMNS[2:]))

    return ranges.mapInArrow(run, "rid long, rkey long, n_lines int, at array<int>")


def keep_bitmaps(rows: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """``rid``, ``rkey`` and ``keep``: a compressed bitmap of the lines to keep, for texts that lose any."""
    dropped = dropped_lines(key_ranges(line_keys(rows.select("rid", "rkey", "text"), min_chars)), min_docs)
    gathered = dropped.groupBy("rid", "rkey").agg(F.max("n_lines").alias("n_lines"), F.flatten(F.collect_list("at")).alias("at"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            maps = []
            for n, at in zip(batch.column("n_lines").to_pylist(), batch.column("at").to_pylist()):
                keep = np.ones(n, bool)
                keep[at] = False
                maps.append(zlib.compress(np.packbits(keep).tobytes()))
            yield pa.RecordBatch.from_arrays([batch.column("rid"), batch.column("rkey"), pa.array(maps, pa.binary())], names=["rid", "rkey", "keep"])

    return gathered.mapInArrow(run, "rid long, rkey long, keep binary")


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """``row`` (all columns of the input), ``n_lines``, ``n_dropped`` and ``kept``, the text of the lines kept."""
    rows = packed(docs)
    bitmaps = keep_bitmaps(rows, min_chars, min_docs)
    whole = rows.join(bitmaps, ["rid", "rkey"], "left").select("row", "text", "keep")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in sliced(batches):
            sizes, gone, texts = [], [], []
            for text, keep in zip(part.column("text").to_pylist(), part.column("keep").to_pylist()):
                n = text.count("\n") + 1
                sizes.append(n)
                if keep is not None:
                    held = np.unpackbits(np.frombuffer(zlib.decompress(keep), np.uint8), count=n).astype(bool)
                    text = "\n".join([line for line, kept in zip(text.split("\n"), held) if kept])
                    gone.append(n - int(held.sum()))
                else:
                    gone.append(0)
                texts.append(text)
            yield pa.RecordBatch.from_arrays(
                [part.column("row"), pa.array(sizes, pa.int64()), pa.array(gone, pa.int64()), pa.array(texts, pa.string())],
                names=["row", "n_lines", "n_dropped", "kept"],
            )

    schema = rows.select("row").schema
    return whole.mapInArrow(run, schema.add("n_lines", "long").add("n_dropped", "long").add("kept", "string"))
