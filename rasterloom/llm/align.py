"""Alignment of the tokens that two tokenizers make of the same bytes.

Each text, with a blank before it, is cut into tokens by a byte-level BPE (A)
and, as it stands, by a BPE over pieces that adds that blank itself (B). All
tokens are sorted by first byte; a group ends where a token begins at or behind
the furthest end so far, which is where tokens of both end. Within groups every
A token is linked to the B tokens it overlaps.

Neither tokenizer joins anything across a single blank between two other
characters that are no blanks: A's pattern takes a blank with what follows, and
no piece of B has its blank sign behind another sign (checked when the files
are read). Texts are therefore cut there into units; a distinct unit is
tokenized and aligned once per task, and texts are put together from units.

Links are counted over the corpus by pair of ids. Texts are packed in chunks; a
chunk asks for the count of each pair it holds once, so a pair that stands
everywhere costs a row per chunk. The most frequent count per B id is a table
of at most B's vocabulary.

Texts that are null or empty, or whose tokens of either kind do not give back
the bytes, have no tokens. Every row is worked on for itself: repeated rows,
null ids and further columns change nothing.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

from rasterloom.llm.texts import sliced, spread, whole_text
from rasterloom.session import scratch_path

# Text of one chunk, and bytes of distinct units that a task keeps aligned.
CHUNK_BYTES, KEPT_BYTES = 4 << 20, 20 << 20
# Units whose tokens the libraries hold at a time.
UNITS = 4096
# A pair's code: B's id above, A's id below.
SHIFT = 20

_BETWEEN = re.compile(r"(?<=\S) (?=\S)")
_UNEVEN = re.compile(r"\s | \s|\A | \Z")
_BYTE_PIECE = re.compile(r"<0x([0-9A-F]{2})>\Z")


def units(text: str) -> list[str]:
    """The text cut at each single blank between two characters that are no white space, without those blanks."""
    return _BETWEEN.split(text) if _UNEVEN.search(text) else text.split(" ")


def byte_of_sign() -> dict[str, int]:
    """The sign that stands for each byte in a byte-level vocabulary: itself if it is printable, else one from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [byte for byte in range(256) if byte not in set(plain)]
    return {chr(byte): byte for byte in plain} | {chr(256 + i): byte for i, byte in enumerate(others)}


class Pair:
    """Both tokenizers; the content of their files travels to the tasks, not the paths."""

    def __init__(self, a_path: str, b_path: str):
        with open(a_path, encoding="utf-8") as a_file, open(b_path, "rb") as b_file:
            self.a_content, self.b_content = a_file.read(), b_file.read()
        made = json.loads(self.a_content)
        before = made["pre_tokenizer"] or {}
        if made["normalizer"] is not None or before.get("type") != "ByteLevel" or before["add_prefix_space"]:
            raise ValueError("the first tokenizer must be byte-level, without a normalizer or a blank of its own")
        self.load()

    def load(self) -> Loaded:
        return Loaded(self.a_content, self.b_content)


class Loaded:
    """Both tokenizers ready for use, and the bytes of each token."""

    def __init__(self, a_content: str, b_content: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.a = Tokenizer.from_str(a_content)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_content)
        sign = byte_of_sign()
        special = set(self.a.get_added_tokens_decoder())
        size = self.a.get_vocab_size(with_added_tokens=True)
        names = {i: token for token, i in self.a.get_vocab(with_added_tokens=True).items()}
        self.a_bytes = [names[i].encode() if i in special else bytes(sign[c] for c in names.get(i, "")) for i in range(size)]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if any("▁" in piece.lstrip("▁") for piece in pieces):
            raise ValueError("the second tokenizer has pieces that join across a blank")
        self.b_bytes = [bytes([int(m[1], 16)]) if (m := _BYTE_PIECE.match(piece)) else piece.replace("▁", " ").encode() for piece in pieces]
        self.a_sizes, self.b_sizes = (np.array([len(each) for each in table], np.int64) for table in (self.a_bytes, self.b_bytes))
        if max(size, len(pieces)) >= 1 << SHIFT:
            raise ValueError("ids do not fit a pair's code")
        # decimal ids followed by a comma, a bar, a semicolon or nothing, for A and B alike
        self.width = max(size, len(pieces))
        self.signed = [f"{i}{end}" for end in (",", "|", ";", "") for i in range(self.width)]


    def tokens(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        a, b = [], []
        for at in range(0, len(texts), UNITS):
            some = texts[at : at + UNITS]
            a += [each.ids for each in self.a.encode_batch([" " + text for text in some], add_special_tokens=False)]
            b += self.b.encode(some, num_threads=1)
        return a, b


@dataclass
class Aligned:
    """Per unit: whether its tokens give back its bytes, numbers of tokens and groups, groups as text, and codes of its links."""

    right: np.ndarray
    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    groups: list[str]
    n_links: np.ndarray
    links: np.ndarray


def align(texts: list[str], own: Loaded) -> Aligned:
    """Tokens of both kinds of each text, grouped and linked, all texts in one pass."""
    a, b = own.tokens(texts)
    whole = [(" " + text).encode() for text in texts]
    right = np.array([b"".join([own.a_bytes[i] for i in x]) == w and b"".join([own.b_bytes[i] for i in y]) == w for x, y, w in zip(a, b, whole)], bool)
    a = [x if ok else [] for x, ok in zip(a, right)]
    b = [y if ok else [] for y, ok in zip(b, right)]
    n_a, n_b = (np.array([len(x) for x in each], np.int64) for each in (a, b))
    ids_a, ids_b = (np.array([i for x in each for i in x], np.int64) for each in (a, b))
    # texts stand one after the other, so that byte offsets rise over all of them
    ends_a, ends_b = np.cumsum(own.a_sizes[ids_a]), np.cumsum(own.b_sizes[ids_b])
    starts_a, starts_b = ends_a - own.a_sizes[ids_a], ends_b - own.b_sizes[ids_b]
    starts, ends = np.concatenate([starts_a, starts_b]), np.concatenate([ends_a, ends_b])
    order = np.lexsort((np.repeat([0, 1], [len(ids_a), len(ids_b)]), starts))
    reach = np.maximum.accumulate(ends[order]) if len(order) else ends
    opens = np.ones(len(order), bool)
    opens[1:] = starts[order][1:] >= reach[:-1]
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(opens) - 1
    group_a, group_b = group[: len(ids_a)], group[len(ids_a) :]
    text_a, text_b = np.repeat(np.arange(len(texts)), n_a), np.repeat(np.arange(len(texts)), n_b)
    n_groups = np.bincount(text_a[np.flatnonzero(np.diff(group_a, prepend=-1))], minlength=len(texts))

    low, high = np.searchsorted(ends_b, starts_a, "right"), np.searchsorted(starts_b, ends_a, "left")
    linked = ids_b[spread(low, high - low)] << SHIFT | np.repeat(ids_a, high - low)
    n_links = np.bincount(np.repeat(text_a, high - low), minlength=len(texts))

    # A's tokens of a group, then B's; the sign behind each tells what follows
    side, text = np.repeat([0, 1], [len(ids_a), len(ids_b)]), np.concatenate([text_a, text_b])
    listed = np.lexsort((side, group))
    side, group, text, ids = side[listed], group[listed], text[listed], np.concatenate([ids_a, ids_b])[listed]
    behind = np.where(np.diff(text, append=-1) != 0, 3, np.where(np.diff(group, append=-1) != 0, 2, np.where(np.diff(side, append=-1) != 0, 1, 0)))
    parts = [own.signed[i] for i in (ids + own.width * behind).tolist()]
    cuts = np.append(0, np.cumsum(n_a + n_b)).tolist()
    groups = ["".join(parts[x:y]) for x, y in zip(cuts, cuts[1:])]
    return Aligned(right, n_a, n_b, n_groups, groups, n_links, linked)


class Kept:
    """Units met by a task, aligned once; emptied between chunks when they hold too much."""

    def __init__(self, loaded: Loaded):
        self.loaded = loaded
        self.clear()

    def clear(self) -> None:
        self.numbers: dict[str, int] = {}
        self.size = 0
        self.groups: list[str] = []
        self.parts: list[Aligned] = []

    def add(self, texts: list[str]) -> np.ndarray:
        """The numbers of the units, those not met before aligned in one pass."""
        before = len(self.numbers)
        numbers = np.array([self.numbers.setdefault(unit, len(self.numbers)) for unit in texts], np.int64)
        if len(self.numbers) > before:
            new = list(dict.fromkeys(unit for unit, i in zip(texts, numbers.tolist()) if i >= before))
            self.size += sum(map(len, new)) + 64 * len(new)
            made = align(new, self.loaded)
            self.parts.append(made)
            self.groups += made.groups
        return numbers

    def column(self, name: str) -> np.ndarray:
        return np.concatenate([getattr(part, name) for part in self.parts] or [np.zeros(0, np.int64)])


@dataclass
class Chunk:
    """Texts of one chunk: digest columns per text, its units by number, and the links of the units."""

    kept: Kept
    rows: list[tuple]
    unit_counts: list[np.ndarray]
    unit_numbers: list[np.ndarray]

    def add(self, ids: list[int | None], texts: list[str]) -> None:
        cut = [units(text) if text else [] for text in texts]
        counts = np.array([len(each) for each in cut], np.int64)
        numbers = self.kept.add([unit for each in cut for unit in each])
        measures = [self.kept.column(name) for name in ("right", "n_a", "n_b", "n_groups", "n_links")]
        wrong, *sums = (np.bincount(np.repeat(np.arange(len(texts)), counts), weights=m[numbers], minlength=len(texts)).astype(np.int64) for m in (~measures[0].astype(bool), *measures[1:]))
        groups, at = self.kept.groups, 0
        for i, (doc_id, n) in enumerate(zip(ids, counts.tolist())):
            if wrong[i] or not n:
                counts[i] = 0
                self.rows.append((doc_id, 0, 0, 0, 0, ""))
            else:
                listed = ";".join([groups[u] for u in numbers[at : at + n].tolist()])
                self.rows.append((doc_id, *(int(each[i]) for each in sums), hashlib.sha256(listed.encode()).hexdigest()))
            at += n
        held = np.repeat(wrong == 0, [len(each) for each in cut])
        self.unit_counts.append(counts)
        self.unit_numbers.append(numbers[held])


PACKED = "chunk long, doc_id array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, groups_sha256 array<string>, per_text binary, units binary, per_unit binary, links binary, pairs binary, times binary"



def squeezed(values: np.ndarray, kind: str) -> bytes:
    raw = np.ascontiguousarray(values, kind).tobytes()
    return len(raw).to_bytes(8, "little") + pa.Codec("zstd").compress(raw, asbytes=True)


def widened(raw: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(pa.Codec("zstd").decompress(raw[8:], int.from_bytes(raw[:8], "little"), asbytes=True), kind)


def packed_chunk(number: int, chunk: Chunk) -> pa.RecordBatch:
    counts, numbers = np.concatenate(chunk.unit_counts), np.concatenate(chunk.unit_numbers)
    used, numbers = np.unique(numbers, return_inverse=True)
    n_links, links = chunk.kept.column("n_links"), chunk.kept.column("links")
    starts = np.cumsum(n_links) - n_links
    per_unit = n_links[used]
    codes = links[spread(starts[used], per_unit)]
    pairs, which = np.unique(codes, return_inverse=True)
    times = np.bincount(which, weights=np.repeat(np.bincount(numbers, minlength=len(used)), per_unit), minlength=len(pairs)).astype(np.int64)
    columns = [list(column) for column in zip(*chunk.rows)]
    kinds = [pa.int64()] * 5 + [pa.string()]
    blobs = [squeezed(counts, "<i4"), squeezed(numbers, "<i4"), squeezed(per_unit, "<i4"), squeezed(which, "<i4"), squeezed(pairs, "<i8"), squeezed(times, "<i8")]
    return pa.RecordBatch.from_arrays(
        [pa.array([number], pa.int64()), *(pa.array([column], pa.list_(kind)) for column, kind in zip(columns, kinds)), *(pa.array([blob], pa.binary()) for blob in blobs)],
        names=[field.split()[0] for field in PACKED.split(", ")],
    )


def chunks(docs: DataFrame, pair: Pair) -> DataFrame:
    """All texts, aligned and packed, a row per chunk. Numbers of chunks hold only once the rows are written."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, size, number = Kept(pair.load()), 0, TaskContext.get().partitionId() << 32
        chunk = Chunk(kept, [], [], [])
        for part in sliced(batches):
            texts = part.column("text").to_pylist()
            chunk.add(part.column("doc_id").to_pylist(), texts)
            size += sum(map(len, texts))
            if size >= CHUNK_BYTES:
                yield packed_chunk(number, chunk)
                number, size = number + 1, 0
                if kept.size > KEPT_BYTES:
                    kept.clear()
                chunk = Chunk(kept, [], [], [])
        if chunk.rows:
            yield packed_chunk(number, chunk)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text")).mapInArrow(run, PACKED)


def pair_rows(held: DataFrame) -> DataFrame:
    """``chunk``, ``pair`` and ``times`` (links) of every pair of ids that a chunk holds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, pairs, times in zip(*(batch.column(name).to_pylist() for name in ("chunk", "pairs", "times"))):
                codes = widened(pairs, "<i8")
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(codes), number)), pa.array(codes), pa.array(widened(times, "<i8"))], names=["chunk", "pair", "times"])

    return held.select("chunk", "pairs", "times").mapInArrow(run, "chunk long, pair long, times long")


def pair_counts(rows: DataFrame) -> DataFrame:
    """``pair``, ``total`` (its links in the corpus) and ``best``: no other A id has more with this B id."""
    totals = rows.groupBy("pair").agg(F.sum("times").alias("total"))
    b_id = F.shiftright("pair", SHIFT)
    # at most one row per id of B's vocabulary
    most = totals.groupBy(b_id.alias("b")).agg(F.max("total").alias("most"))
    return totals.withColumn("b", b_id).join(F.broadcast(most), "b").select("pair", "total", (F.col("total") == F.col("most")).alias("best"))


ALIGNED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def with_counts(held: pa.Table, found: pa.Table) -> pa.Table:
    """The texts of one chunk, with what the corpus counted of their pairs."""
    order = np.argsort(found.column("pair").to_numpy())
    total = found.column("total").to_numpy()[order]
    best = found.column("best").to_numpy(zero_copy_only=False)[order].astype(np.int64)
    counts, numbers, per_unit, links = (widened(held.column(name)[0].as_py(), "<i4") for name in ("per_text", "units", "per_unit", "links"))
    unit = np.repeat(np.arange(len(per_unit)), per_unit)
    sums = []
    for values in (best, total):
        # exact in integers: running sums, then differences
        by_unit = np.zeros(len(per_unit), np.int64)
        np.add.at(by_unit, unit, values[links])
        running = np.append(0, np.cumsum(by_unit[numbers]))
        ends = np.cumsum(counts)
        sums.append(running[ends] - running[ends - counts])
    columns = {name: held.column(name).combine_chunks().flatten() for name in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")}
    columns |= {"n_best": pa.array(sums[0], pa.int64()), "count_sum": pa.array(sums[1], pa.int64())}
    return pa.table({name: columns[name] for name in (field.split()[0] for field in ALIGNED.split(", "))})


def aligned(docs: DataFrame, pair: Pair) -> DataFrame:
    """Numbers of tokens, groups and links of every row's text, and the corpus counts of its links."""
    spark = docs.sparkSession
    path = scratch_path(spark, "aligned")
    chunks(docs, pair).write.parquet(path)
    held = spark.read.parquet(path)
    rows = pair_rows(held)
    found = rows.select("chunk", "pair").join(pair_counts(rows), "pair")
    return held.drop("pairs", "times").groupBy("chunk").cogroup(found.groupBy("chunk")).applyInArrow(with_counts, ALIGNED)


def groups_of(docs: DataFrame, pair: Pair) -> DataFrame:
    """``doc_id`` and ``groups`` (``a1,a2|b1;a3|b2``, empty without tokens) of every row. No shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loaded = pair.load()
        for part in sliced(batches):
            made = align(part.column("text").to_pylist(), loaded).groups
            empty = [not text for text in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(["" if e else g for g, e in zip(made, empty)], pa.string())], names=["doc_id", "groups"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text")).mapInArrow(run, "doc_id long, groups string")
