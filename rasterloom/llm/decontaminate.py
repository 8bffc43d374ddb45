"""Benchmark decontamination by pigeonhole edit matching.

Texts and items are lower-cased and everything but letters and digits becomes
one blank. An item of ``n`` characters may differ by ``k``, a fixed share of
``n``. It is cut into ``k + 1`` pieces, one of which an occurrence must hold
unchanged; one automaton finds the exact hits of all pieces in a single pass.
The pieces form a tree of halves, and some path from an untouched piece to the
root stays below one error per piece at every node. A hit is followed up that
path with Myers' bit-parallel distance, so most chance hits end at their parent
of some 25 characters; the root is the whole item.

Null and empty texts match nothing, nor does an item without letters or digits.
Items are a stated query set. They are measured and sent to the tasks in blocks
of bounded size, each block one pass over the texts. Repeated documents give
repeated results. Items are told apart by id and text: equal rows are one item,
different texts of one id, or without an id, are items of their own, and each
that a text holds gives a row.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from rasterloom.llm.texts import packed, sliced, whole_text

ERROR_RATE = 0.1
# Characters of benchmark items that one pass over the texts looks for.
BLOCK_CHARS = 4_000_000

_ASCII = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or 48 <= b <= 57 or b >= 128 else 32 for b in range(256))


def normal_form(text: str) -> str:
    """Lower case, with a single blank for all that is not a letter or digit; bytes beyond ASCII stay."""
    if not text.isascii():
        text = text.lower()
    return b" ".join(text.encode().translate(_ASCII).split()).decode()


class Pattern:
    """Bit masks of one string for Myers' algorithm."""

    def __init__(self, text: str):
        self.length = len(text)
        self.masks: dict[str, int] = defaultdict(int)
        for i, char in enumerate(text):
            self.masks[char] |= 1 << i
        self.masks.default_factory = None

    def best(self, window: str, most: int) -> tuple[int, int] | None:
        """Least distance to any part of the window and where that part ends, if within ``most``.

        Of equal distances the first end counts.
        """
        if not self.length:
            return 0, 0
        full, top = (1 << self.length) - 1, 1 << (self.length - 1)
        plus, minus, score = full, 0, self.length
        found = (score, 0) if score <= most else None
        get = self.masks.get
        for at, char in enumerate(window, 1):
            equal = get(char, 0)
            across = (((equal & plus) + plus) ^ plus) | equal
            down_plus = minus | ~(across | plus) & full
            down_minus = plus & across
            if down_plus & top:
                score += 1
            elif down_minus & top:
                score -= 1
                if score <= most and (found is None or score < found[0]):
                    found = score, at
            down_plus = (down_plus << 1) & full
            down_minus = (down_minus << 1) & full
            along = equal | minus
            plus = down_minus | ~(along | down_plus) & full
            minus = down_plus & along
        return found


class Item:
    """One benchmark item: its pieces, and for each the nodes above it, the whole item last."""

    def __init__(self, item_id, text: str, rate: float):
        self.item_id, self.text = item_id, text
        self.most = int(rate * len(text))
        self.paths: list[list[tuple[int, int, int, Pattern]]] = []
        self.pieces: list[tuple[int, int]] = []
        self._split(0, self.most + 1, [])

    def _bounds(self, low: int, high: int) -> tuple[int, int]:
        return len(self.text) * low // (self.most + 1), len(self.text) * high // (self.most + 1)

    def _split(self, low: int, high: int, above: list) -> None:
        start, end = self._bounds(low, high)
        path = above + [(start, end, high - low - 1, Pattern(self.text[start:end]))]
        if high - low == 1:
            self.pieces.append((start, end))
            # the piece itself is matched already; an item of one piece has no node above
            self.paths.append(path[-2::-1] or path)
            return
        middle = (low + high) // 2
        self._split(low, middle, path)
        self._split(middle, high, path)

    def match(self, text: str, piece: int, at: int) -> tuple[int, int] | None:
        """Distance and end of an occurrence around a hit of one piece at ``at``."""
        origin = at - self.pieces[piece][0]
        found = None
        for start, end, most, pattern in self.paths[piece]:
            low = max(0, origin + start - most)
            found = pattern.best(text[low : max(0, origin + end + most)], most)
            if found is None:
                return None
            found = found[0], low + found[1]
        return found


class Matcher:
    """All items of a block behind one automaton."""

    def __init__(self, items: list[tuple[int, str]], rate: float):
        made = [Item(item_id, text, rate) for item_id, raw in items if (text := normal_form(raw or ""))]
        holders: dict[str, list[tuple[Item, int]]] = defaultdict(list)
        for item in made:
            for number, (start, end) in enumerate(item.pieces):
                holders[item.text[start:end]].append((item, number))
        self.automaton = ahocorasick.Automaton()
        for piece, held in holders.items():
            self.automaton.add_word(piece, (len(piece), held))
        if holders:
            self.automaton.make_automaton()
        self.empty = not holders

    def matches(self, raw: str) -> list[tuple[int, int, int, int]]:
        """Item, distance, item's length and end (in the normal form) of the best occurrence of each item."""
        if self.empty:
            return []
        text = normal_form(raw)
        best: dict[Item, tuple] = {}
        tried: set[tuple[int, int, int]] = set()
        for last, (length, held) in self.automaton.iter(text):
            at = last - length + 1
            for item, piece in held:
                key = (id(item), piece, at)
                if key in tried or (item in best and best[item][0] == 0):
                    continue
                tried.add(key)
                found = item.match(text, piece, at)
                if found and (item not in best or found < best[item]):
                    best[item] = found
        return [(item.item_id, distance, len(item.text), end) for item, (distance, end) in best.items()]


def item_blocks(items: DataFrame, block_chars: int = BLOCK_CHARS) -> Iterator[list[tuple[int, str]]]:
    """The items in blocks of bounded size; no more than a block and one item are held at once."""
    block, held = [], 0
    for row in items.select("item_id", "text").distinct().toLocalIterator():
        block.append((row["item_id"], row["text"]))
        held += len(row["text"] or "")
        if held >= block_chars:
            yield block
            block, held = [], 0
    if block:
        yield block


FOUND = "doc_id long, item_id long, distance long, item_chars long, match_end long"


def find_items(docs: DataFrame, items: DataFrame, rate: float = ERROR_RATE, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """A row per document and item that it holds: ``distance`` of the best occurrence and its end. No shuffle."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    found = docs.sparkSession.createDataFrame([], FOUND)
    for block in item_blocks(items, block_chars):

        def run(batches: Iterator[pa.RecordBatch], block=block) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(block, rate)
            for part in sliced(batches):
                hits = []
                for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist()):
                    hits += [(doc_id, item_id, distance, length, end) for item_id, distance, length, end in matcher.matches(text)]
                columns = zip(*hits) if hits else [[]] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["doc_id", "item_id", "distance", "item_chars", "match_end"])

        found = found.unionByName(rows.mapInArrow(run, FOUND))
    return found


def without_items(docs: DataFrame, items: DataFrame, rate: float = ERROR_RATE, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The documents that hold no item, all columns as they were. No shuffle."""
    kept = packed(docs).select("row", "text")
    for block in item_blocks(items, block_chars):

        def run(batches: Iterator[pa.RecordBatch], block=block) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(block, rate)
            for part in sliced(batches):
                yield part.filter(pa.array([not matcher.matches(text) for text in part.column("text").to_pylist()]))

        kept = kept.mapInArrow(run, T.StructType(kept.schema.fields))
    return kept.select("row.*")
