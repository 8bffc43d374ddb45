"""Runs of repeating words, their exact extents from a run-length grammar.

A run is a stretch of words with smallest period q (words q apart are the
same), of at least ``MIN_LENGTH`` words and twice its period, that no
neighbouring word extends. For every period q the words 0, q, 2q, ... form a
grid; a run with period q holds two neighbouring grid words whole, so each pair
of neighbours with the same words around it is a candidate.

Texts are compressed into a grammar by recompression: in turns, blocks of one
repeated symbol become a symbol, and pairs of a left and a right symbol (a
random, seeded parting of the symbols) become a symbol. Equal stretches are
compressed alike but for their ends, so how far two places agree is found by
going up and down the levels; a stretch inside a block is passed in one step.

Work on many texts is one numpy pass; candidates are made in blocks, so memory
is bounded by the words of one slice (or one long text) and a block. Texts
without candidates are not compressed. Null and empty texts have no words and
no runs. Every row is worked on for itself, so repeated rows, null ids and
further columns change nothing. No shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rasterloom.llm.texts import mixed, sliced, spread, whole_text

MIN_LENGTH = 12
# Candidate pairs that are looked at in one pass.
PAIRS = 1 << 20
SEED = 0x51ED

RUN = "array<struct<start:long,length:long,period:long>>"
Prepare = Callable[[int | None, list[bytes]], list[bytes]]


class Grammar:
    """Levels of symbols over several texts; no symbol reaches over the end of a text.

    A level is the places where its symbols begin, the symbols, and how many
    equal symbols stand from each on (``ahead``) and up to each (``behind``).
    All levels stand in one array, ordered by level and place, so that one
    search finds symbols of mixed levels.
    """

    def __init__(self, words: np.ndarray, begins: np.ndarray):
        n = self.size = len(words)
        first = np.zeros(n, bool)
        first[begins] = True
        places, symbols = np.arange(n), words.astype(np.int64)
        next_symbol = int(words.max(initial=-1)) + 1
        self.top = np.zeros(n + 1, np.int64)
        keys, held, ahead, behind = [], [], [], []
        level = 0
        while True:
            heads = np.flatnonzero(first | (np.diff(symbols, prepend=-1) != 0))
            lengths = np.diff(heads, append=len(symbols))
            own = np.arange(len(symbols)) - np.repeat(heads, lengths)
            self.top[places] = level
            keys.append(np.append(places, n) + level * (n + 1))
            held.append(np.append(symbols, -1))
            ahead.append(np.append(np.repeat(lengths, lengths) - own, 1))
            behind.append(np.append(own + 1, 1))
            if len(symbols) == len(begins):
                break
            # blocks
            places, symbols, first = places[heads], symbols[heads], first[heads]
            many = lengths > 1
            next_symbol = named(symbols, many, lengths, next_symbol)
            # pairs
            right = mixed(symbols.astype(np.uint64) + np.uint64(SEED + level)) & np.uint64(1) == 1
            joint = ~first[1:]
            one, other = joint & ~right[:-1] & right[1:], joint & right[:-1] & ~right[1:]
            lefts = np.flatnonzero(one if one.sum() >= other.sum() else other)
            paired = np.zeros(len(symbols), bool)
            paired[lefts] = True
            following = np.append(symbols[1:], 0)
            next_symbol = named(symbols, paired, following, next_symbol)
            kept = np.ones(len(symbols), bool)
            kept[lefts + 1] = False
            places, symbols, first = places[kept], symbols[kept], first[kept]
            level += 1
        self.top[n] = level
        self.keys, self.symbols = np.concatenate(keys), np.concatenate(held)
        self.ahead, self.behind = np.concatenate(ahead), np.concatenate(behind)

    def at(self, level: np.ndarray, place: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.keys, place + level * (self.size + 1))

    def agree(self, low: np.ndarray, high: np.ndarray, limit: np.ndarray, back: bool = False) -> np.ndarray:
        """Words that agree from two places on, up to where ``high`` meets ``limit``; with ``back``, words before them, ``low`` to ``limit``."""
        a, b = low.copy(), high.copy()
        level = np.minimum(self.top[a], self.top[b])
        active = np.flatnonzero((a > limit) if back else (b < limit))
        while len(active):
            own = level[active]
            x, y = self.at(own, a[active]) - back, self.at(own, b[active]) - back
            same = self.symbols[x] == self.symbols[y]
            passed, x, y = active[same], x[same], y[same]
            times = np.minimum(self.behind[x], self.behind[y]) if back else np.minimum(self.ahead[x], self.ahead[y])
            step = times * (self.keys[x + 1] - self.keys[x]) * (-1 if back else 1)
            a[passed] += step
            b[passed] += step
            level[passed] = np.minimum(self.top[a[passed]], self.top[b[passed]])
            level[active[~same]] -= 1
            more = (a[active] > limit[active]) if back else (b[active] < limit[active])
            active = active[more & (level[active] >= 0)]
        return low - a if back else b - high


def named(symbols: np.ndarray, which: np.ndarray, by: np.ndarray, next_symbol: int) -> int:
    """Give the symbols at ``which`` a new name by symbol and ``by``; returns the next free name."""
    base = int(by.max(initial=0)) + 1
    found, names = np.unique(symbols[which] * base + by[which], return_inverse=True)
    symbols[which] = next_symbol + names
    return next_symbol + len(found)


@dataclass
class Found:
    """Runs of several texts: number of the text, first word in it, length and period, in this order."""

    text: np.ndarray
    start: np.ndarray
    length: np.ndarray
    period: np.ndarray


def candidates(words: np.ndarray, begins: np.ndarray, counts: np.ndarray, near: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Text, place and period of grid neighbours with ``near`` equal words around them, in blocks, short periods first."""
    texts = np.flatnonzero(counts >= 2)
    most = counts[texts] // 2
    owner = np.repeat(texts, most)
    period = spread(np.ones(len(texts), np.int64), most)
    order = np.argsort(period, kind="stable")
    owner, period = owner[order], period[order]
    points = (counts[owner] - 1 - period) // period + 1
    total = np.cumsum(points)
    at = 0
    while at < len(owner):
        to = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + PAIRS, "right")))
        grid = spread(np.zeros(to - at, np.int64), points[at:to])
        text, q = np.repeat(owner[at:to], points[at:to]), np.repeat(period[at:to], points[at:to])
        place = begins[text] + grid * q
        hit = np.flatnonzero(words[place] == words[place + q])
        text, place, q = text[hit], place[hit], q[hit]
        around = np.ones(len(hit), np.int64)
        for way in (1, -1):
            on = np.arange(len(hit))
            for step in range(1, near):
                low, high = place[on] + way * step, place[on] + q[on] + way * step
                inside = (high < begins[text[on]] + counts[text[on]]) & (low >= begins[text[on]])
                on, low, high = on[inside], low[inside], high[inside]
                on = on[words[low] == words[high]]
                around[on] += 1
        held = around >= near
        yield text[held], place[held], q[held]
        at = to


def find(words: np.ndarray, counts: np.ndarray, min_length: int = MIN_LENGTH) -> Found:
    """All runs of the texts whose word numbers stand one after the other in ``words``."""
    begins = np.cumsum(counts) - counts
    # in a run max(q, min_length - q) words or more agree with those q places on, from the first that does to the last
    near = (min_length + 1) // 2
    grammar, chosen = None, []
    covered_to, covered_by = np.zeros(len(words), np.int64), np.ones(len(words), np.int64)
    # short texts cannot hold a run
    long_enough = np.where(counts >= min_length, counts, 0)
    for text, place, q in candidates(words, begins, long_enough, near):
        # inside a run whose period divides q nothing new is found
        new = (q % covered_by[place] != 0) | (place + q >= covered_to[place])
        text, place, q = text[new], place[new], q[new]
        if not len(text):
            continue
        if grammar is None:
            some = np.flatnonzero(long_enough)
            moved = np.cumsum(counts[some]) - counts[some]
            grammar = Grammar(words[spread(begins[some], counts[some])], moved)
            shift = np.zeros(len(counts), np.int64)
            shift[some] = begins[some] - moved
        low = place - shift[text]
        start = place - grammar.agree(low, low + q, begins[text] - shift[text], back=True)
        end = place + q + grammar.agree(low, low + q, begins[text] + counts[text] - shift[text])
        held = end - start >= np.maximum(min_length, 2 * q)
        made = np.unique(np.stack([start[held], end[held], q[held], text[held]], axis=1), axis=0)
        chosen.append(made)
        for s, e, p, _ in made[made[:, 1] - made[:, 0] >= 4 * made[:, 2]].tolist():
            if covered_to[s] < e:
                covered_to[s:e], covered_by[s:e] = e, p
    rows = np.concatenate(chosen) if chosen else np.zeros((0, 4), np.int64)
    # a longer period of the same stretch is a multiple of its smallest
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    first = np.ones(len(rows), bool)
    first[1:] = (np.diff(rows[:, :2], axis=0) != 0).any(axis=1)
    rows = rows[first]
    rows = rows[np.lexsort((rows[:, 2], rows[:, 0]))]
    return Found(rows[:, 3], rows[:, 0] - begins[rows[:, 3]], rows[:, 1] - rows[:, 0], rows[:, 2])


def numbered(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """A number for every word, the same for equal words, and the number of words of each text."""
    numbers: dict[bytes, int] = {}
    flat = np.array([numbers.setdefault(word, len(numbers)) for words in texts for word in words], np.int64)
    return flat, np.array([len(words) for words in texts], np.int64)


def collapse(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words without what each run (start, length, period) holds after its first period."""
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()])


def detect(docs: DataFrame, prepare: Prepare | None = None, min_length: int = MIN_LENGTH) -> DataFrame:
    """``doc_id``, ``n_words``, ``runs`` (by start, then period) and ``collapsed`` of every row.

    ``prepare`` may change the words of a text before it is searched.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in sliced(batches):
            words = [text.encode().split() for text in part.column("text").to_pylist()]
            if prepare:
                words = [prepare(doc_id, own) for doc_id, own in zip(part.column("doc_id").to_pylist(), words)]
            flat, counts = numbered(words)
            found = find(flat, counts, min_length)
            ends = np.searchsorted(found.text, np.arange(len(words)), "right")
            rows = np.stack([found.start, found.length, found.period], axis=1)
            kept = [collapse(own, rows[a:b]) if a < b else b" ".join(own) for own, a, b in zip(words, np.append(0, ends[:-1]), ends)]
            runs = pa.ListArray.from_arrays(
                pa.array(np.append(0, ends), pa.int32()),
                pa.StructArray.from_arrays([pa.array(column, pa.int64()) for column in rows.T], names=["start", "length", "period"]),
            )
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(counts), runs, pa.array([each.decode() for each in kept], pa.string())],
                names=["doc_id", "n_words", "runs", "collapsed"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    return rows.mapInArrow(run, f"doc_id long, n_words long, runs {RUN}, collapsed string")
