"""Near-duplicate documents by SimHash with pigeonring filtering.

A fingerprint is cut into segments on a ring. If two fingerprints differ in at
most ``t`` of the bits, then from some segment on, every chain of consecutive
segments differs in no more than its share of ``t`` (the pigeonring principle).
With five segments and two bits, the first two segments of that chain must be
equal, and the first four differ in one bit at most. Fingerprints meet by the
first condition, are pruned by the others, and only then compared whole.

Documents with one fingerprint are one class, and only classes are compared. A
segment pair that more classes share than ``bucket`` is not joined at all: its
classes each send their fingerprint and its 64 neighbours at one bit. Two
fingerprints at two bits or fewer have such a neighbour in common, and all that
meet at one are within two bits of each other, so a link to the least of them
says the same as all pairs. This is exact and grows with the classes only.

Components are found by large-star and small-star steps over class links, each
step a few joins and partial minima, written to the shared folder.

``near_duplicates`` is exact at two bits. ``one_of_each`` joins texts whose sets of
five-word shingles are alike to 0.8 (Jaccard). Texts of one set are one class,
and a class has four fingerprints of its set. Classes whose first fingerprints
reach each other at two bits, by the same segments, chains and components, are
a block. For texts alike to 0.8 no segment need be equal, so classes also meet
in blocks that share four minima of one-permutation MinHash, as two texts alike
to 0.8 do in one of 16 bands but for 2 in 10,000 pairs.

Blocks only nominate. In them the four fingerprints are the segments of a wider
ring: pairs whose chains exceed the share of bits that sets alike enough stay
within are pruned, and whole shingle sets are compared for the others. A link
is one only if the sets themselves are alike to 0.8; the bits are set so wide
that fewer than one alike pair in 10^9 lies beyond them, and sets of few
shingles, whose bits say less, are never pruned. A set is held against the
leaders met so far, and becomes a leader if it is alike to none; followers of
leaders nearby are tried as well, so that a block connects what all its pairs
would. A block is the work of one task. Crowded blocks are cut by 16 further
bands of other minima wherever that lessens the pairs in them to a quarter; where
it does not, their texts are close to each other and follow a few leaders.

A text without words has fingerprint zero and links like any other; null texts
count as empty. Rows without id belong to a class but never name a component;
a component of such rows only has a null id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from rasterloom.llm.fingerprints import Sketch
from rasterloom.llm.texts import keyed, mixed, packed, shingle_hashes, sliced, spread, whole_text
from rasterloom.session import cut_lineage

SEED, BITS = 42, 64
# Lowest bit and width of each segment of the ring; the last closes it.
SEGMENTS = ((0, 13), (13, 13), (26, 13), (39, 13), (52, 12))
MOST_BITS = 2
BUCKET = 64

# Alike texts: words of a shingle, 64-bit lanes of a set's digest, and the Jaccard likeness that links, as a fraction.
ALIKE_WORDS, LANES, ALIKE_OF, ALIKE_IN = 5, 2, 4, 5
# Bits of 128 that prints of alike texts differ in, mostly. A measure of prints only: no link rests on it.
ALIKE_BITS = 24
# Fingerprints of a set, the segments of its wide ring, and how many of their 256 bits sets alike to 0.8 and to 0.6
# (twice the distance) may differ in. A bit of such sets differs with a chance of 0.158 and 0.231 at most, from ``FEW``
# shingles on, so that 2 pairs in 10^10 lie beyond. Smaller sets are compared whole.
PRINTS, NEAR_BITS, FAR_BITS, FEW = 4, 80, 104, 16
# Minima of a band, bands, and classes of a block that is not crowded.
BAND, BANDS, BLOCK = 4, 16, 4096


# The bits of every byte, one in each byte of a 64-bit value.
_SPREAD = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").view("<u8").ravel()


def fingerprint(hashes: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """One value per text: a bit is set if more than half of the text's hashes set it.

    The hashes of a text stand together, texts in order. Bits are counted eight
    at a time in the bytes of a word, over 255 hashes at most.
    """
    ones = np.zeros((n, BITS), np.int64)
    counts = np.bincount(owner, minlength=n)
    held = np.flatnonzero(counts)
    if len(held):
        parts = -(-counts[held] // 255)
        firsts = np.cumsum(parts) - parts
        starts = np.repeat((np.cumsum(counts) - counts)[held], parts) + 255 * spread(np.zeros(len(held), np.int64), parts)
        octets = np.ascontiguousarray(hashes.astype("<u8").view(np.uint8).reshape(-1, 8).T)
        for i, octet in enumerate(octets):
            sums = np.add.reduceat(_SPREAD[octet], starts).view(np.uint8).reshape(-1, 8)
            ones[held, 8 * i : 8 * i + 8] = np.add.reduceat(sums, firsts, axis=0, dtype=np.int64)
    return np.packbits(2 * ones > counts[:, None], axis=1, bitorder="little").view("<u8").ravel()


def shingles(text: str, words: int) -> list[bytes]:
    found = text.encode().lower().split()
    if len(found) < words:
        return [b" ".join(found)] if found else []
    return list(map(b" ".join, zip(*(found[i:] for i in range(words)))))


def fingerprints(docs: DataFrame, words: int = 3, *kept: str) -> DataFrame:
    """``doc_id``, the fingerprint as a signed 64-bit ``fp``, and other columns to keep, of every row."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in sliced(batches):
            hashes, counts = [], []
            for text in part.column("text").to_pylist():
                own = [xxhash.xxh64_intdigest(shingle, SEED) for shingle in shingles(text, words)]
                hashes += own
                counts.append(len(own))
            owner = np.repeat(np.arange(len(counts)), counts)
            values = fingerprint(np.array(hashes, np.uint64), owner, len(counts))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(values.view(np.int64))], names=["doc_id", "fp"])

    return rows.mapInArrow(run, "doc_id long, fp long")


def segment(fp: Column, i: int) -> Column:
    low, width = SEGMENTS[i % len(SEGMENTS)]
    return F.shiftrightunsigned(fp, low).bitwiseAND(F.lit((1 << width) - 1).cast("long"))


def chain_mask(start: int, length: int) -> int:
    """The bits of consecutive segments, as a signed value."""
    mask = 0
    for i in range(start, start + length):
        low, width = SEGMENTS[i % len(SEGMENTS)]
        mask |= ((1 << width) - 1) << low
    return mask - (1 << 64) if mask >> 63 else mask


def differing(mask: int) -> Column:
    return F.bit_count(F.col("fp").bitwiseXOR(F.col("other")).bitwiseAND(F.lit(mask).cast("long")))


def chains_hold(most: int = MOST_BITS) -> Column:
    """Whether all chains from segment ``start`` stay within their share of ``most`` bits."""
    held = F.lit(False)
    n = len(SEGMENTS)
    for start in range(n):
        within = F.lit(True)
        for length in range(1, n + 1):
            within = within & (differing(chain_mask(start, length)) <= most * length // n)
        held = F.when(F.col("start") == start, within).otherwise(held)
    return held


def class_links(classes: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """Links ``u`` < ``v`` between distinct fingerprints at two bits or fewer, enough to connect all such."""
    fp = F.col("fp")
    starts = F.array(
        *[F.struct(F.lit(i).alias("start"), (segment(fp, i) * F.lit(1 << 13) + segment(fp, i + 1)).alias("pair")) for i in range(len(SEGMENTS))]
    )
    entries = classes.select("fp", F.explode(starts).alias("at")).select("fp", "at.start", "at.pair")
    sizes = entries.groupBy("start", "pair").agg(F.count("*").alias("size")).where("size > 1")
    few = sizes.where(F.col("size") <= bucket).select("start", "pair")
    many = sizes.where(F.col("size") > bucket).select("start", "pair")

    met = entries.join(few, ["start", "pair"])
    pairs = (
        met.join(met.withColumnRenamed("fp", "other"), ["start", "pair"])
        .where(F.col("fp") < F.col("other"))
        .where(chains_hold())
        .where(differing(-1) <= MOST_BITS)
        .select(F.col("fp").alias("u"), F.col("other").alias("v"))
    )

    crowded = entries.join(many, ["start", "pair"], "left_semi").select("fp").distinct()
    flips = F.array(*[F.lit(0).cast("long")], *[F.lit((1 << i) - (1 << 64 if i == 63 else 0)).cast("long") for i in range(BITS)])
    near = crowded.select("fp", F.explode(flips).alias("flip")).select("fp", fp.bitwiseXOR(F.col("flip")).alias("point"))
    # the least fingerprint at a point stands for all others there
    least = near.groupBy("point").agg(F.min("fp").alias("u"), F.count("*").alias("size")).where("size > 1")
    stars = near.join(least, "point").where(F.col("u") != fp).select("u", fp.alias("v"))
    return pairs.unionByName(stars).distinct()


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root``, the least node that it reaches, for all nodes of the links ``u``, ``v``."""
    edges = cut_lineage(links.select("u", "v"))
    state = None
    while True:
        # large star: larger neighbours move to the least neighbour
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where(F.col("v") > F.col("u")).join(least, "u").select(F.col("m").alias("u"), "v").distinct()
        # small star: smaller neighbours, and the node itself, move to the least of them
        low = large.groupBy("v").agg(F.min("u").alias("m"))
        small = large.join(low, "v").select(F.col("m").alias("a"), F.explode(F.array("u", "v")).alias("b"))
        edges = cut_lineage(small.where(F.col("a") != F.col("b")).select(F.col("a").alias("u"), F.col("b").alias("v")).distinct())
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    roots = edges.select(F.col("v").alias("node"), F.col("u").alias("root"))
    return roots.unionByName(edges.select(F.col("u").alias("node"), F.col("u").alias("root"))).distinct()


def near_duplicates(docs: DataFrame, words: int = 3, bucket: int = BUCKET) -> DataFrame:
    """``doc_id``, ``fp`` and ``component_id``, the least id reachable over links, of every row."""
    rows = cut_lineage(fingerprints(docs, words))
    classes = rows.groupBy("fp").agg(F.min("doc_id").alias("first"))
    found = components(class_links(classes.select("fp"), bucket))
    rooted = classes.join(found.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    firsts = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = rooted.join(firsts, "root").select("fp", "component_id")
    return rows.join(named, "fp").select("doc_id", "fp", "component_id")


def digits(fp: Column) -> Column:
    """A fingerprint as 16 lowercase hexadecimal digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def ring_survivors(counts: np.ndarray, most: int) -> np.ndarray:
    """Rows of per-segment differences with a start from which all chains keep to their share of ``most``."""
    n = counts.shape[1]
    going = np.ones(counts.shape, bool)
    total = np.zeros(counts.shape, np.int64)
    for length in range(1, n + 1):
        total += np.roll(counts, 1 - length, axis=1)
        going &= total <= most * length // n
    return going.any(axis=1)


def sets_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes, sorted within each text, and the text each is from."""
    hashes, owner = shingle_hashes(texts, ALIKE_WORDS)
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    return hashes[new], owner[new]


def set_digests(hashes: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """A row of lanes per text: sums of its mixed shingle hashes, zero without words."""
    found = np.zeros((n, LANES), np.uint64)
    counts = np.bincount(owner, minlength=n)
    held = np.flatnonzero(counts)
    if len(held):
        starts = (np.cumsum(counts) - counts)[held]
        for lane in range(LANES):
            found[held, lane] = np.add.reduceat(mixed(hashes + np.uint64(lane + 1)), starts)
    return found


def set_prints(hashes: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """A row of fingerprints per text, each of the shingle hashes mixed in another way."""
    return np.stack([fingerprint(mixed(hashes + np.uint64(lane)), owner, n) for lane in range(PRINTS)], axis=1)


def alike_classes(docs: DataFrame) -> DataFrame:
    """Of every row ``rid``, ``rkey``, the digest ``fp`` of the shingle set as bytes, its ``prints`` as bytes and the first
    of them as ``point``, its ``bands`` and ``finer`` bands (none without words)."""
    sketch = Sketch(ALIKE_WORDS, BAND * BANDS)

    def bands(hashes: np.ndarray, owner: np.ndarray, n: int) -> pa.Array:
        minima, worded = sketch.table(hashes, owner, n)
        rows = minima.reshape(n, BANDS, BAND)
        keys = np.zeros((n, BANDS), np.uint64)
        for i in range(BAND):
            keys = mixed(keys + rows[:, :, i])
        keys += np.arange(BANDS, dtype=np.uint64)
        return pa.array([own.tolist() if held else [] for own, held in zip(keys.view(np.int64), worded)], pa.list_(pa.int64()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in sliced(batches):
            n = part.num_rows
            hashes, owner = sets_of(part.column("text").to_pylist())
            values = set_digests(hashes, owner, n)
            digests = pa.array([row.tobytes() for row in values], pa.binary())
            prints = set_prints(hashes, owner, n)
            made = [digests, pa.array([row.tobytes() for row in prints], pa.binary()), pa.array(prints[:, 0].view(np.int64))]
            made += [bands(hashes, owner, n), bands(mixed(hashes + np.uint64(LANES + 1)), owner, n)]
            names = ["rid", "rkey", "fp", "prints", "point", "bands", "finer"]
            yield pa.RecordBatch.from_arrays([part.column("rid"), part.column("rkey"), *made], names=names)

    schema = "rid long, rkey long, fp binary, prints binary, point long, bands array<long>, finer array<long>"
    return keyed(docs).select("rid", "rkey", "text").mapInArrow(run, schema)


def shared(one: np.ndarray, other: np.ndarray) -> int:
    """Common values of two sorted sets."""
    few, many = (one, other) if len(one) <= len(other) else (other, one)
    return int((many[np.minimum(np.searchsorted(many, few), len(many) - 1)] == few).sum())


class Block:
    """Sets that share a band. ``add`` gives links of a set to those before it, enough to connect all that are alike.

    Sets are compared whole only if the chains of their prints allow it. One minus the likeness is a distance, at most ``APART`` between alike sets.
    A set alike to a follower of a leader is within twice that of the leader,
    so only followers of such leaders are tried, and of them only those whose
    own distance to the leader allows it. Sets that are connected already are
    not compared again.
    """

    APART = 1 - ALIKE_OF / ALIKE_IN

    def __init__(self):
        self.names: list[bytes] = []
        self.sets: list[np.ndarray] = []
        self.root: list[int] = []
        self.prints: list[int] = []
        # numbers of the leaders, sizes of their sets, their prints, and who follows each at what distance
        self.leaders: list[int] = []
        self.sizes = np.zeros(16, np.int64)
        self.rings = np.zeros((16, PRINTS), np.uint64)
        self.followers: list[list[tuple[int, float]]] = []

    def top(self, i: int) -> int:
        while self.root[i] != i:
            self.root[i] = i = self.root[self.root[i]]
        return i

    def add(self, name: bytes, own: np.ndarray, prints: np.ndarray | None = None) -> list[tuple[bytes, bytes]]:
        found: list[tuple[bytes, bytes]] = []
        me, n = len(self.sets), len(own)
        if prints is None:
            prints = set_prints(own, np.zeros(n, np.int64), 1)[0]
        self.names.append(name)
        self.sets.append(own)
        self.root.append(me)
        self.prints.append(int.from_bytes(prints.tobytes(), "little"))
        led, near = False, []
        sizes = self.sizes[: len(self.leaders)]
        # sets within twice the distance have sizes in this proportion at least
        likely = np.flatnonzero(np.minimum(sizes, n) >= (1 - 2 * self.APART - 1e-9) * np.maximum(sizes, n))
        if n >= FEW and len(likely):
            within = ring_survivors(np.bitwise_count(self.rings[likely] ^ prints), FAR_BITS)
            likely = likely[within | (sizes[likely] < FEW)]
        for at in likely.tolist():
            leader = self.leaders[at]
            both, all_ = self._common(me, leader)
            far = 1 - both / all_
            if ALIKE_IN * both >= ALIKE_OF * all_:
                if not led:
                    self.followers[at].append((me, far))
                    led = True
                if self._join(me, leader):
                    found.append((name, self.names[leader]))
            elif far <= 2 * self.APART + 1e-9:
                near.append((at, far))
        for at, far in near:
            if self.top(self.leaders[at]) != self.top(me):
                for other, its in self.followers[at]:
                    if its >= far - self.APART - 1e-9 and self._alike(me, other):
                        self._join(me, other)
                        found.append((name, self.names[other]))
                        break
        if not led:
            if len(self.leaders) == len(self.sizes):
                self.sizes = np.concatenate([self.sizes, np.zeros_like(self.sizes)])
                self.rings = np.concatenate([self.rings, np.zeros_like(self.rings)])
            self.sizes[len(self.leaders)] = n
            self.rings[len(self.leaders)] = prints
            self.leaders.append(me)
            self.followers.append([])
        return found

    def _common(self, one: int, other: int) -> tuple[int, int]:
        both = shared(self.sets[one], self.sets[other])
        return both, len(self.sets[one]) + len(self.sets[other]) - both

    def _alike(self, one: int, other: int) -> bool:
        if min(len(self.sets[one]), len(self.sets[other])) >= FEW and (self.prints[one] ^ self.prints[other]).bit_count() > NEAR_BITS:
            return False
        both, all_ = self._common(one, other)
        return ALIKE_IN * both >= ALIKE_OF * all_

    def _join(self, one: int, other: int) -> bool:
        a, b = self.top(one), self.top(other)
        self.root[max(a, b)] = min(a, b)
        return a != b


def linked(blocks: DataFrame) -> DataFrame:
    """Links ``one``, ``other`` between alike sets (``hashes``, named ``fp``, with their ``prints``) of a block (``band``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, block, last = None, Block(), None
        for batch in batches:
            found: list[tuple[bytes, bytes]] = []
            names, prints, hashes = batch.column("fp"), batch.column("prints"), batch.column("hashes")
            for i, band in enumerate(batch.column("band").to_pylist()):
                if band != held:
                    held, block, last = band, Block(), None
                if (name := names[i].as_py()) != last:
                    last = name
                    found += block.add(name, np.frombuffer(hashes[i].as_py(), np.uint64), np.frombuffer(prints[i].as_py(), np.uint64))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(side, pa.binary()) for side in zip(*found)], names=["one", "other"])

    placed = blocks.select("band", "fp", "prints", "hashes").repartition(F.col("band")).sortWithinPartitions("band", "fp")
    return placed.mapInArrow(run, "one binary, other binary")


def with_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``fp``, ``prints``, ``bands`` and the shingle set ``hashes`` of the ``wanted`` texts, which have ``rid`` and ``rkey``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in sliced(batches):
            n = part.num_rows
            hashes, owner = sets_of(part.column("text").to_pylist())
            sets = np.split(hashes, np.cumsum(np.bincount(owner, minlength=n))[:-1])
            made = pa.array([own.tobytes() for own in sets], pa.binary())
            kept = [part.column(name) for name in ("fp", "prints", "bands")]
            yield pa.RecordBatch.from_arrays([*kept, made], names=["fp", "prints", "bands", "hashes"])

    texts = keyed(docs).select("rid", "rkey", "text").join(wanted, ["rid", "rkey"])
    return texts.select("fp", "prints", "bands", "text").mapInArrow(run, "fp binary, prints binary, bands array<long>, hashes binary")


def ring_bands(rows: DataFrame) -> DataFrame:
    """``fp`` and a ``band`` that it shares with those whose ``point`` its own reaches by steps of two bits or fewer."""
    points = cut_lineage(rows.where(F.size("bands") > 0).select("fp", "point").distinct())
    found = components(class_links(points.select(F.col("point").alias("fp")).distinct())).withColumnRenamed("node", "point")
    root = F.coalesce("root", "point")
    return points.join(found, "point", "left").select("fp", F.xxhash64(F.lit("ring"), root).alias("band"))


def shared_bands(classes: DataFrame, block: int = BLOCK, more: DataFrame | None = None) -> DataFrame:
    """``fp`` and ``band`` of the blocks of two classes or more; ``classes`` has distinct ``fp``, its ``bands`` and ``finer``
    bands, ``more`` has further bands as ``fp`` and ``band``."""
    entries = classes.select("fp", F.explode("bands").alias("band"))
    if more is not None:
        entries = entries.unionByName(more)
    sizes = cut_lineage(entries.groupBy("band").agg(F.count("*").alias("size")).where("size > 1"))
    crowded = sizes.where(F.col("size") > block)
    if crowded.isEmpty():
        return entries.join(sizes.select("band"), "band").select("fp", "band")
    parts = entries.join(crowded.select("band"), "band").join(classes.select("fp", F.explode("finer").alias("finer")), "fp")
    parts = parts.select("fp", F.col("band").alias("whole"), F.xxhash64("band", "finer").alias("band"))
    part_sizes = cut_lineage(parts.groupBy("whole", "band").agg(F.count("*").alias("size")).where("size > 1"))
    pairs = part_sizes.groupBy("whole").agg(F.sum(F.col("size").cast("double") * F.col("size")).alias("pairs"))
    closer = pairs.join(crowded.withColumnRenamed("band", "whole"), "whole").where(F.col("pairs") * 4 > F.col("size").cast("double") * F.col("size")).select("whole")
    thinned = part_sizes.join(closer, "whole", "left_anti").select("whole", "band")
    kept = sizes.where(F.col("size") <= block).select("band").unionByName(closer.select(F.col("whole").alias("band")))
    return entries.join(kept, "band").select("fp", "band").unionByName(parts.join(thinned, ["whole", "band"]).select("fp", "band"))


def alike_links(docs: DataFrame, classes: DataFrame, ring: DataFrame, block: int = BLOCK) -> DataFrame:
    """Links ``u`` < ``v`` between digests of alike texts; ``classes`` has distinct ``fp``, its prints, its bands and its
    ``first`` row, ``ring`` the bands of the ring."""
    met = shared_bands(classes, block, ring).groupBy("fp").agg(F.collect_list("band").alias("bands"))
    wanted = classes.select("fp", "prints", "first.rid", "first.rkey").join(met, "fp")
    blocks = with_sets(docs, wanted).select(F.explode("bands").alias("band"), "fp", "prints", "hashes")
    return linked(blocks).select(F.least("one", "other").alias("u"), F.greatest("one", "other").alias("v")).distinct()


def one_of_each(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """All columns of one row of each group of alike texts: the least id's, then the least key's.

    Texts without words are one group. Rows that repeat an id and a text are one.
    """
    rows = cut_lineage(alike_classes(docs))
    first = F.min(F.struct("rid", "rkey")).alias("first")
    own = [F.min(name).alias(name) for name in ("prints", "bands", "finer")]
    classes = rows.groupBy("fp").agg(first, *own)
    found = components(alike_links(docs, classes, ring_bands(rows), block))
    rooted = classes.join(found.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    kept = rooted.groupBy("root").agg(F.min("first").alias("first")).select("first.rid", "first.rkey")
    return packed(docs).select("rid", "rkey", "row").join(kept, ["rid", "rkey"]).dropDuplicates(["rid", "rkey"]).select("row.*")
