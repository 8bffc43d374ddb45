"""Removal of repeated byte strings by suffix arrays of content-addressed shards.

A byte goes if a string of ``LENGTH`` bytes covers it that also begins earlier:
in a row before (by doc_id, null first), or before in the same text.

Every such string (a window) has an anchor, its ``GRAM`` bytes with the least
hash, the leftmost of equal ones; equal windows have equal anchors. Neighbouring
windows with one anchor form a segment, and a segment is known by its anchor
and a digest of its bytes. Segments whose anchor stands once in the corpus hold
nothing repeated. Of equal segments all but the earliest are repeats as a whole.
Where all segments of an anchor are equal, the earliest holds no repeat either,
since two equal windows of one segment would have one place. What is left are
anchors in several surroundings: their earliest segments are cut out of the
texts, and all of an anchor go to one shard. A shard's suffix array is made by
induced sorting:
suffixes are classified, leftmost-smaller substrings are sorted by recursion,
and the rest is induced in linear work, in blocks of entries that do not reach
each other. Common prefixes are computed in text order (irreducible ones by
comparison, the others follow). Where ``LENGTH`` bytes are common, all windows
but the earliest are repeats.

An anchor with more than ``CROWD`` different segments is cut by longer cores:
windows are parted by how far before the anchor they begin, and keyed by all
bytes that such windows share. In the end a core is the window itself, and
equal ones are one row, so no anchor has to fit one task.

Null and empty texts have no bytes. Rows of one id stand in order of a hash of
their texts; rows of one id and text are one text, and each loses what it loses.
Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, functions as F

from rasterloom.llm.texts import POWERS, mixed, row_id, sliced, spread, text_key, whole_text
from rasterloom.session import cut_lineage, scratch_path

LENGTH = 100
# Bytes of an anchor; windows of one segment are LENGTH - GRAM + 1 at most, which a long's bits must hold.
GRAM = 37
REACH = LENGTH - GRAM
# Bytes of a shard, about, and different segments of an anchor that go to one.
SHARD_BYTES, CROWD = 2 << 20, 4096
# Suffixes from which on an order is scanned in blocks.
BLOCKS_FROM = 300_000
# Texts whose spans are put together at once, and bits for a place within one.
TEXTS, TEXT_SHIFT = 1024, 44
# Windows of a text that one pass finds anchors for; what it computes on then fits a core's cache.
PART = 1 << 16


# ---- anchors


def parts(texts: list[bytes], limit: int = PART) -> Iterator[list[tuple[int, int, bytes]]]:
    """Number of the text, offset and bytes of stretches, in lists of about ``limit`` bytes; every window is in one stretch."""
    held, size = [], 0
    for number, text in enumerate(texts):
        for at in range(0, len(text) - LENGTH + 1, limit):
            stretch = text[at : at + limit + LENGTH - 1]
            if held and size + len(stretch) > limit:
                yield held
                held, size = [], 0
            held.append((number, at, stretch))
            size += len(stretch)
    if held:
        yield held


def segments(stretches: list[tuple[int, int, bytes]]) -> tuple[np.ndarray, ...]:
    """Text, first window, number of windows, place of the anchor behind the first window, hash of the anchor and digest of the bytes, of all segments."""
    data = np.frombuffer(b"".join(each for _, _, each in stretches), np.uint8)
    sizes = np.array([len(each) for _, _, each in stretches], np.int64)
    begins = np.cumsum(sizes) - sizes
    up, down = POWERS.to(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    hashes = mixed((sums[GRAM:] - sums[:-GRAM]) * down[: len(sums) - GRAM])
    # the place in the low half settles ties for the leftmost
    least = hashes >> np.uint64(32) << np.uint64(32) | np.arange(len(hashes), dtype=np.uint64)
    span = 1
    while 2 * span <= REACH + 1:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span <= REACH:
        rest = REACH + 1 - span
        least = np.minimum(least[:-rest], least[rest:])
    windows = sizes - LENGTH + 1
    at = spread(begins, windows)
    anchor = (least[at] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    heads = np.flatnonzero(np.diff(anchor, prepend=-1) | np.diff(np.repeat(np.arange(len(sizes)), windows), prepend=-1))
    stretch = np.searchsorted(begins, at[heads], "right") - 1
    counts = np.diff(heads, append=len(at))
    offsets = np.array([offset for _, offset, _ in stretches], np.int64)
    numbers = np.array([number for number, _, _ in stretches], np.int64)
    first = at[heads]
    digest = mixed((sums[first + counts + LENGTH - 1] - sums[first]) * down[first] + counts.astype(np.uint64))
    place = first - begins[stretch] + offsets[stretch]
    return numbers[stretch], place, counts, anchor[heads] - first, hashes[anchor[heads]].view(np.int64), digest.view(np.int64)


def text_rows(docs: DataFrame) -> DataFrame:
    """``rid``, ``rkey``, ``doc_id`` and the text's bytes, compressed: what stands for a row in joins."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=3, write_content_size=True).compress
        for part in sliced(batches):
            made = [squeeze(text.encode()) for text in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column("rid"), part.column("rkey"), part.column("doc_id"), pa.array(made, pa.binary())], names=["rid", "rkey", "doc_id", "packed"])

    return named_rows(docs).mapInArrow(run, "rid long, rkey int, doc_id long, packed binary")


def named_rows(docs: DataFrame) -> DataFrame:
    # the low half of the hash tells rows of one id apart
    return docs.select(row_id().alias("rid"), text_key().bitwiseAND(F.lit(0x7FFFFFFF)).cast("int").alias("rkey"), F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))


def anchors(docs: DataFrame) -> DataFrame:
    """``key`` (hash of the anchor) and ``digest`` of every segment, whose it is and where it stands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            found = [segments(stretches) for stretches in parts([text.encode() for text in batch.column("text").to_pylist()])]
            if found:
                text, at, counts, lead, key, digest = (np.concatenate(columns) for columns in zip(*found))
                of = pa.array(text)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key), pa.array(digest), batch.column("rid").take(of), batch.column("rkey").take(of), pa.array(at << 16 | counts << 8 | lead)],
                    names=["key", "digest", "rid", "rkey", "place"],
                )

    return named_rows(docs).select("rid", "rkey", "text").mapInArrow(run, "key long, digest long, rid long, rkey int, place long")


def written(rows: DataFrame, name: str) -> DataFrame:
    """The rows as a table in the shared folder."""
    path = scratch_path(rows.sparkSession, name)
    rows.write.option("compression", "zstd").parquet(path)
    return rows.sparkSession.read.parquet(path)


def candidates(docs: DataFrame) -> DataFrame:
    """All segments whose anchor stands elsewhere too."""
    every = written(anchors(docs), "anchors")
    several = every.groupBy("key").count().where("count > 1").select("key")
    return written(every.join(several, "key", "left_semi"), "candidates")


def by_text(rows: DataFrame) -> DataFrame:
    """``rid``, ``rkey`` and ``places`` of the segments of each text; rows of one id and text count once."""
    return rows.groupBy("rid", "rkey").agg(F.collect_set("place").alias("places"))


# ---- segments


SEGMENT = "key long, body binary, lead int, low int, high int, rid long, rkey int, at long"


def core_key(body: bytes, lead: int, low: int, high: int) -> int:
    """Hash of the bytes shared by all windows that begin ``low`` to ``high`` bytes before the anchor."""
    found = xxhash.xxh64_intdigest(body[lead - low : lead - high + LENGTH], low << 8 | high)
    return found - (1 << 64) if found >> 63 else found


def rows_of(segments: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.binary(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int64()]
    columns = list(zip(*segments)) or [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(column, kind) for column, kind in zip(columns, kinds)], names=[field.split()[0] for field in SEGMENT.split(", ")])


def cut_segments(texts: DataFrame, found: DataFrame) -> DataFrame:
    """The candidate segments with their bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        widen = zstandard.ZstdDecompressor().decompress
        for part in sliced(batches, "packed"):
            for rid, rkey, raw, places in zip(*(part.column(name).to_pylist() for name in ("rid", "rkey", "packed", "places"))):
                text, made = widen(raw), []
                for place in places:
                    at, n, lead = place >> 16, place >> 8 & 255, place & 255
                    body = text[at : at + n + LENGTH - 1]
                    made.append((core_key(body, lead, 0, REACH), body, lead, 0, REACH, rid, rkey, at))
                    if len(made) == 10_000:
                        yield rows_of(made)
                        made = []
                yield rows_of(made)

    joined = texts.select("rid", "rkey", "packed").join(found, ["rid", "rkey"])
    return joined.select("rid", "rkey", "packed", "places").mapInArrow(run, SEGMENT)


def earliest(rows: DataFrame) -> DataFrame:
    """Of equal segments the one that stands first."""
    first = F.min(F.struct("rid", "rkey", "place")).alias("first")
    return rows.groupBy("key", "digest").agg(first).select("key", "digest", "first.rid", "first.rkey", "first.place")


def earliest_bodies(rows: DataFrame) -> DataFrame:
    """Of equal segments that were cut out the one that stands first."""
    first = F.min(F.struct("rid", "rkey", "at")).alias("first")
    return rows.groupBy("key", "body", "lead", "low", "high").agg(first).select("key", "body", "lead", "low", "high", "first.rid", "first.rkey", "first.at")


def halves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each segment parted in windows that begin nearer to the anchor and farther from it."""
    for batch in batches:
        made = []
        for body, lead, low, high, rid, rkey, at in zip(*(batch.column(field.split()[0]).to_pylist() for field in SEGMENT.split(", ")[1:])):
            middle, n = (low + high) // 2, len(body) - LENGTH + 1
            split = min(n, max(0, lead - middle))
            if split > 0:
                far = body[: split + LENGTH - 1]
                made.append((core_key(far, lead, middle + 1, high), far, lead, middle + 1, high, rid, rkey, at))
            if split < n:
                near = body[split:]
                made.append((core_key(near, lead - split, low, middle), near, lead - split, low, middle, rid, rkey, at + split))
        yield rows_of(made)


def uncrowded(rows: DataFrame, crowd: int = CROWD) -> DataFrame:
    """The segments, keyed so that no key has more than ``crowd``; written to the shared folder."""
    held, done = written(rows, "segments"), []
    while True:
        crowded = cut_lineage(held.groupBy("key").agg(F.count("*").alias("n"), F.max(F.col("high") - F.col("low")).alias("width")).where((F.col("n") > crowd) & (F.col("width") > 0)).select("key"))
        if crowded.isEmpty():
            break
        done.append(held.join(crowded, "key", "left_anti"))
        held = written(earliest_bodies(held.join(crowded, "key", "left_semi").mapInArrow(halves, SEGMENT)), "segments")
    for some in done:
        held = held.unionByName(some)
    return held


# ---- suffix arrays


def rising(s: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the next one; the last, a sentinel, counts as such."""
    n = len(s)
    change = (s[1:] > s[:-1]).astype(np.int8) - (s[1:] < s[:-1])
    place = np.where(change != 0, np.arange(n - 1), n)
    following = np.minimum.accumulate(place[::-1])[::-1] if n > 1 else place
    found = np.ones(n, bool)
    found[:-1] = np.append(change, 1)[np.minimum(following, n - 1)] > 0
    return found


def induce(s: np.ndarray, order: np.ndarray, small: np.ndarray, ends: np.ndarray, backwards: bool) -> np.ndarray:
    """Place, in one scan of ``order``, the suffix before each entry, if it is of the scanned kind, at its bucket's free end.

    Forwards the larger suffixes go to the heads of their buckets; backwards the
    smaller ones to the tails. What is placed lies ahead of the scan and is met
    by it. Long orders are scanned in blocks that no entry of the block places
    anything into, short ones entry by entry.
    """
    if len(order) < BLOCKS_FROM:
        return one_by_one(s.tolist(), order.tolist(), small.tolist(), ends.tolist(), backwards)
    n, at, width = len(order), 0, 256
    view = order[::-1] if backwards else order
    # free places counted in the direction of the scan
    free = n - ends if backwards else ends.copy()
    numbers, limits = np.arange(1, n + 1, dtype=np.int32), np.empty(1 << 18, np.int64)
    while at < n:
        block = view[at : at + width]
        before = block - 1
        taken = small[before] == backwards
        taken &= before >= 0
        which = taken.nonzero()[0]
        before = before[which]
        letters = s[before]
        limit = limits[: len(block)]
        limit[:] = n + 1
        limit[which] = free[letters] - at
        reach = int(np.count_nonzero(np.minimum.accumulate(limit) >= numbers[: len(block)]))
        some = len(which) if reach == len(block) else int(which.searchsorted(reach))
        if some:
            before, letters = before[:some], letters[:some]
            sort = letters.argsort(kind="stable")
            ranked = letters[sort]
            new = np.empty(some, bool)
            new[0] = True
            np.not_equal(ranked[1:], ranked[:-1], out=new[1:])
            heads = new.nonzero()[0]
            own = ranked[heads]
            counts = np.empty(len(heads), np.int64)
            counts[:-1] = heads[1:] - heads[:-1]
            counts[-1] = some - heads[-1]
            view[(free[own] - heads).repeat(counts) + numbers[:some] - 1] = before[sort]
            free[own] += counts
        at += reach
        width = min(len(limits), 2 * width if reach == len(block) else max(64, 2 * reach))
    return order


def one_by_one(s: list[int], order: list[int], small: list[bool], ends: list[int], backwards: bool) -> np.ndarray:
    """The scan of ``induce``; a list under a loop shows what is placed ahead."""
    for entry in reversed(order) if backwards else order:
        before = entry - 1
        if before >= 0 and small[before] == backwards:
            letter = s[before]
            place = ends[letter]
            if backwards:
                place -= 1
                ends[letter] = place
            else:
                ends[letter] = place + 1
            order[place] = before
    return np.array(order, np.int32)


def suffix_array(s: np.ndarray, letters: int) -> np.ndarray:
    """Order of all suffixes of ``s``, whose last letter is 0 and stands nowhere else."""
    n = len(s)
    if n == 1:
        return np.zeros(1, np.int32)
    small = rising(s)
    marks = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    counts = np.bincount(s, minlength=letters)
    tails = np.cumsum(counts)
    heads = tails - counts

    def sorted_from(seeds: np.ndarray) -> np.ndarray:
        """All suffixes, induced from the leftmost-smaller ones in the given order."""
        order = np.full(n, -1, np.int32)
        letter = s[seeds]
        sort = np.argsort(letter, kind="stable")
        ranked = letter[sort]
        first = np.flatnonzero(np.diff(ranked, prepend=-1))
        sizes = np.diff(first, append=len(seeds))
        own = ranked[first]
        order[np.repeat(tails[own] - sizes - first, sizes) + np.arange(len(seeds))] = seeds[sort]
        order = induce(s, order, small, heads, False)
        order[small[np.maximum(order, 0)] & (order != n - 1)] = -1
        return induce(s, order, small, tails, True)

    order = sorted_from(marks)
    is_mark = np.zeros(n, bool)
    is_mark[marks] = True
    ranked = order[is_mark[order]]
    # equal substrings from mark to mark have one name
    following = np.append(marks[1:], n - 1)
    length = np.zeros(n, np.int64)
    length[marks] = following - marks + 1
    a, b = ranked[:-1], ranked[1:]
    differ = length[a] != length[b]
    same = np.flatnonzero(~differ)
    if len(same):
        sizes = length[a[same]]
        unequal = s[spread(a[same], sizes)] != s[spread(b[same], sizes)]
        differ[same] = np.add.reduceat(unequal, np.cumsum(sizes) - sizes) > 0
    names = np.zeros(n, np.int32)
    names[ranked] = np.append(0, np.cumsum(differ))
    reduced = names[marks]
    kinds = int(reduced.max()) + 1
    if kinds == len(marks):
        below = np.empty(len(marks), np.int64)
        below[reduced] = np.arange(len(marks))
    else:
        below = suffix_array(reduced, kinds)
    return sorted_from(marks[below])


def common_prefixes(s: np.ndarray, order: np.ndarray) -> np.ndarray:
    """For every place, letters that its suffix shares with the one before it in order.

    Only places whose left letter differs from that of the other suffix are
    compared; each further place to the right has one letter less.
    """
    n = len(s)
    other = np.empty(n, np.int64)
    other[order[1:]], other[order[0]] = order[:-1], -1
    alone = (other <= 0) | (np.arange(n) == 0)
    inner = np.flatnonzero(~alone)
    alone[inner] = s[inner - 1] != s[other[inner] - 1]
    heads = np.flatnonzero(alone)
    length = np.zeros(len(heads), np.int64)
    padded = np.concatenate([s, -1 - np.arange(16, dtype=s.dtype)])
    active = np.flatnonzero(other[heads] >= 0)
    steps = np.arange(16)
    while len(active):
        x, y = heads[active] + length[active], other[heads[active]] + length[active]
        same = padded[np.minimum(x, n)[:, None] + steps] == padded[np.minimum(y, n)[:, None] + steps]
        # the sentinel stands once, so no comparison runs past the end of both
        first = np.where(same.all(axis=1), 16, same.argmin(axis=1))
        length[active] += first
        active = active[first == 16]
    found = np.maximum.accumulate(np.where(alone, np.arange(n), 0))
    which = np.cumsum(alone) - 1
    return length[which] - (np.arange(n) - found)


def first_windows(bodies: list[bytes], begins: np.ndarray) -> np.ndarray:
    """Bits of the windows of each body that begin no later than all equal windows of the bodies.

    ``begins`` orders the first windows: a number per body, later windows follow one by one.
    """
    sizes = np.array([len(body) for body in bodies], np.int64)
    starts = np.cumsum(sizes + 1) - sizes - 1
    s = np.frombuffer(b"".join(bodies), np.uint8).astype(np.int16) + np.int16(2)
    s = np.insert(s, np.cumsum(sizes), 1)
    s = np.append(s, 0)
    order = suffix_array(s, 258)
    shared = common_prefixes(s, order)
    windows = sizes - LENGTH + 1
    rank = np.full(len(s), -1, np.int64)
    place = spread(starts, windows)
    own = np.repeat(np.arange(len(bodies)), windows)
    rank[place] = begins[own] + (place - starts[own])
    group = np.cumsum(shared[order] < LENGTH) - 1
    held = np.flatnonzero(rank[order] >= 0)
    group, ranks = group[held], rank[order[held]]
    heads = np.flatnonzero(np.diff(group, prepend=-1))
    least = np.minimum.reduceat(ranks, heads) if len(heads) else ranks
    first = np.zeros(len(s), bool)
    first[order[held]] = ranks == np.repeat(least, np.diff(heads, append=len(held)))
    bits = np.zeros(len(bodies), np.uint64)
    np.bitwise_or.at(bits, own, first[place].astype(np.uint64) << (place - starts[own]).astype(np.uint64))
    return bits.view(np.int64)


def first_of_shards(rows: DataFrame) -> DataFrame:
    """``rid``, ``rkey``, ``at`` and ``bits`` of the windows that stand first, shard by shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, last = [], 0, None
        for batch in batches:
            for row in zip(*(batch.column(name).to_pylist() for name in ("key", "body", "rid", "rkey", "at"))):
                if size > SHARD_BYTES and row[0] != last:
                    yield shard(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[1])
                last = row[0]
        if held:
            yield shard(held)

    def shard(rows: list[tuple]) -> pa.RecordBatch:
        _, bodies, *place = zip(*rows)
        rid, rkey, at = (np.array(column, np.int64) for column in place)
        by = np.lexsort((rkey, rid))
        change = (np.diff(rid[by], prepend=rid[by[:1]]) != 0) | (np.diff(rkey[by], prepend=rkey[by[:1]]) != 0)
        text = np.empty(len(by), np.int64)
        text[by] = np.cumsum(change)
        bits = first_windows(list(bodies), (text << 40) + at)
        some = bits != 0
        return pa.RecordBatch.from_arrays([pa.array(rid[some]), pa.array(rkey[some].astype(np.int32)), pa.array(at[some]), pa.array(bits[some])], names=["rid", "rkey", "at", "bits"])

    dealt = rows.select("key", "body", "rid", "rkey", "at").repartition("key").sortWithinPartitions("key")
    return dealt.mapInArrow(run, "rid long, rkey int, at long, bits long")


# ---- spans


def all_windows() -> Column:
    """Bits of all windows of a place."""
    return F.expr("shiftrightunsigned(-1L, 64 - int(shiftright(place, 8) & 255))")


def ragged(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All values of a column of lists, and how many each row has."""
    return column.flatten().to_numpy(zero_copy_only=False), pc.list_value_length(column).fill_null(0).to_numpy(zero_copy_only=False)


def repeated_runs(places, at, bits) -> tuple[pa.Array, pa.Array]:
    """Starts and ends of what goes from each text, from its segments and from the windows that stand first, all texts at once."""
    (place, n_places), (first, n_first), (bit, _) = places, at, bits
    texts = np.arange(len(n_places)) << TEXT_SHIFT
    counts = place >> 8 & 255
    windows = np.sort(np.repeat(np.repeat(texts, n_places), counts) + spread(place >> 16, counts))
    held = np.unpackbits(np.ascontiguousarray(bit, "<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(bool)
    kept = ((np.repeat(texts, n_first) + first)[:, None] + np.arange(64))[held]
    gone = np.ones(len(windows), bool)
    gone[np.searchsorted(windows, kept)] = False
    windows = windows[gone]
    # windows that touch or overlap make one run; texts are far apart
    heads = np.flatnonzero(np.diff(windows, prepend=-LENGTH - 1) > LENGTH)
    tails = np.append(heads[1:], len(windows))[: len(heads)] - 1
    offsets = np.searchsorted(windows[heads] >> TEXT_SHIFT, np.arange(len(n_places) + 1)).astype(np.int32)
    inside = (1 << TEXT_SHIFT) - 1
    return tuple(pa.ListArray.from_arrays(offsets, (windows[which] & inside) + more) for which, more in ((heads, 0), (tails, LENGTH)))


def spans(found: DataFrame, firsts: DataFrame) -> DataFrame:
    """``rid``, ``rkey``, ``starts`` and ``ends`` of the maximal runs of bytes that go, for texts that lose any."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS):
                part = batch.slice(at, TEXTS)
                starts, ends = repeated_runs(*(ragged(part.column(name)) for name in ("places", "at", "bits")))
                yield pa.RecordBatch.from_arrays([part.column("rid"), part.column("rkey"), starts, ends], names=["rid", "rkey", "starts", "ends"])

    # windows of a text are in one segment each, so its lists are bounded by the text
    firsts_of = firsts.groupBy("rid", "rkey").agg(F.collect_list(F.struct("at", "bits")).alias("first"))
    both = found.join(firsts_of, ["rid", "rkey"], "left").select("rid", "rkey", "places", F.col("first.at").alias("at"), F.col("first.bits").alias("bits"))
    return both.mapInArrow(run, "rid long, rkey int, starts array<long>, ends array<long>").where(F.size("starts") > 0)


def dedup_substrings(docs: DataFrame, crowd: int = CROWD) -> DataFrame:
    """``doc_id``, ``n_bytes``, the ``starts`` and ``ends`` of what goes, and ``kept``, the remaining bytes, of every row."""
    found = candidates(docs)
    firsts = written(earliest(found), "earliest")
    contested = firsts.groupBy("key").count().where("count > 1").select("key")
    cut = cut_segments(text_rows(docs), by_text(firsts.join(contested, "key", "left_semi")))
    alone = firsts.join(contested, "key", "left_anti").select("rid", "rkey", F.shiftright("place", 16).alias("at"), all_windows().alias("bits"))
    gone = spans(by_text(found), first_of_shards(uncrowded(cut, crowd)).unionByName(alone))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        widen = zstandard.ZstdDecompressor().decompress
        for part in sliced(batches, "packed"):
            sizes, kept, from_, to = [], [], [], []
            for raw, starts, ends in zip(*(part.column(name).to_pylist() for name in ("packed", "starts", "ends"))):
                text = widen(raw)
                sizes.append(len(text))
                from_.append(starts or [])
                to.append(ends or [])
                kept.append(b"".join([text[a:b] for a, b in zip([0, *to[-1]], [*from_[-1], len(text)])]) if starts else text)
            kind = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(from_, kind), pa.array(to, kind), pa.array(kept, pa.binary())],
                names=["doc_id", "n_bytes", "starts", "ends", "kept"],
            )

    whole = text_rows(docs).join(gone, ["rid", "rkey"], "left").select("doc_id", "packed", "starts", "ends")
    return whole.mapInArrow(run, "doc_id long, n_bytes long, starts array<long>, ends array<long>, kept binary")
