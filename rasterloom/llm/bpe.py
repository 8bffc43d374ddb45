"""BPE encoding and decoding with chunks that documents share encoded once.

Texts are cut where a rolling hash of the last bytes has a given form, so equal
passages give equal chunks wherever they stand. A first pass counts chunk
hashes; a chunk that occurs more than once has one owner, whose task encodes it,
and the ids go to all its other places. Every other stretch is encoded where it
stands.

A chunk's ids hold between its first and its last blank only, since its outer
words may go on beyond the cut. A join is therefore encoded again from the last
blank before it to the first blank behind it, and further on where a chunk has
no blank: there both encodings agree exactly, because the tokenizer drops
blanks and no token crosses one. ``Vocabulary`` refuses a tokenizer for which
that is not so.

Null and empty texts have no tokens and decode to an empty text. Rows that
repeat an id and a text give the same row again.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

from rasterloom.llm.texts import NO_ID, joined, keyed, mixed, sliced

# Rolling hash: bytes it covers, bits that must be zero at a cut, least bytes of a chunk.
WINDOW, CUT_BITS, LEAST_CHUNK = 32, 9, 128
# Words in each half of those whose ids one Python worker keeps.
KEPT_WORDS = 150_000
# Bytes of compressed texts that are encoded together.
PACKED_BYTES = 400_000

GEAR = (mixed(np.arange(1, 257, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32)

# Letters up to U+017F are composed already and lower-cased one by one, but for U+0130.
_UNUSUAL = re.compile("[^\x00-ſ]|İ|<\\|")
_PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


class Vocabulary:
    """A tokenizer file and what follows from it; its content travels to the tasks, not its path."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            self.content = file.read()
        whole = [self.load().encode(text, add_special_tokens=False).ids for text in ("ab cd", "ab", "cd", "ab \n cd")]
        if whole[0] != whole[1] + whole[2] or whole[0] != whole[3]:
            raise ValueError("chunks are joined at blanks: the tokenizer must drop them")
        cased = "Stone The RIVER Éa ÑU Straße"
        if self.load().encode(cased, add_special_tokens=False).ids != self.load().encode(cased.lower(), add_special_tokens=False).ids:
            raise ValueError("words are looked up in lower case: the tokenizer must not tell cases apart")

    def load(self) -> Tokenizer:
        tokenizer = Tokenizer.from_str(self.content)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        return tokenizer


class Mapped(dict):
    """What a letter becomes before the merges, found by asking the tokenizer once."""

    def __init__(self, tokenizer: Tokenizer):
        super().__init__()
        self.tokenizer = tokenizer

    def __missing__(self, code: int) -> str:
        parts = self.tokenizer.pre_tokenizer.pre_tokenize_str(chr(code))
        self[code] = "".join(part for part, _ in parts)
        return self[code]


class Encoder:
    """Ids of texts by looking up their words; words not met before are encoded.

    A word of letters goes to the tokenizer's merges directly, all others
    through the whole tokenizer. The words met last are kept, in two halves of
    which the older one is forgotten when the younger is full.
    """

    def __init__(self, vocabulary: Vocabulary):
        self.tokenizer = vocabulary.load()
        self.model = self.tokenizer.model
        self.known: dict[str, bytes] = {"": b""}
        self.older: dict[str, bytes] = {}
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.tokens = [self.tokenizer.id_to_token(i) or "" for i in range(size)]
        self.plain = self.tokenizer.decoder is None
        self.mapped = Mapped(self.tokenizer)
        self.direct = all(self.letters(word) == self.whole(word) for word in ("a", "stone", "é", "straße", "überñandúœ"))

    def ids(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian 32-bit integers."""
        split, unusual = [], []
        for text in texts:
            if text.isascii() and "<|" not in text or not _UNUSUAL.search(text):
                split.append(text.lower().replace("\n", " ").split(" "))
            else:
                split.append(text.replace("\n", " ").split(" "))
                unusual.append(split[-1])
        if len(self.known) > KEPT_WORDS:
            self.older, self.known = self.known, {"": b""}
        plain = [words for words in split if not any(words is other for other in unusual)] if unusual else split
        for group, simple in ((unusual, False), (plain, True)):
            lacking = set().union(*group).difference(self.known)
            again = {word: self.older[word] for word in lacking if word in self.older}
            self.known.update(again)
            self.learn(lacking.difference(again), simple)
        return [b"".join(map(self.known.__getitem__, words)) for words in split]

    def learn(self, words: set[str], simple: bool) -> None:
        if not simple or not self.direct:
            self.add(list(words))
            return
        known, rest, parts = self.known, [], []
        for word in words:
            core = word.rstrip(_PUNCTUATION)
            if not core.isalpha():
                rest.append(word)
            elif core == word:
                known[word] = self.letters(word)
            else:
                parts.append((word, core, word[len(core) :]))
        self.add([*rest, *({end for _, _, end in parts} - known.keys())])
        for word, core, end in parts:
            if core not in known:
                known[core] = self.letters(core)
            known[word] = known[core] + known[end]

    def letters(self, word: str) -> bytes:
        """Ids of one lower-case word of letters."""
        form = word if word.isascii() else word.translate(self.mapped)
        return b"".join([token.id.to_bytes(4, "little") for token in self.model.tokenize(form)])

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def add(self, words: list[str]) -> None:
        if not words:
            return
        lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
        found = self.tokenizer.encode(" ".join(words), add_special_tokens=False)
        offsets = np.array(found.offsets, np.int64).reshape(-1, 2)
        owner = np.searchsorted(np.cumsum(lengths) - lengths, offsets[:, 0], "right") - 1
        ids = np.array(found.ids, "<u4").tobytes()
        ends = np.searchsorted(owner, np.arange(len(words)), "right") * 4
        start = 0
        for word, end in zip(words, ends.tolist()):
            self.known[word] = ids[start:end]
            start = end

    def text(self, ids: bytes) -> str:
        numbers = np.frombuffer(ids, "<u4").tolist()
        if self.plain:
            return " ".join(map(self.tokens.__getitem__, numbers))
        return self.tokenizer.decode(numbers, skip_special_tokens=False)


_ENCODERS: dict[int, Encoder] = {}


def encoder_of(vocabulary: Vocabulary) -> Encoder:
    """One encoder per Python worker, so that tasks after each other share known words."""
    key = hash(vocabulary.content)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(vocabulary)
    return _ENCODERS[key]


def cuts(texts: list[bytes]) -> list[list[int]]:
    """Where the chunks of each text begin and end: 0, the cuts, its length."""
    data, begins = joined(texts)
    rolled = GEAR[data]
    reach = 1
    while reach < WINDOW:
        rolled[reach:] += rolled[:-reach] << np.uint32(reach)
        reach *= 2
    # a cut follows its window and never parts the bytes of a character
    at = np.flatnonzero(rolled >> np.uint32(32 - CUT_BITS) == 0) + 1
    at = at[at < len(data)]
    at = at[(data[at] & 0xC0) != 0x80]
    found = []
    for begin, low, high, text in zip(begins.tolist(), *np.searchsorted(at, [begins, begins + [len(t) for t in texts]]).tolist(), texts):
        bounds = [0]
        for place in (at[low:high] - begin).tolist():
            if place - bounds[-1] >= LEAST_CHUNK and len(text) - place >= LEAST_CHUNK:
                bounds.append(place)
        found.append(bounds + [len(text)])
    return found


def blanks(text: bytes, start: int, end: int) -> tuple[int, int]:
    """First and last blank of ``text[start:end]``, where line feeds are blanks already; -1 without."""
    return text.find(b" ", start, end), text.rfind(b" ", start, end)


def squeezed(rows: DataFrame) -> DataFrame:
    """``rid``, ``rkey`` and the text compressed, for the shuffle: each text alone packs better than blocks of the exchange."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=1)
        for part in sliced(batches):
            made = [packer.compress(text.encode()) for text in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column("rid"), part.column("rkey"), pa.array(made, pa.binary())], names=["rid", "rkey", "packed"])

    return rows.mapInArrow(run, "rid long, rkey long, packed binary")


def unpacked(part: pa.RecordBatch) -> list[bytes]:
    """The UTF-8 texts of a batch of ``squeezed`` rows."""
    opener = zstandard.ZstdDecompressor()
    return [opener.decompress(packed) for packed in part.column("packed").to_pylist()]


def chunk_hashes(rows: DataFrame) -> DataFrame:
    """``rid``, ``rkey``, number and 16-byte hash of every chunk of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in sliced(batches):
            texts = [text.encode() for text in part.column("text").to_pylist()]
            bounds = cuts(texts)
            counts = np.array([len(each) - 1 for each in bounds])
            of = np.repeat(np.arange(len(texts)), counts)
            digests = [xxhash.xxh3_128_digest(text[a:b]) for text, each in zip(texts, bounds) for a, b in zip(each, each[1:])]
            number = np.arange(len(of)) - np.repeat(np.cumsum(counts) - counts, counts)
            yield pa.RecordBatch.from_arrays(
                [part.column("rid").take(pa.array(of)), part.column("rkey").take(pa.array(of)), pa.array(number, pa.int32()), pa.array(digests, pa.binary())],
                names=["rid", "rkey", "chunk", "digest"],
            )

    return rows.mapInArrow(run, "rid long, rkey long, chunk int, digest binary")


def encode_chunks(rows: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """``digest`` and ``ids`` between the outer blanks of the chunks listed in ``own``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(vocabulary)
        for part in sliced(batches, "packed", PACKED_BYTES):
            raw = unpacked(part)
            digests, parts = [], []
            for text, bounds, own in zip([text.replace(b"\n", b" ") for text in raw], cuts(raw), part.column("own").to_pylist()):
                for chunk in own:
                    first, last = blanks(text, bounds[chunk["chunk"]], bounds[chunk["chunk"] + 1])
                    if first < last:
                        digests.append(chunk["digest"])
                        parts.append(text[first:last].decode())
            yield pa.RecordBatch.from_arrays([pa.array(digests, pa.binary()), pa.array(encoder.ids(parts), pa.binary())], names=["digest", "ids"])

    return rows.mapInArrow(run, "digest binary, ids binary")


def encode(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``ids`` (little-endian 32-bit) and ``decoded`` text of every row.

    Whole texts are shuffled once, by row; only hashes of chunks and the ids of
    shared ones travel besides. A chunk that is in a third of all rows is
    counted with partial sums, and the join that hands out its ids is one that
    adaptive execution splits.
    """
    rows = keyed(docs).select("rid", "rkey", "text")
    chunks = chunk_hashes(rows)
    place = F.struct("rid", "rkey", "chunk")
    shared = (
        chunks.groupBy("digest").agg(F.count("*").alias("places"), F.min(place).alias("owner")).where("places > 1").drop("places")
    )
    own = (
        shared.select("owner.rid", "owner.rkey", F.struct("owner.chunk", "digest").alias("one"))
        .groupBy("rid", "rkey")
        .agg(F.collect_list("one").alias("own"))
    )
    # one exchange of the packed texts serves the owners and the whole texts: the inner join
    # asks for keys that are not null, so the outer one has to say the same
    packed = squeezed(rows).where(F.col("rid").isNotNull() & F.col("rkey").isNotNull())
    encoded = encode_chunks(packed.join(own, ["rid", "rkey"]).select("packed", "own"), vocabulary)
    given = (
        chunks.join(encoded, "digest")
        .groupBy("rid", "rkey")
        .agg(F.collect_set(F.struct("chunk", "ids")).alias("given"))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(vocabulary)
        for part in sliced(batches, "packed", PACKED_BYTES):
            stretches, laid = [], []
            for text, reused in zip(unpacked(part), part.column("given").to_pylist()):
                own, given = pieces(text, {one["chunk"]: one["ids"] for one in reused or ()})
                stretches += own
                laid.append(given)
            made = iter(encoder.ids(stretches))
            # each stretch is followed by a reused chunk, except a text's last
            found = [b"".join([part for ids in given for part in (next(made), ids)]) for given in laid]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("rid"),
                    pa.array([len(ids) // 4 for ids in found], pa.int64()),
                    pa.array(found, pa.binary()),
                    pa.array(map(encoder.text, found), pa.string()),
                ],
                names=["rid", "n_tokens", "ids", "decoded"],
            )

    whole = packed.join(given, ["rid", "rkey"], "left").select("rid", "packed", "given")
    encoded = whole.mapInArrow(run, "rid long, n_tokens long, ids binary, decoded string")
    return encoded.select(F.nullif("rid", F.lit(NO_ID)).alias("doc_id"), "n_tokens", "ids", "decoded")


def pieces(text: bytes, reused: dict[int, bytes]) -> tuple[list[str], list[bytes]]:
    """The stretches of a text to encode, and for each the ids that follow it, none for the last."""
    if not reused:
        return [text.decode()], [b""]
    flat = text.replace(b"\n", b" ")
    (bounds,) = cuts([text])
    stretches, given, at = [], [], 0
    for chunk in sorted(reused):
        first, last = blanks(flat, bounds[chunk], bounds[chunk + 1])
        stretches.append(flat[at:first].decode())
        given.append(reused[chunk])
        at = last
    return [*stretches, flat[at:].decode()], [*given, b""]
