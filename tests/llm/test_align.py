"""Alignment against the libraries themselves, whole text by whole text, in plain loops."""

import hashlib
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from rasterloom.llm import align, queries

A, B = queries.vocabulary_path("byte_bpe_50k.json"), queries.vocabulary_path("piece_bpe_32k.model")
PAIR = align.Pair(A, B)
LOADED = PAIR.load()


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


def plain_tokens(text, libraries):
    """Ids and byte ranges of both tokenizers over the whole text; nothing where the bytes do not come back."""
    a, b = libraries
    if not text:
        return [], []
    whole = " " + text
    raw = whole.encode()
    x, y = a.encode(whole, add_special_tokens=False), b.encode(text)
    sign = align.byte_of_sign()
    sizes = []
    for ids, piece in ((x.ids, lambda i: bytes(sign[c] for c in a.id_to_token(i))), (y, lambda i: bytes([b.id_to_piece(i)[3:5] and int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode())):
        parts = [piece(i) for i in ids]
        if b"".join(parts) != raw:
            return [], []
        ends = np.cumsum([len(part) for part in parts]).tolist()
        sizes.append(list(zip(ids, [0, *ends], ends)))
    return sizes


def plain_groups(a, b):
    shared = {end for _, _, end in a} & {end for _, _, end in b}
    cut = []
    for side in (a, b):
        groups = [[]]
        for i, _, end in side:
            groups[-1].append(str(i))
            if end in shared:
                groups.append([])
        cut.append([",".join(group) for group in groups if group])
    return ["|".join(group) for group in zip(*cut, strict=True)]


def plain_links(a, b):
    links, first = [], 0
    for i, s, e in a:
        while first < len(b) and b[first][2] <= s:
            first += 1
        k = first
        while k < len(b) and b[k][1] < e:
            links.append((i, b[k][0]))
            k += 1
    return links


def expected_rows(rows, libraries):
    sides = [plain_tokens(text, libraries) for _, text in rows]
    links = [plain_links(*each) for each in sides]
    counts = Counter(link for each in links for link in each)
    top = {}
    for (_, b), n in counts.items():
        top[b] = max(top.get(b, 0), n)
    for (doc_id, _), (a, b), own in zip(rows, sides, links):
        groups = plain_groups(a, b)
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""
        yield doc_id, len(a), len(b), len(groups), len(own), sum(counts[x] == top[x[1]] for x in own), sum(counts[x] for x in own), digest


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
ODD = [
    " lead", "trail ", "two  blanks", "tab\tand\nline  \n\n x", "a b   c", "<|endoftext|> <s> </s> <unk> <0x41>", "▁mark ▁", "x▁y z", "don't I'll 's",
    "\x1c \x1d a \x85 b", "日本 語 テスト", "é é ﬁ Å ① …", "​ ﻿ a", "😀 😀😀 x", "\x00 a\x00b", "naïve — “quote” 1234567 ½", " ", "  ", "\n",
]


def some_texts(n):
    rng = np.random.default_rng(7)
    signs = [*" " * 8, *"aebtns'.,1 \n\t", "é", "ß", "日", "😀", " ", "▁", "́", "A", "Z", "  ", "the ", "ing", "<0x0A>"]
    return ["".join(rng.choice(signs, rng.integers(1, 60))) for _ in range(n)]


def test_units_are_tokenized_as_whole_texts(libraries):
    for text in [*ODD, *some_texts(1500)]:
        made = align.align(align.units(text), LOADED)
        a, b = plain_tokens(text, libraries)
        if not made.right.all():
            assert not a
            continue
        assert ";".join(made.groups) == ";".join(plain_groups(a, b))
        assert [(i & (1 << align.SHIFT) - 1, i >> align.SHIFT) for i in made.links.tolist()] == plain_links(a, b)
        assert (made.n_a.sum(), made.n_b.sum()) == (len(a), len(b))


@pytest.mark.parametrize("place", ["/root/testdata/sf0.001", "odd", "bare"])
def test_query_equals_the_libraries(spark, libraries, place, request):
    place = place if place.startswith("/") else request.getfixturevalue(place)
    rows = [(row["doc_id"], row["text"]) for row in spark.read.parquet(f"{place}/documents.parquet").select("doc_id", "text").collect()]
    found = queries.op12_alignment(spark, place)
    assert found.columns == COLUMNS
    assert sorted(map(tuple, found.collect()), key=str) == sorted(expected_rows(rows, libraries), key=str)


def test_small_chunks_count_the_whole_corpus(spark, libraries, monkeypatch):
    monkeypatch.setattr(align, "CHUNK_BYTES", 500)
    monkeypatch.setattr(align, "KEPT_BYTES", 2_000)
    rows = list(enumerate([*ODD, *some_texts(100), None, "", ODD[0]]))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    # workers fork with the patched module only where they load it anew, so the packing runs here
    import pyarrow as pa

    held, kept = [], align.Kept(LOADED)
    for at in range(0, len(rows), 7):
        chunk = align.Chunk(kept, [], [], [])
        chunk.add([i for i, _ in rows[at : at + 7]], [text or "" for _, text in rows[at : at + 7]])
        held.append(align.packed_chunk(at, chunk))
        if kept.size > align.KEPT_BYTES:
            kept.clear()
    table = spark.createDataFrame(pa.Table.from_batches(held).select(["chunk", "pairs", "times"]))
    pairs = align.pair_rows(table.select("chunk", "pairs", "times"))
    counted = align.pair_counts(pairs)
    expected = list(expected_rows(rows, libraries))
    assert counted.agg(F.sum("total")).first()[0] == sum(row[4] for row in expected)
    by_pair = {row["pair"]: row for row in counted.collect()}
    got = []
    for batch in held:
        codes = align.widened(batch.column("pairs")[0].as_py(), "<i8").tolist()
        found = pa.table({"pair": codes, "total": [by_pair[c]["total"] for c in codes], "best": pa.array([by_pair[c]["best"] for c in codes], pa.bool_())})
        got += [tuple(row[name] for name in COLUMNS) for row in align.with_counts(pa.Table.from_batches([batch]), found).to_pylist()]
    assert got == expected
    assert sorted(map(tuple, align.aligned(docs, PAIR).collect()), key=str) == sorted(expected, key=str)


def test_groups_as_text(spark, libraries):
    docs = spark.createDataFrame([(1, "One two"), (2, None), (3, "x▁y")], "doc_id long, text string")
    expected = ";".join(plain_groups(*plain_tokens("One two", libraries)))
    assert {row["doc_id"]: row["groups"] for row in align.groups_of(docs, PAIR).collect()} == {1: expected, 2: "", 3: ""}


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError):
        align.Pair(queries.vocabulary_path("word_bpe_49k.json"), B)
