"""Repeated byte strings against a plain reading, and each part against a plain version."""

import hashlib

import numpy as np
import pyarrow as pa
import pytest

from rasterloom.llm import queries, substrings
from rasterloom.llm.texts import NO_ID


def plain_gone(texts):
    """For each text, in order, whether each byte goes."""
    seen, masks = set(), []
    for text in texts:
        gone = np.zeros(len(text), bool)
        for at in range(len(text) - substrings.LENGTH + 1):
            window = text[at : at + substrings.LENGTH]
            if window in seen:
                gone[at : at + substrings.LENGTH] = True
            seen.add(window)
        masks.append(gone)
    return masks


def plain_row(doc_id, text, gone):
    kept = np.frombuffer(text, np.uint8)[~gone].tobytes()
    return doc_id, len(text), int(gone.sum()), int((np.diff(gone.astype(int), prepend=0) == 1).sum()), hashlib.sha256(kept).hexdigest()


def order_suffixes(s):
    return sorted(range(len(s)), key=lambda i: s[i:])


@pytest.mark.parametrize("letters", [1, 2, 3, 20])
def test_suffix_arrays_and_common_prefixes(letters):
    rng = np.random.default_rng(letters)
    for n in [0, 1, 2, 3, 7, *rng.integers(4, 300, 120)]:
        s = [*rng.integers(1, letters + 1, n).tolist(), 0]
        if n > 40:
            s[20:30] = s[5:15]
        order = substrings.suffix_array(np.array(s, np.int64), letters + 1)
        assert order.tolist() == order_suffixes(s)
        shared = substrings.common_prefixes(np.array(s, np.int64), order)
        for a, b in zip(order, order[1:]):
            k = 0
            while s[a + k] == s[b + k]:
                k += 1
            assert shared[b] == k


def test_suffix_array_of_a_long_periodic_text():
    s = np.append(np.tile(np.array([3, 1, 2, 1, 2]), 400), 0)
    assert substrings.suffix_array(s, 4).tolist() == order_suffixes(s.tolist())


def some_texts(rng, n):
    passages = [rng.integers(97, 123, rng.integers(80, 300)).astype(np.uint8).tobytes() for _ in range(6)]
    for _ in range(n):
        text = b"".join(passages[rng.integers(6)][rng.integers(0, 30) :] if rng.random() < 0.4 else rng.integers(97, 123, rng.integers(0, 150)).astype(np.uint8).tobytes() for _ in range(rng.integers(0, 6)))
        yield text.decode()


@pytest.mark.parametrize("limit", [1 << 20, 130])
def test_equal_windows_have_one_anchor(limit):
    rng = np.random.default_rng(4)
    texts = [text.encode() for text in some_texts(rng, 60)] + [b"x" * 300, b"ab" * 200, b"", b"y" * 99, b"z" * 100]
    keys, met, digests, digests_of = {}, 0, {}, {}
    for stretches in substrings.parts(texts, limit):
        for number, at, n, lead, key, digest in zip(*(column.tolist() for column in substrings.segments(stretches))):
            assert 0 <= lead <= substrings.REACH and 1 <= n <= 64
            segment = texts[number][at : at + n + substrings.LENGTH - 1]
            assert digests.setdefault(digest, segment) == segment and digests_of.setdefault(segment, digest) == digest
            for j in range(n):
                window = texts[number][at + j : at + j + substrings.LENGTH]
                assert len(window) == substrings.LENGTH
                assert keys.setdefault(window, (key, lead - j)) == (key, lead - j)
                met += 1
    assert met == sum(max(0, len(text) - substrings.LENGTH + 1) for text in texts)


def test_runs_of_many_texts_equal_those_of_each():
    rng = np.random.default_rng(12)
    places, firsts, bits, expected = [], [], [], []
    for _ in range(50):
        own, at, gone = [], 0, []
        for _ in range(rng.integers(0, 6)):
            at += int(rng.choice([0, 0, 1, 99, 100, 101, 300]))
            n = int(rng.integers(1, 65))
            first = rng.random(n) < rng.choice([0, 0.5, 1])
            own.append((at << 16 | n << 8 | 5, at, sum(1 << i for i in np.flatnonzero(first).tolist()), first))
            gone += [at + i for i in range(n) if not first[i]]
            at += n
        rng.shuffle(own)
        places.append([o[0] for o in own])
        some = [o for o in own if o[2]]
        firsts.append([o[1] for o in some] if some else None)
        bits.append([o[2] - (1 << 64) if o[2] >> 63 else o[2] for o in some] if some else None)
        mask = np.zeros(at + 200, bool)
        for i in gone:
            mask[i : i + substrings.LENGTH] = True
        edges = np.diff(mask.astype(int), prepend=0, append=0)
        expected.append((np.flatnonzero(edges == 1).tolist(), np.flatnonzero(edges == -1).tolist()))
    kind = pa.list_(pa.int64())
    starts, ends = substrings.repeated_runs(*(substrings.ragged(pa.array(column, kind)) for column in (places, firsts, bits)))
    assert list(zip(starts.to_pylist(), ends.to_pylist())) == expected
    empty = [substrings.ragged(pa.array([], kind))] * 3
    assert [len(each) for each in substrings.repeated_runs(*empty)] == [0, 0]


@pytest.mark.parametrize("crowd", [1, 3, substrings.CROWD])
def test_rows_equal_a_plain_reading(spark, crowd):
    rng = np.random.default_rng(9)
    # one passage in many contexts, which crowds its anchors
    passage = "".join(chr(97 + i) for i in rng.integers(0, 26, 70))
    texts = list(some_texts(rng, 60)) + [f"{i:050d}{passage}{i % 7:050d}" for i in range(60)] + ["x" * 400, "ab" * 150 + "x" * 200, "é" * 120, "", None, "é" * 90 + "end"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    raw = [(text or "").encode() for text in texts]
    expected = [plain_row(i, text, gone) for i, (text, gone) in enumerate(zip(raw, plain_gone(raw)))]
    got = substrings.dedup_substrings(docs, crowd).collect()
    rows = []
    for row in got:
        gone = np.zeros(row["n_bytes"], bool)
        for a, b in zip(row["starts"], row["ends"]):
            gone[a:b] = True
        rows.append(plain_row(row["doc_id"], raw[row["doc_id"]], gone))
        assert hashlib.sha256(row["kept"]).hexdigest() == rows[-1][-1]
    assert sorted(rows) == expected


@pytest.mark.parametrize("place", ["/root/testdata/sf0.001", "odd", "bare"])
def test_query_equals_a_plain_reading(spark, place, request):
    place = place if place.startswith("/") else request.getfixturevalue(place)
    docs = spark.read.parquet(f"{place}/documents.parquet")
    found = queries.op11_substrings(spark, place)
    assert found.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    named = substrings.named_rows(docs).collect()
    # rows of one id and text are one text
    texts = sorted({(row["rid"], row["rkey"], row["text"]) for row in named})
    masks = dict(zip(texts, plain_gone([text.encode() for _, _, text in texts])))
    expected = [plain_row(None if row["rid"] == NO_ID else row["rid"], row["text"].encode(), masks[row["rid"], row["rkey"], row["text"]]) for row in named]
    assert sorted(map(tuple, found.collect()), key=str) == sorted(expected, key=str)
