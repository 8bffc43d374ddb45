"""Runs of repeating words against a plain reading of their definition."""

import hashlib
import zlib

import numpy as np
import pytest

from rasterloom.llm import periodic, queries


def plain_runs(words, least=periodic.MIN_LENGTH):
    """Every maximal stretch of each period, kept under its smallest period."""
    found, n = {}, len(words)
    for q in range(1, n // 2 + 1):
        at = 0
        while at + q < n:
            if words[at] != words[at + q]:
                at += 1
                continue
            end = at
            while end + q < n and words[end] == words[end + q]:
                end += 1
            if end + q - at >= max(least, 2 * q):
                found.setdefault((at, end + q), q)
            at = end
    return sorted((s, e - s, q) for (s, e), q in found.items())


def plain_collapse(words, runs):
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    return b" ".join(word for i, word in enumerate(words) if i not in gone)


def found_runs(texts, least=periodic.MIN_LENGTH):
    flat, counts = periodic.numbered(texts)
    got = periodic.find(flat, counts, least)
    runs = [[] for _ in texts]
    for row in zip(got.text.tolist(), got.start.tolist(), got.length.tolist(), got.period.tolist()):
        runs[row[0]].append(row[1:])
    return runs


def some_texts(rng, n):
    for _ in range(n):
        letters = [b"%d" % i for i in range(rng.integers(1, 4))]
        words = [letters[i] for i in rng.integers(0, len(letters), rng.integers(0, 80))]
        for _ in range(rng.integers(0, 3)):
            unit = [letters[i] for i in rng.integers(0, len(letters), rng.integers(1, 12))]
            at = int(rng.integers(0, len(words) + 1))
            words[at:at] = (unit * 8)[: int(rng.integers(1, 8 * len(unit) + 1))]
        yield words


@pytest.mark.parametrize("least, pairs", [(12, 1 << 20), (12, 50), (1, 1 << 20), (5, 200)])
def test_runs_equal_a_plain_search(monkeypatch, least, pairs):
    monkeypatch.setattr(periodic, "PAIRS", pairs)
    texts = list(some_texts(np.random.default_rng(1), 300))
    texts += [[], [b"a"], [b"a"] * 11, [b"a"] * 12, [b"a"] * 400, [b"a", b"b"] * 200, [b"a", b"b", b"a"] * 90 + [b"c"], [b"%d" % i for i in range(500)]]
    assert found_runs(texts, least) == [plain_runs(words, least) for words in texts]


def test_grammar_agrees_word_by_word():
    rng = np.random.default_rng(2)
    texts = [t for t in some_texts(rng, 60) if t] + [[b"a"] * 100, [b"x", b"y"] * 64]
    words, counts = periodic.numbered(texts)
    begins = np.cumsum(counts) - counts
    grammar = periodic.Grammar(words, begins)
    text = rng.integers(0, len(texts), 3000)
    low = begins[text] + rng.integers(0, counts[text])
    high = low + rng.integers(0, begins[text] + counts[text] - low)
    ahead, back = grammar.agree(low, high, begins[text] + counts[text]), grammar.agree(low, high, begins[text], back=True)
    for t, a, b, forward, backward in zip(text, low, high, ahead, back):
        n = 0
        while b + n < begins[t] + counts[t] and words[a + n] == words[b + n]:
            n += 1
        m = 0
        while a - m > begins[t] and words[a - m - 1] == words[b - m - 1]:
            m += 1
        assert (n, m) == (forward, backward)


def expected_row(doc_id, text):
    words = (text or "").encode().split()
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and words:
        g, n = h // 10, len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    best = min(runs, key=lambda run: (-run[1], run[0], run[2])) if runs else None
    digest = lambda raw: hashlib.sha256(raw).hexdigest()
    return (
        doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
        digest("".join(f"{s},{length},{q}\n" for s, length, q in runs).encode()), digest(plain_collapse(words, runs)),
    )


@pytest.mark.parametrize("place", ["/root/testdata/sf0.001", "odd", "bare"])
def test_query_equals_a_plain_reading(spark, place, request):
    place = place if place.startswith("/") else request.getfixturevalue(place)
    docs = spark.read.parquet(f"{place}/documents.parquet").select("doc_id", "text").collect()
    found = queries.op13_periodic_runs(spark, place)
    assert found.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    short = [row for row in docs if len(row["text"] or "") < 60_000]
    order = lambda row: (str(row[0]), row[-1], row[1])
    expected = sorted((expected_row(row["doc_id"], row["text"]) for row in short), key=order)
    got = sorted((tuple(row) for row in found.collect()), key=order)
    assert len(got) == len(docs)
    assert [row for row in got if row in set(expected)] == expected
    assert len(got) - len(expected) <= len(docs) - len(short)
