"""Every operator's query against a brute-force version, over a small table and over odd rows."""

import collections
import hashlib
import html
import re

import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from rasterloom.llm import decontaminate, queries

TABLES = ("sf", "odd", "bare")


@pytest.fixture(params=TABLES)
def place(request):
    return request.getfixturevalue(request.param)


def documents(spark, place):
    return [(row["doc_id"], row["text"] or "") for row in spark.read.parquet(f"{place}/documents.parquet").select("doc_id", "text").collect()]


def rows_of(df, *names):
    return collections.Counter(tuple(row[name] for name in names) for row in df.collect())


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def jaccard(one, other, words=5):
    """Likeness of the sets of shingles, and three standard errors of an estimate from as many of them or 512 bins."""

    def shingles(text):
        found = text.encode().lower().split()
        return {tuple(found[i : i + words]) for i in range(max(1, len(found) - words + 1))} if found else set()

    a, b = shingles(one), shingles(other)
    size = len(a | b)
    return (len(a & b) / size, 1.5 / min(512, size) ** 0.5 + 0.02) if size else (1.0, 0.0)


def test_op1(spark, place):
    docs = sorted(documents(spark, place), key=lambda d: (d[0] is not None, d[0] or 0, d[1].encode()))
    found = queries.op1_fingerprints(spark, place)
    expected, likeness = collections.Counter(), collections.defaultdict(list)
    for (doc_id, text), (_, after) in zip(docs, docs[1:] + docs[:1]):
        quarter = len(text) // 4
        changed = text[: len(text) - quarter] + after[:quarter]
        expected[doc_id, len(text), sha(changed)] += 1
        likeness[doc_id, sha(changed)].append((jaccard(text, changed), jaccard(text, after)))
    assert rows_of(found, "doc_id", "n_chars", "edited_sha256") == expected
    for row in found.collect():
        assert 0 <= row["near_edited"] <= 1 and 0 <= row["near_next"] <= 1
        pairs = likeness[row["doc_id"], row["edited_sha256"]]
        assert any(abs(a[0] - row["near_edited"]) <= a[1] and abs(b[0] - row["near_next"]) <= b[1] for a, b in pairs)
    of = {(d, t): None for d, t in docs}
    by_id = collections.defaultdict(set)
    for row in found.collect():
        by_id[row["doc_id"]].add(row["fingerprint"])
    prints = collections.defaultdict(set)
    for doc_id, text in of:
        if len(by_id[doc_id]) == 1:
            prints[text] |= by_id[doc_id]
    assert all(len(each) == 1 for each in prints.values())


def secret_spans(text):
    rules = [
        ("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
        ("access", r"AKIA[A-Z0-9]+", 0, 20),
        ("hex", r"[0-9a-f]+", 0, 24),
        ("github", r"gh[pousr]_[A-Za-z0-9]{36,}", 0, 40),
        ("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1),
    ]
    spans = [(m.start(), k, m.end()) for k, (_, p, g, least) in enumerate(rules) for m in re.finditer(p, text, re.A) if len(m[g]) >= least]
    return [(k, f"{rules[k][0]}:{a}:{b}") for a, k, b in sorted(spans)]


def test_op3(spark, place):
    expected = collections.Counter()
    for doc_id, text in documents(spark, place):
        spans = secret_spans(text)
        counts = [sum(k == i for k, _ in spans) for i in range(3)]
        expected[(doc_id, *counts, sha(",".join(s for k, s in spans if k < 3)), ",".join(s for _, s in spans))] += 1
    assert rows_of(queries.op3_secrets(spark, place), "doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans") == expected


def test_op4(spark, place):
    docs = documents(spark, place)
    holders = collections.defaultdict(set)

    def key(line):
        key = line.strip(" \t\n\v\f\r").encode().lower().decode()
        return key if len(key) >= 40 else None

    order = lambda i: -1 if i is None else i
    for doc_id, text in docs:
        for line in text.split("\n"):
            if key(line):
                holders[key(line)].add(order(doc_id))
    expected = collections.Counter()
    for doc_id, text in docs:
        lines = text.split("\n")
        kept = [x for x in lines if not (key(x) and len(holders[key(x)]) >= 5 and order(doc_id) != max(holders[key(x)]))]
        expected[doc_id, len(lines), len(lines) - len(kept), sha("\n".join(kept))] += 1
    assert rows_of(queries.op4_line_dedup(spark, place), "doc_id", "n_lines", "n_dropped", "kept_sha256") == expected


def semi_global(item, text):
    """Least edit distance of the item to any part of the text, by the plain table."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        last, row = row, [i]
        for j, b in enumerate(text, 1):
            row.append(min(last[j - 1] + (a != b), last[j] + 1, row[j - 1] + 1))
    return min(row)


def test_op5(spark, place):
    items = [(row[0], decontaminate.normal_form(row[1] or "")) for row in spark.read.parquet(f"{place}/benchmark.parquet").select("item_id", "text").collect()]
    found = rows_of(queries.op5_decontamination(spark, place), "doc_id", "item_id", "distance")
    for doc_id, text in documents(spark, place):
        text = decontaminate.normal_form(text)
        for item_id, item in set(items):
            if item and item in text:
                assert found[doc_id, item_id, 0]
    assert all(distance <= decontaminate.ERROR_RATE * max(len(t) for i, t in items if i == item_id) for _, item_id, distance in found)


def test_edit_matches_are_those_of_the_plain_table():
    import random

    rng = random.Random(5)
    words = ["stone", "river", "the", "of", "light", "under", "and", "seven", "mill"]
    items = [(i, " ".join(rng.choices(words, k=rng.randint(2, 14)))) for i in range(25)]
    matcher = decontaminate.Matcher(items, 0.1)
    for _ in range(120):
        item = list(rng.choice(items)[1])
        for _ in range(rng.randint(0, 6)):
            at = rng.randrange(len(item))
            item[at : at + rng.randint(0, 1)] = rng.choice(["", "q", "e"])
        text = " ".join(rng.choices(words, k=8)) + " " + "".join(item) + " " + " ".join(rng.choices(words, k=8))
        text = decontaminate.normal_form(text)
        found = {i: d for i, d, _, _ in matcher.matches(text)}
        expected = {i: d for i, t in items if (d := semi_global(t, text)) <= int(0.1 * len(t))}
        assert found == expected


def test_op6(spark, place):
    tokenizer = Tokenizer.from_file(queries.vocabulary_path())
    tokenizer.no_truncation()
    tokenizer.no_padding()
    expected = collections.Counter()
    for doc_id, text in documents(spark, place):
        ids = tokenizer.encode(text, add_special_tokens=False).ids
        raw = b"".join(i.to_bytes(4, "little") for i in ids)
        expected[doc_id, len(ids), hashlib.sha256(raw).hexdigest(), sha(tokenizer.decode(ids, skip_special_tokens=False))] += 1
    assert rows_of(queries.op6_bpe(spark, place), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == expected


def simhash(text, words=3):
    found = text.encode().lower().split()
    n = min(words, len(found))
    hashes = [xxhash.xxh64_intdigest(b" ".join(found[i : i + n]), 42) for i in range(len(found) - n + 1)] if found else []
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def linked(prints, most):
    """Root of every fingerprint by brute force."""
    root = {p: p for p in prints}

    def top(p):
        while root[p] != p:
            p = root[p]
        return p

    each = sorted(prints)
    for i, a in enumerate(each):
        for b in each[:i]:
            if (a ^ b).bit_count() <= most:
                root[max(top(a), top(b))] = min(top(a), top(b))
    return {p: top(p) for p in each}


def test_op9(spark, place):
    docs = [(doc_id, simhash(text)) for doc_id, text in documents(spark, place)]
    roots = linked({p for _, p in docs}, 2)
    first = {}
    for doc_id, p in docs:
        if doc_id is not None:
            first[roots[p]] = min(doc_id, first.get(roots[p], doc_id))
    expected = collections.Counter((doc_id, f"{p:016x}", first.get(roots[p])) for doc_id, p in docs)
    assert rows_of(queries.op9_simhash(spark, place), "doc_id", "fingerprint", "component_id") == expected


@pytest.mark.parametrize("name, remainder, divisor", [("op2_quality", 1, 3), ("op7_toxicity", 0, 5), ("op10_language", 1, 3)])
def test_scores_of_all_rows(spark, place, name, remainder, divisor):
    found = queries.QUERIES[name](spark, place)
    ids = collections.Counter(doc_id for doc_id, _ in documents(spark, place))
    assert collections.Counter(row["doc_id"] for row in found.collect()) == ids
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary")) % divisor
    assert found.where((F.coalesce(crc, F.lit(-1)) == remainder) != F.col("held_out")).count() == 0
    assert found.where("score is null or score < 0 or score > 1 or isnan(score)").count() == 0
    if "predicted" in found.columns:
        assert found.where("predicted <> int(score >= 0.5)").count() == 0


def test_language_of_texts_without_letters(spark, odd):
    texts = dict(documents(spark, odd))
    for row in queries.op10_language(spark, odd).collect():
        if row["doc_id"] is not None and row["doc_id"] != 3:
            assert (row["lang_pred"] == "und") == (not any(c.isalpha() for c in texts[row["doc_id"]]))


def test_op8(spark, place):
    found = queries.op8_warc(spark, place).collect()
    pages = spark.read.parquet(f"{place}/pages.parquet").collect()
    assert len(found) == 2 * len(pages)
    by_id = {row["record_id"]: row for row in found}
    for row in found:
        assert by_id[row["concurrent_to"]]["refers_to"] == row["refers_to"]
        assert row["content_length"] == len(row["block"].encode())
    read = collections.Counter()
    for page in pages:
        # an independent reading: tags as blanks, entities as they are, compared without blanks
        text = re.sub(r"<!--.*?(-->|\Z)|<(script|style)\b.*?</\2>|<[^>]*>", " ", page["html"] or "", flags=re.S)
        read[page["page_id"], page["url"] or "", "".join(html.unescape(text).split())] += 1
    assert read == collections.Counter((row["page_id"], row["target_uri"], "".join(row["block"].split())) for row in found if row["warc_type"] == "conversion")
