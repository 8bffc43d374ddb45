"""Parts of the operators on cases made for them."""

import base64
import hashlib
import json
import random
from dataclasses import replace
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from rasterloom.llm import bpe, decontaminate, fingerprints, lines, quality, queries, secrets, simhash, texts, toxicity, warc
from rasterloom.llm import texts as texts_module
from tests.llm.test_contracts import linked


def frame(spark, rows, schema="doc_id long, text string"):
    return spark.createDataFrame(rows, schema)


def test_ledger_scans_only_what_it_lacks(spark):
    history = frame(spark, [(1, "token=abcdefg"), (2, "token=abcdefg"), (3, "0a" * 15)])
    first = secrets.update_ledger(history, rules=secrets.BASE[:1])
    held = spark.createDataFrame(first.collect(), secrets.LEDGER)
    assert held.count() == 2
    assert secrets.update_ledger(history, held, secrets.BASE[:1]).count() == 0
    newer = secrets.update_ledger(history.union(frame(spark, [(4, "x")])), held, secrets.BASE)
    rows = {len(row["rules"]): row for row in newer.collect()}
    assert newer.count() == 3 and set(rows) == {2, 3}
    found = {row["doc_id"]: row["spans"] for row in secrets.findings(history, held.union(newer)).collect()}
    assert [tuple(s) for s in found[1]] == [(0, 0, 13)] == [tuple(s) for s in found[2]]
    assert [tuple(s) for s in found[3]] == [(0, 2, 30)]


def test_an_upgraded_rule_replaces_its_spans(spark):
    """Spans of old versions, of rules that are gone and of ledger rows held twice do not show; rules may change places."""
    history = frame(spark, [(1, "token=abcdefg"), (2, "token=abcdefg AKIA" + "A" * 20), (3, None)])
    old = secrets.BASE
    wider = replace(old[0], version=2)
    narrower = replace(old[0], version=3, least=50)
    ledger = spark.createDataFrame(secrets.update_ledger(history, rules=old).collect(), secrets.LEDGER)
    for rules in ((wider, *old[1:]), (old[1], wider), (narrower, old[1])):
        more = secrets.update_ledger(history, ledger, rules).collect()
        ledger = ledger.union(spark.createDataFrame(more, secrets.LEDGER)) if more else ledger
        fresh = secrets.update_ledger(history, rules=rules)
        for held in (ledger, ledger.union(ledger)):
            assert sorted(map(str, secrets.findings(history, held, rules).collect())) == sorted(map(str, secrets.findings(history, fresh, rules).collect()))
    assert [len(row["spans"]) for row in secrets.findings(history, ledger, (wider, old[1])).orderBy("doc_id").collect()] == [1, 2, 0]
    assert [len(row["spans"]) for row in secrets.findings(history, ledger, (narrower,)).orderBy("doc_id").collect()] == [0, 0, 0]


def test_a_key_across_many_ranges(spark):
    line = "a line that nearly all documents hold, word for word, today"
    docs = frame(spark, [(i, f"{line}\n{i}\n{line}") for i in range(3000)] + [(i, f"rare line number {i} with some more words in it\nz") for i in range(4)])
    got = {row["id"]: row for row in lines.dedup_lines(docs).select(F.col("row.doc_id").alias("id"), "n_dropped", "kept").where("n_lines = 3").collect()}
    assert got[2999]["n_dropped"] == 0
    assert all(got[i]["n_dropped"] == 2 and got[i]["kept"] == str(i) for i in range(2999))


@pytest.mark.parametrize("docs", [4, 5])
def test_a_line_needs_enough_documents(spark, docs):
    line = "x" * 40
    got = lines.dedup_lines(frame(spark, [(i, line) for i in range(docs)])).where("n_dropped > 0").count()
    assert got == (0 if docs < 5 else 4)


def test_links_through_crowded_segments(spark):
    rng = random.Random(3)
    base = rng.getrandbits(64)
    near = {base ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for _ in range(300)}
    prints = near | {rng.getrandbits(64) for _ in range(200)} | {base}
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    roots = linked(prints, 2)
    for bucket in (2, 64, 10_000):
        found = simhash.components(simhash.class_links(spark.createDataFrame(signed, "fp long"), bucket)).collect()
        groups = {}
        for row in found:
            groups.setdefault(row["root"], set()).add(row["node"] % (1 << 64))
        expected = {}
        for p, root in roots.items():
            expected.setdefault(root, set()).add(p)
        assert sorted(map(sorted, groups.values())) == sorted(sorted(g) for g in expected.values() if len(g) > 1)


def test_chains_prune_no_near_pair():
    rng = np.random.default_rng(1)
    counts = rng.multinomial(simhash.ALIKE_BITS, np.ones(8) / 8, size=2000)
    assert simhash.ring_survivors(counts, simhash.ALIKE_BITS).all()
    assert not simhash.ring_survivors(np.full((1, 8), 4), simhash.ALIKE_BITS).any()


def test_one_of_each_group(spark):
    rng = random.Random(7)
    words = ["w%d" % i for i in range(5000)]
    rows, number = [], 0
    for group in range(30):
        base = rng.choices(words, k=300)
        for copy in range(6):
            changed = list(base)
            for at in rng.sample(range(300), 2 if copy else 0):
                changed[at] = "changed%d" % number
            rows.append((number, " ".join(changed), "x"))
            number += 1
    rows += [(1000 + i, " ".join(rng.choices(words, k=50)), None) for i in range(40)] + [(rows[0][0], rows[0][1], "again")]
    docs = frame(spark, rows, "doc_id long, text string, fp string")
    for block in (2, 4096):
        got = simhash.one_of_each(docs, block)
        assert got.columns == docs.columns
        assert sorted(row["doc_id"] for row in got.collect()) == [6 * i for i in range(30)] + [1000 + i for i in range(40)]


def test_chunks_give_the_same_ids_as_whole_texts(spark):
    rng = random.Random(2)
    syllables = ["an", "the", "re", "st", "ü", "\n", " ", " ", " ", "'s", ",", "7", "É"]
    passages = ["".join(rng.choices(syllables, k=900)) for _ in range(6)]
    rows = [(i, "".join(rng.choices(syllables, k=50)).join(rng.choices(passages, k=4))) for i in range(40)]
    vocabulary = bpe.Vocabulary(queries.vocabulary_path())
    library = vocabulary.load()
    docs = frame(spark, rows)
    hashes = bpe.chunk_hashes(texts.keyed(docs).select("rid", "rkey", "text"))
    assert hashes.groupBy("digest").count().where("count > 1").count() > 10
    for row in bpe.encode(docs, vocabulary).collect():
        ids = library.encode(dict(rows)[row["doc_id"]], add_special_tokens=False).ids
        assert np.frombuffer(row["ids"], "<u4").tolist() == ids
        assert row["decoded"] == library.decode(ids, skip_special_tokens=False)


def test_words_known_before_are_forgotten_safely(monkeypatch):
    monkeypatch.setattr(bpe, "KEPT_WORDS", 5)
    vocabulary = bpe.Vocabulary(queries.vocabulary_path())
    encoder, library = bpe.Encoder(vocabulary), vocabulary.load()
    assert encoder.direct
    for text in ["one two, three four!", "five six seven", "One TWO eight's nine ten", "two five"]:
        assert np.frombuffer(encoder.ids([text])[0], "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_a_tokenizer_that_keeps_blanks_is_refused():
    import public_tokenizers

    with pytest.raises(ValueError):
        bpe.Vocabulary(public_tokenizers.path("byte_bpe_50k.json"))


def test_likeness_is_close_to_jaccard():
    rng = random.Random(1)
    sketch = fingerprints.Sketch()
    base = [f"w{rng.randrange(10**6)}" for _ in range(1000)]
    for changed in (0, 5, 20, 60, 300):
        other = list(base)
        for at in rng.sample(range(1000), changed):
            other[at] = f"v{at}"
        a, b = ({tuple(t[i : i + 5]) for i in range(996)} for t in (base, other))
        low, worded = sketch.low_bits([" ".join(base), " ".join(other)])
        like = sketch.likeness(low[:1], low[1:], worded[:1], worded[1:])[0]
        assert abs(like - len(a & b) / len(a | b)) < 0.1


def test_slices_hold_all_rows():
    batch = pa.RecordBatch.from_pydict({"text": ["a" * n for n in (5, 0, 50, 3, 3, 200, 1)]})
    parts = list(texts.sliced(iter([batch]), limit=20))
    assert [t for part in parts for t in part.column("text").to_pylist()] == batch.column("text").to_pylist()
    assert len(parts) > 3


def test_equal_words_hash_alike_anywhere():
    hashes, owner = texts.word_hashes(["one Two one", "", "two"])
    assert hashes[0] == hashes[2] and hashes[1] == hashes[3] and hashes[0] != hashes[1]
    assert owner.tolist() == [0, 0, 0, 2]
    assert len(texts.shingle_hashes(["a b c d e f", "a b", ""], 5)[0]) == 3


def test_toxic_words_raise_scores(spark, sf):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    marks = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    found = queries.op7_toxicity(spark, "/root/testdata/sf0.01").join(marks, "doc_id")
    by = {row["toxic"]: row["s"] for row in found.groupBy("toxic").agg(F.avg("score").alias("s")).collect()}
    assert by[1] > by[0] + 0.3
    shuffled = docs.withColumn("lang", F.lit("xx")).withColumn("source", F.lit("yy"))
    net = toxicity.fit(docs, marks.select("doc_id", F.col("toxic").alias("label")), F.col("doc_id") > 50)
    again = toxicity.fit(shuffled, marks.select("doc_id", F.col("toxic").alias("label")), F.col("doc_id") > 50)
    assert np.allclose(net.embedding, again.embedding) and np.allclose(net.thresholds, again.thresholds)


@pytest.mark.parametrize("name, divisor, least", [("op2_quality", 3, 0.9), ("op10_language", 3, 0.97)])
def test_held_out_accuracy(spark, name, divisor, least):
    place = "/root/testdata/sf0.01"
    found = queries.QUERIES[name](spark, place).where("held_out")
    if name == "op2_quality":
        right = found.join(spark.read.parquet(f"{place}/labels.parquet"), "doc_id").select((F.col("predicted") == F.col("quality")).cast("int").alias("ok"))
    else:
        right = found.join(spark.read.parquet(f"{place}/documents.parquet").select("doc_id", "lang"), "doc_id").select((F.col("lang_pred") == F.col("lang")).cast("int").alias("ok"))
    assert right.agg(F.avg("ok")).first()[0] >= least


class Links(HTMLParser):
    """An independent reading of a page's links and title."""

    def __init__(self, page):
        super().__init__()
        self.links, self.title, self.in_title = [], "", False
        self.feed(page)

    def handle_starttag(self, tag, attrs):
        self.in_title = tag == "title"
        if tag == "a" and (found := [value for name, value in attrs if name == "href"]):
            self.links.append(found[0] or "")

    def handle_endtag(self, tag):
        self.in_title = False

    def handle_data(self, data):
        self.title += data if self.in_title else ""


def test_quoted_values_may_hold_any_sign():
    for page, expected, links in (
        ('<a title="x > y" href="/z">t</a>', "t", ["/z"]),
        ("<a title='href=\"no\"' HREF = '/q?a>b&amp;c'>u</a> v", "u v", ["/q?a>b&c"]),
        ("<a data-href=/n href=/w/x/>w</a><a name=k>k</a><a href>e</a>", "wke", ["/w/x/", ""]),
        ("<p>it's <b a=it's>bold</b> \"so\"</p>", 'it\'s bold "so"', []),
        ('<a href="/open>rest of <b>page</b>', "rest of page", ['"/open']),
        ('<title data-x="a>b">T &amp; U</title>x', "T & U\nx", []),
    ):
        assert warc.plain_text(page) == (expected, links)


def test_derived_records_against_an_independent_parser(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    held = {row["page_id"]: row for row in pages.collect()}
    seen = 0
    for row in warc.derive(warc.responses(pages)).where("warc_type = 'metadata'").collect():
        raw = held[row["page_id"]]["html"] or ""
        block, parsed = json.loads(row["block"]), Links(raw)
        assert block["links"] == parsed.links and block["title"] == " ".join(parsed.title.split())
        assert block["payload_digest"] == row["source_payload_digest"] == "sha1:" + base64.b32encode(hashlib.sha1(raw.encode()).digest()).decode()
        assert ["Content-Length", str(len(raw.encode()))] in block["headers"] and row["source_header"].startswith(block["status"])
        seen += len(block["links"])
    assert seen > 0


def test_items_of_one_id_are_found_each(spark):
    one, other = "seven wonders of the ancient world", "a quick brown fox jumps over it"
    docs = frame(spark, [(1, f"{one} and {other}"), (2, other), (3, None)])
    items = spark.createDataFrame([(1, one), (1, other), (1, one), (None, other), (None, None)], "item_id long, text string")
    found = [(row["doc_id"], row["item_id"], row["distance"], row["item_chars"]) for row in decontaminate.find_items(docs, items).collect()]
    assert sorted(found, key=str) == sorted([(1, 1, 0, len(one)), (1, 1, 0, len(other)), (1, None, 0, len(other)), (2, 1, 0, len(other)), (2, None, 0, len(other))], key=str)


def test_tokenizers_that_tell_cases_apart_are_refused(tmp_path):
    made = json.loads(open(queries.vocabulary_path(), encoding="utf-8").read())
    made["normalizer"] = None
    (tmp_path / "cased.json").write_text(json.dumps(made), encoding="utf-8")
    with pytest.raises(ValueError, match="cases"):
        bpe.Vocabulary(str(tmp_path / "cased.json"))


def test_plain_text_of_a_page():
    page = "<html><head><title>T &amp; U</title><style>p{}</style></head><body><!-- x > y --><p>One\n two<p>a<b>b</b>c &lt;d&gt; <a href='/q?a=1&amp;b=2'>link</a><script>var x='</p>'</script><br/>end"
    text, links = warc.plain_text(page)
    assert text == "T & U\nOne two\nabc <d> link\nend"
    assert links == ["/q?a=1&b=2"]


def test_records_as_in_a_file(spark, odd):
    derived = warc.derive(warc.responses(spark.read.parquet(f"{odd}/pages.parquet")))
    kept = {row["record_id"]: row for row in derived.collect()}
    for row in warc.serialized(derived).collect():
        head, body = bytes(row["record"]).split(b"\r\n\r\n", 1)
        fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
        source = kept[row["record_id"]]
        assert fields["WARC-Refers-To"] == source["refers_to"] and fields["WARC-Type"] == source["warc_type"]
        assert body == source["block"].encode() + b"\r\n\r\n" and int(fields["Content-Length"]) == len(body) - 4
        assert warc.digest(body[:-4]) == fields["WARC-Block-Digest"]


def test_items_in_blocks(spark):
    docs = frame(spark, [(1, "the quick brown fox jumps over the lazy dog today"), (2, "nothing here"), (3, None)])
    items = spark.createDataFrame([(i, t) for i, t in enumerate(["quick brown fox jumps over", "another item that is absent", "the lazy dog today"])], "item_id long, text string")
    found = decontaminate.find_items(docs, items, block_chars=10)
    assert sorted((row["doc_id"], row["item_id"]) for row in found.collect()) == [(1, 0), (1, 2)]
    assert [row["doc_id"] for row in decontaminate.without_items(docs, items, block_chars=10).orderBy("doc_id").collect()] == [2, 3]


def test_pipeline_stages_take_effect(spark, odd, bare, sf, tmp_path):
    for place in (odd, bare, sf):
        docs = spark.read.parquet(f"{place}/documents.parquet")
        before = {(row["doc_id"], row["text"]) for row in docs.collect()}
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, place)
            assert out.columns == docs.columns and out.dtypes == docs.dtypes
            path = f"{tmp_path}/{abs(hash(place))}-{name}"
            out.write.parquet(path)
            left = spark.read.parquet(path)
            if name != "lines":
                assert {(row["doc_id"], row["text"]) for row in left.collect()} <= before
            docs, before = left, {(row["doc_id"], row["text"]) for row in left.collect()}
        ended = corpus_pipeline.STAGES[-1][1](spark, docs, place)
        assert ended.count() == docs.count()
        whole = corpus_pipeline.run(spark, place).select("doc_id", "ids_sha256")
        assert sorted(whole.collect(), key=str) == sorted(ended.select("doc_id", "ids_sha256").collect(), key=str)


def plain_logit(net, text):
    """The forward pass in plain loops over one text's own words."""
    rows = [int(row) for row in toxicity.table_row(toxicity.words([text])[0])] or [0]
    logit = net.constant
    for i, weights in enumerate(net.filters):
        for f in range(toxicity.FILTERS):
            best = max(
                sum(float(net.embedding[rows[at + j]] @ weight[:, f]) for j, weight in enumerate(weights) if at + j < len(rows)) for at in range(len(rows))
            )
            k = i * toxicity.FILTERS + f
            logit += max(best + float(net.bias[k]), 0) * float(net.out[k])
    return logit


def test_toxicity_scores_do_not_depend_on_neighbours(monkeypatch):
    rng = np.random.default_rng(4)
    net = toxicity.Network.start(*np.ones((3, toxicity.ROWS), np.float32))
    net.bias[:] = rng.normal(0, 0.3, len(net.bias))
    vocabulary = [f"w{chr(97 + i)}" for i in range(26)]
    texts = ["", " ", "a", "one two", *(" ".join(rng.choice(vocabulary, n)) for n in rng.integers(1, 60, 40)), "", "last"]
    together = net.scores(texts)
    assert np.allclose(together, [net.scores([text])[0] for text in texts], atol=1e-5)
    assert np.allclose(together, net.scores(texts[::-1])[::-1], atol=1e-5)
    assert np.allclose(together, toxicity.sigmoid(np.array([plain_logit(net, text) for text in texts])), atol=1e-5)
    # blocks of few places cut texts anywhere
    monkeypatch.setattr(toxicity, "PLACES", 7)
    assert np.allclose(together, net.scores(texts), atol=1e-5)


def plain_pooled(text, vectors):
    rows = [vectors[i] for i in quality.table_row(quality.tokens([text.encode()])[0])]
    mean = [sum(float(v[k]) for v in rows) / max(1, len(rows)) for k in range(quality.WIDTH)]
    square = [sum(float(v[k]) ** 2 for v in rows) / max(1, len(rows)) for k in range(quality.WIDTH)]
    return [*mean, *(max(0.0, s - m * m) ** 0.5 for s, m in zip(square, mean)), np.log1p(len(rows))]


def test_quality_pools_like_plain_loops(monkeypatch):
    rng = np.random.default_rng(6)
    vectors = rng.normal(0, 1, (quality.ROWS, quality.WIDTH)).astype(np.float32)
    texts = ["", "a", "One, two 3!", *(" ".join(f"w{i}" for i in rng.integers(0, 50, n)) for n in rng.integers(1, 40, 20)), "x" * 300, "", "end"]
    expected = np.array([plain_pooled(text, vectors) for text in texts])
    assert np.allclose(quality.pooled(texts, vectors), expected, atol=2e-3)
    monkeypatch.setattr(quality, "TOKENS", 5)
    monkeypatch.setattr(quality, "pieces", lambda text, owner: texts_module.pieces(text, owner, 16))
    monkeypatch.setattr(quality, "grouped", lambda parts: texts_module.grouped(parts, 40))
    assert np.allclose(quality.pooled(texts, vectors), expected, atol=2e-3)


def test_run_hashes_in_blocks(monkeypatch):
    data = np.random.default_rng(2).integers(0, 256, 5000).astype(np.uint8)
    starts = np.sort(np.random.default_rng(3).integers(0, 4900, 400))
    ends = starts + np.random.default_rng(5).integers(0, 100, 400)
    whole = texts_module.run_hashes(data, starts, ends)
    monkeypatch.setattr(texts_module, "SLICE_BYTES", 64)
    assert np.array_equal(whole, texts_module.run_hashes(data, starts, ends))


def test_a_rare_toxic_word_counts_in_a_large_sample():
    """Three of 3,000 texts hold the word, all toxic; a bar of one text in 600 would have passed it over."""
    rng = np.random.default_rng(19)
    common = toxicity.table_row(toxicity.words([" ".join(f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(200))])[0])
    bad, rare = toxicity.table_row(toxicity.words(["horrid ghastly"])[0])
    labels = np.array([i % 4 == 0 for i in range(3000)], float)
    rows = [np.append(rng.choice(common, 20), np.full(int(label), bad)) for label in labels]
    for i in (0, 4, 8):
        rows[i] = np.append(rows[i][:-1], rare)
    net = toxicity.train(rows, labels)
    clean = [text for text, label in zip(rows, labels) if not label][:50]
    logit = lambda text: net.logits(*toxicity.layout(text, np.zeros(len(text), np.int64), 1))[0]
    assert np.abs(net.embedding[rare]).max() > 0
    assert np.mean([logit(np.append(text, rare)) - logit(text) for text in clean]) > 0.5


def test_a_sample_is_bounded_by_words(spark, monkeypatch):
    rows = [(i, bytes(4 * (400 if i % 4 else 100)), float(i % 4 == 0), 2.0) for i in range(2000)]
    sampled = frame(spark, rows, "doc_id long, words binary, label double, weight double")
    assert toxicity.within_words(sampled, 650_000).count() == 2000
    got = toxicity.within_words(sampled, 200_000).collect()
    by = {label: [row for row in got if row["label"] == label] for label in (0.0, 1.0)}
    assert sum(len(row["words"]) for row in got) / 4 <= 1.1 * 200_000 and len(by[1.0]) == 500
    assert all(len(row["words"]) in (400, 1600) for row in got)
    # weights still add up to the rows that the labels stand for
    assert abs(sum(row["weight"] for row in got) - 4000) < 400
    # what the driver learns from is so bounded
    seen = []
    monkeypatch.setattr(toxicity, "train", lambda texts, labels: seen.append(sum(map(len, texts))) or toxicity.Network.start(*np.ones((3, toxicity.ROWS), np.float32)))
    docs = frame(spark, [(i, "word " * 300) for i in range(400)])
    marks = frame(spark, [(i, i % 2) for i in range(400)], "doc_id long, label int")
    toxicity.fit(docs, marks, F.lit(True), sample_words=30_000)
    assert 0 < seen[0] <= 33_000


def test_toxicity_learns_from_every_labelled_row(spark, monkeypatch):
    """Several learners: counts, steps and thresholds see all rows, and words that one learner alone has met count."""
    rng = np.random.default_rng(29)
    common = [f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(200)]
    rows = [(i, " ".join([*rng.choice(common, 20), *(["horrid"] if i % 3 == 0 and i > 60 else ["ghastly"] if i % 3 == 0 else [])])) for i in range(1500)]
    marks = frame(spark, [(i, int(i % 3 == 0)) for i in range(1500)], "doc_id long, label int")
    monkeypatch.setattr(toxicity, "LEARNER_ROWS", 250)
    counted, real, sums = [], toxicity.calibrate, toxicity.train_on_all
    monkeypatch.setattr(toxicity, "calibrate", lambda net, held: counted.append(held.count()) or real(net, held))
    monkeypatch.setattr(toxicity, "train_on_all", lambda rows, *n: counted.append((rows.count(), rows.rdd.getNumPartitions(), sum(n))) or sums(rows, *n))
    net = toxicity.fit(frame(spark, rows), marks, F.lit(True))
    (learned, learners, given), held = counted
    assert learned + held == 1500 and given == learned and learners == -(-learned // 250) > 3
    scores = net.scores([text for _, text in rows])
    assert np.mean((scores >= 0.5) == (np.arange(1500) % 3 == 0)) > 0.98
    plain = " ".join(common[:20])
    assert net.scores([plain + " ghastly"])[0] > net.scores([plain])[0] + 0.2
    again = toxicity.fit(frame(spark, rows[::-1]).repartition(5), marks, F.lit(True))
    assert np.allclose(net.embedding, again.embedding, atol=1e-5) and np.allclose(net.thresholds, again.thresholds)


def test_crowded_blocks_are_cut_by_finer_bands(spark):
    """Band 1 has 100 classes in ten groups by finer band, band 2 has 60 close ones, band 3 is not crowded."""
    rows = [(bytes([i]), [1], [i // 10]) for i in range(100)]
    rows += [(bytes([100 + i]), [2], [50, 51]) for i in range(60)] + [(bytes([200 + i]), [3], [60 + i]) for i in range(5)]
    classes = frame(spark, rows, "fp binary, bands array<long>, finer array<long>")
    blocks = {}
    for row in simhash.shared_bands(classes, 50).collect():
        blocks.setdefault(row["band"], set()).add(bytes(row["fp"])[0])
    assert sorted(map(len, blocks.values())) == [5] + [10] * 10 + [60]
    assert blocks[2] == set(range(100, 160)) and blocks[3] == set(range(200, 205))
