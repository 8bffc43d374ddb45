"""The whole pipeline against a plain reading of its stages, one text at a time."""

import hashlib

import numpy as np
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from rasterloom.llm import decontaminate, queries, simhash, toxicity
from rasterloom.llm.fingerprints import Sketch
from rasterloom.llm.texts import mixed, shingle_hashes
from rasterloom.llm.training import id_remainder


def key(line):
    found = line.strip(" \t\n\v\f\r")
    found = "".join(c.lower() if "A" <= c <= "Z" else c for c in found)
    return found if len(found) >= 40 else None


def without_lines(docs):
    holders = {}
    for doc_id, text in docs.items():
        for line in text.split("\n"):
            holders.setdefault(key(line), set()).add(doc_id)
    gone = {k: max(ids) for k, ids in holders.items() if k is not None and len(ids) >= 5}
    return {i: "\n".join(x for x in t.split("\n") if key(x) not in gone or gone[key(x)] == i) for i, t in docs.items()}


def wide_print(text):
    hashes = np.unique(shingle_hashes([text], simhash.ALIKE_WORDS)[0])
    lanes = [int(simhash.fingerprint(mixed(hashes + np.uint64(lane)), np.zeros(len(hashes), int), 1)[0]) for lane in range(simhash.LANES)]
    return sum(lane << 64 * i for i, lane in enumerate(lanes))


def shingle_set(text):
    words = text.encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def one_of_each(docs, least):
    """Least id of every component of texts alike to ``least``; all pairs that share a shingle are compared."""
    sets = {i: shingle_set(text) for i, text in docs.items()}
    root = {i: i for i in sets}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    held, bare = {}, [i for i in sorted(sets) if not sets[i]]
    pairs = {(bare[0], i) for i in bare[1:]} if bare else set()
    for i in sorted(sets):
        for shingle in sets[i]:
            for j in held.setdefault(shingle, []):
                pairs.add((j, i))
            held[shingle].append(i)
    for a, b in pairs:
        if not sets[a] or len(sets[a] & sets[b]) >= least * len(sets[a] | sets[b]):
            root[max(top(a), top(b))] = min(top(a), top(b))
    return {i for i in sets if top(i) == i}


def test_pipeline_equals_plain_stages(spark, tmp_path):
    place = "/root/testdata/sf0.01"
    table = spark.read.parquet(f"{place}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)

    def after(name, rows):
        stages[name](spark, rows, place).write.parquet(f"{tmp_path}/{name}")
        left = spark.read.parquet(f"{tmp_path}/{name}")
        return left, {row["doc_id"]: row["text"] for row in left.collect()}

    docs = {row["doc_id"]: row["text"] or "" for row in table.collect()}
    marks = spark.read.parquet(f"{place}/labels.parquet").select("doc_id", F.col("toxic").alias("label"))
    net = toxicity.fit(table, marks, F.coalesce(id_remainder(5) != 0, F.lit(True)))
    rows, clean = after("toxicity", table)
    assert clean == {i: t for i, t in docs.items() if net.scores([t])[0] < 0.5}
    rows, cut = after("lines", rows)
    assert cut == without_lines(clean)
    rows, single = after("near_duplicates", rows)
    assert set(single) == one_of_each(cut, 0.8)
    assert all(cut[i] == t for i, t in single.items()) and len(single) < len(cut) - 50
    items = [tuple(row) for row in spark.read.parquet(f"{place}/benchmark.parquet").select("item_id", "text").collect()]
    matcher = decontaminate.Matcher(items, decontaminate.ERROR_RATE)
    rows, apart = after("benchmarks", rows)
    assert apart == {i: t for i, t in single.items() if not matcher.matches(t)} and len(apart) < len(single)
    tokenizer = Tokenizer.from_file(queries.vocabulary_path())
    expected = {}
    for i, text in apart.items():
        ids = tokenizer.encode(text, add_special_tokens=False).ids
        expected[i] = len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
    assert {row["doc_id"]: (row["n_tokens"], row["ids_sha256"]) for row in corpus_pipeline.run(spark, place).collect()} == expected


def test_alike_texts_meet_and_others_do_not():
    """Rates of linking at stated likeness, over random texts."""
    rng = np.random.default_rng(3)
    words = np.array([f"w{i}" for i in range(3000)])

    def distance(share):
        base = rng.choice(words, 400)
        other = base.copy()
        # each changed word takes five shingles with it
        n = int(round((1 - share) / (1 + share) * 396 / 5))
        other[rng.choice(np.arange(5, 395, 6), n, replace=False)] = [f"x{rng.integers(1 << 30)}" for _ in range(n)]
        return (wide_print(" ".join(base)) ^ wide_print(" ".join(other))).bit_count()

    for share, least in ((0.8, 0.75), (0.85, 0.92), (0.9, 0.98)):
        assert np.mean([distance(share) <= simhash.ALIKE_BITS for _ in range(100)]) >= least
    assert min(distance(0.3) for _ in range(50)) > simhash.ALIKE_BITS


def test_bands_of_alike_texts_meet():
    rng = np.random.default_rng(5)
    words = np.array([f"w{i}" for i in range(3000)])
    sketch = Sketch(simhash.ALIKE_WORDS, simhash.BAND * simhash.BANDS)
    met = 0
    for _ in range(100):
        base = rng.choice(words, 400)
        other = base.copy()
        other[rng.choice(np.arange(5, 395, 6), 9, replace=False)] = "x"
        values, _ = sketch.values([" ".join(base), " ".join(other)])
        rows = values.reshape(2, simhash.BANDS, simhash.BAND)
        met += (rows[0] == rows[1]).all(axis=1).any()
    assert met >= 98


def likeness(a, b):
    return len(a & b) / len(a | b)


def test_only_texts_alike_to_the_contract_are_one(spark):
    """Pairs that share a long passage, alike to 0.6 to 0.78, stay; their prints are often within the bits."""
    rng = np.random.default_rng(11)
    words = np.array([f"w{i}" for i in range(3000)])
    docs, within = {}, 0
    for pair in range(40):
        base = rng.choice(words, 400)
        other = base.copy()
        n = 10 + pair % 8
        other[rng.choice(np.arange(5, 395, 6), n, replace=False)] = [f"x{rng.integers(1 << 30)}" for _ in range(n)]
        docs |= {2 * pair: " ".join(base), 2 * pair + 1: " ".join(other)}
        assert 0.55 < likeness(shingle_set(docs[2 * pair]), shingle_set(docs[2 * pair + 1])) < 0.8
        within += (wide_print(docs[2 * pair]) ^ wide_print(docs[2 * pair + 1])).bit_count() <= simhash.ALIKE_BITS
    assert within > 5
    table = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    assert {row["doc_id"] for row in simhash.one_of_each(table).collect()} == set(docs)


def plain_groups(sets):
    """Least member of each set's component over all pairs alike to 0.8, by name."""
    root = {i: i for i in sets}

    def top(i):
        return i if root[i] == i else top(root[i])

    for a in sets:
        for b in sets:
            if a < b and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                root[max(top(a), top(b))] = min(top(a), top(b))
    return {i: top(i) for i in sets}


def edited(rng, base, share):
    """A copy of the words, alike to about ``share``."""
    other = list(base)
    n = int((1 - share) / (1 + share) * (len(base) - 4) / 5)
    for at in rng.choice(np.arange(5, len(base) - 5, 6), n, replace=False):
        other[at] = f"x{rng.integers(1 << 30)}"
    return other


def test_edited_groups_leave_what_exact_jaccard_leaves(spark):
    """Edits of one text, each alike to it to 0.82, are one; no condition on bits."""
    rng = np.random.default_rng(13)
    words = [f"w{i}" for i in range(3000)]
    docs = {}
    for _ in range(6):
        base = rng.choice(words, 400).tolist()
        for text in [base, *(edited(rng, base, 0.81) for _ in range(20))]:
            docs[len(docs)] = " ".join(text)
    expected = set(plain_groups({i: shingle_set(text) for i, text in docs.items()}).values())
    # prints of some of these pairs are too far apart for the bits
    prints = {i: wide_print(text) for i, text in docs.items()}
    assert any((prints[21 * g] ^ prints[21 * g + i]).bit_count() > simhash.ALIKE_BITS for g in range(6) for i in range(1, 21))
    assert len(expected) == 6
    table = spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(4)
    for block in (8, 4096):
        assert {row["doc_id"] for row in simhash.one_of_each(table, block).collect()} == expected


def test_a_block_connects_what_all_pairs_connect():
    """Stars and chains in any order: a set alike to a follower only is linked too."""
    rng = np.random.default_rng(17)
    for trial in range(150):
        sets, base = {}, rng.integers(0, 1 << 40, 100)
        for _ in range(12):
            # a step from any set so far, sometimes too far to be alike
            base = sets[rng.integers(len(sets))] if sets else set(base.tolist())
            kept = rng.permutation(sorted(base)).tolist()[int(rng.integers(3, 14)) :]
            sets[len(sets)] = {*kept, *rng.integers(0, 1 << 40, 100 - len(kept)).tolist()}
        block, root = simhash.Block(), {i: i for i in sets}

        def top(i):
            return i if root[i] == i else top(root[i])

        for i in rng.permutation(len(sets)).tolist():
            for one, other in block.add(bytes([i]), np.array(sorted(sets[i]), np.uint64)):
                a, b = top(one[0]), top(other[0])
                root[max(a, b)] = min(a, b)
        assert {i: top(i) for i in sets} == plain_groups(sets)


def test_pairs_beyond_the_bits_are_one(spark):
    """Pairs alike to 0.8 or more whose prints differ in more bits than ALIKE_BITS."""
    rng = np.random.default_rng(23)
    words = [f"w{i}" for i in range(3000)]
    docs = {}
    while len(docs) < 20:
        base = rng.choice(words, 400).tolist()
        pair = " ".join(base), " ".join(edited(rng, base, 0.81))
        if (wide_print(pair[0]) ^ wide_print(pair[1])).bit_count() > simhash.ALIKE_BITS:
            assert likeness(*map(shingle_set, pair)) >= 0.8
            docs |= {len(docs) + i: text for i, text in enumerate(pair)}
    table = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    assert {row["doc_id"] for row in simhash.one_of_each(table).collect()} == set(range(0, 20, 2))


def test_texts_meet_by_their_fingerprints(spark, monkeypatch):
    """Where no minima are shared, texts whose fingerprints reach each other at two bits are compared, and sets still decide."""

    class Apart(Sketch):
        def table(self, hashes, owner, n):
            values, worded = super().table(hashes, owner, n)
            return np.random.default_rng().integers(1 << 63, size=values.shape, dtype=np.uint64), worded

    def points(texts):
        return [int(p) for p in simhash.set_prints(*simhash.sets_of(texts), len(texts))[:, 0]]

    rng = np.random.default_rng(31)
    words = [f"w{i}" for i in range(3000)]
    close, apart = [], []
    while len(close) < 6:
        base = rng.choice(words, 1500).tolist()
        pair = [" ".join(base), " ".join([*base[:700], "other", *base[701:]])]
        if (points(pair)[0] ^ points(pair)[1]).bit_count() <= 2:
            close.append(pair)
    # fifteen shingles of nineteen are shared: 0.79
    tails = [[" ".join([*base, "a", "b"]), " ".join([*base, "c", "d"])] for base in rng.choice(words, (8000, 19)).tolist()]
    found = points([text for pair in tails for text in pair])
    apart = [pair for pair, p, q in zip(tails, found[::2], found[1::2]) if (p ^ q).bit_count() <= 2][:3]
    assert apart and all(0.75 < likeness(*map(shingle_set, pair)) < 0.8 for pair in apart)
    docs = dict(enumerate(text for pair in close + apart for text in pair))
    monkeypatch.setattr(simhash, "Sketch", Apart)
    table = spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(3)
    assert {row["doc_id"] for row in simhash.one_of_each(table).collect()} == set(docs) - {1, 3, 5, 7, 9, 11}


def test_chains_of_prints_spare_comparisons(monkeypatch):
    """Unrelated sets of a block are told apart by their prints."""
    rng = np.random.default_rng(37)
    compared, real = [], simhash.Block._common
    monkeypatch.setattr(simhash.Block, "_common", lambda self, *pair: compared.append(pair) or real(self, *pair))
    sets = [np.sort(rng.integers(1 << 62, size=200).astype(np.uint64)) for _ in range(150)]
    sets += [np.sort(np.concatenate([own[10:], rng.integers(1 << 62, size=10).astype(np.uint64)])) for own in sets[:20]]
    block = simhash.Block()
    links = [link for i, own in enumerate(sets) for link in block.add(bytes([i]), own)]
    assert sorted((one[0], other[0]) for one, other in links) == [(150 + i, i) for i in range(20)]
    assert len(compared) < 100


def test_prints_prune_no_alike_sets():
    """The widths hold for sets of any size from ``FEW`` on, at the least likeness that they are for."""
    rng = np.random.default_rng(41)
    for share, bits in ((0.8, simhash.NEAR_BITS), (0.6, simhash.FAR_BITS)):
        for size in (*range(simhash.FEW, 40), 100, 1000):
            union = int(size * (2 / (1 + share)))
            common = int(np.ceil(share * union))
            most = 0
            for _ in range(40):
                pool = rng.integers(1 << 63, size=union, dtype=np.uint64)
                half = common + (union - common) // 2
                one, other = pool[:half], np.concatenate([pool[:common], pool[half:]])
                owner = np.repeat([0, 1], [len(one), len(other)])
                prints = simhash.set_prints(np.concatenate([one, other]), owner, 2)
                counts = np.bitwise_count(prints[:1] ^ prints[1])
                assert simhash.ring_survivors(counts, bits)[0]
                most = max(most, int(counts.sum()))
            assert most <= bits
