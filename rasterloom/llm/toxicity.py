"""Toxic documents by a convolutional text classifier.

Words are lower-case runs of letters, hashed to rows of an embedding. Filters
over one, two and three words in a row are pooled by their maximum over the
whole text, and a linear layer gives one logit. All of it is trained in numpy
on every labelled document: rows are dealt at random to learners of about
``LEARNER_ROWS`` rows, each a task, which step through theirs; after each epoch
their networks are averaged, a word's embedding over the learners that met the
word. Logits are then shifted by a threshold and divided by a temperature, both
calibrated on the counts of all held-back rows, a fifth, by logit to 1 / ``GRAIN``.
Thresholds are calibrated by language, which is told from function
words in the text; a language with too few held-back rows shares the common
threshold.

Filters are pooled over the places of a text's own words only, so a score does
not depend on the texts beside it. Null and empty texts have one place of
zeros. Without labelled rows of both kinds every score is 0. Long texts are
hashed in pieces and pooled in blocks, so memory is bounded by their words.
Where labels of one id disagree the larger one counts, every row of a repeated
id is learned from and scored, and further columns pass through in ``row``. Words that fewer than
``LEAST_TEXTS`` learned texts hold have a zero embedding, so they neither
raise nor lower a score. That count is the same for every table; rare words
above it are shrunk: they start from their lean, which is in standard errors,
and what chance and training add to it is scaled by texts / (texts + SHRINK).
"""

from __future__ import annotations

import copy
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from rasterloom.llm.texts import joined, run_hashes, runs, sliced, struct_of, text_of
from rasterloom.llm.training import block_sums, labelled, one_label, sample, share, sigmoid, temperature
from rasterloom.session import cut_lineage

# Rows that one learner steps through in an epoch, about, and bytes of word rows that it takes in at once.
LEARNER_ROWS, LEARNER_BYTES = 16_000, 1 << 24
WORDS_SEED, DEAL_SEED, BACK_SEED = 21, 22, 23
# Parts of a logit that held-back rows are counted by, and the greatest logit told apart.
GRAIN, FARTHEST = 256, 40
ROWS, WIDTH, FILTERS, SPANS = 1 << 16, 16, 16, (1, 2, 3)
EPOCHS, BATCH, RATE = 8, 32, 0.1
# Places that are pooled at once.
PLACES = 1 << 14
# Texts that must hold a word for it to get an embedding, and texts at which half of what is learned of it counts.
LEAST_TEXTS, SHRINK = 3, 5
# Held-back rows, and toxic ones among them, that a language's own threshold takes.
LEAST_ROWS, LEAST_TOXIC = 40, 8

# Frequent function words of each language.
FUNCTION_WORDS = {
    "en": "the of and to in is that it was for on are with as be this have from or by",
    "de": "der die und das nicht ist ein eine zu den mit von dem auch sich auf im als",
    "fr": "le la les des et un une est que pour dans qui pas au du sur par avec plus",
    "es": "el la los las y en un una por con para se del al es su lo como que",
}
LANGUAGES = [*FUNCTION_WORDS, "other"]

_LETTER = np.zeros(256, bool)
_LETTER[97:123] = True
_LETTER[128:] = True


def words(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word and the text it is from."""
    data, begins = joined([text.lower().encode() for text in texts])
    starts, ends = runs(_LETTER[data])
    return run_hashes(data, starts, ends), np.searchsorted(begins, starts, "right") - 1


def languages(hashes: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """Number of the language with most function words in each text; the last number without any."""
    counts = np.zeros((n, len(LANGUAGES)))
    for i, listed in enumerate(FUNCTION_WORDS.values()):
        known, _ = words([word for word in listed.split()])
        counts[:, i] = np.bincount(owner[np.isin(hashes, known)], minlength=n)
    counts[:, -1] = 0.5
    return counts.argmax(axis=1)


def layout(rows: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word rows of all texts, where each text begins, and where its own places end.

    Behind each text stand as many places of padding (row 0) as a filter can
    reach. An empty text has one place of its own, a zero.
    """
    pad = max(SPANS) - 1
    counts = np.bincount(owner, minlength=n)
    own = np.maximum(counts, 1)
    starts = np.cumsum(own + pad) - own - pad
    laid = np.zeros(int(own.sum()) + pad * n, np.int64)
    laid[np.arange(len(rows)) + np.repeat(starts - (np.cumsum(counts) - counts), counts)] = rows
    return laid, starts, starts + own


def table_row(hashes: np.ndarray) -> np.ndarray:
    return 1 + (hashes % np.uint64(ROWS - 1)).astype(np.int64)


@dataclass
class Network:
    """Embedding, filters (span by span, position by position) and output layer."""

    embedding: np.ndarray
    filters: list[np.ndarray]
    bias: np.ndarray
    out: np.ndarray
    constant: float
    thresholds: np.ndarray = field(default_factory=lambda: np.zeros(len(LANGUAGES)))
    divisor: float = 1.0

    @classmethod
    def start(cls, seen: np.ndarray, lean: np.ndarray, trust: np.ndarray, seed: int = 1) -> Network:
        """Random weights, in embeddings times ``trust``; the first place of a word's embedding is its ``lean`` to either label."""
        rng = np.random.default_rng(seed)
        embedding = rng.normal(0, 0.1, (ROWS, WIDTH)).astype(np.float32)
        embedding *= trust[:, None]
        embedding[:, 0] = 0.1 * lean
        embedding *= seen[:, None]
        embedding[0] = 0
        filters = [rng.normal(0, 0.3, (span, WIDTH, FILTERS)).astype(np.float32) for span in SPANS]
        pooled = FILTERS * len(SPANS)
        return cls(embedding, filters, np.zeros(pooled, np.float32), rng.normal(0, 0.3, pooled).astype(np.float32), 0.0)

    def responses(self, vectors: np.ndarray) -> np.ndarray:
        """Each filter at each word; a filter that reaches beyond the end meets zeros."""
        found = np.zeros((len(vectors), FILTERS * len(SPANS)), np.float32)
        for i, weights in enumerate(self.filters):
            part = found[:, i * FILTERS : (i + 1) * FILTERS]
            for j, weight in enumerate(weights):
                part[: len(vectors) - j] += vectors[j:] @ weight
        return found

    def pooled(self, laid: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The greatest response of each filter among each text's own places, in blocks of places."""
        found = np.full((len(starts), FILTERS * len(SPANS)), -np.inf, np.float32)
        for at in range(0, len(laid), PLACES):
            to = min(at + PLACES, len(laid))
            first, last = np.searchsorted(ends, at, "right"), np.searchsorted(starts, to, "left")
            if first == last:
                continue
            some = self.responses(self.embedding[laid[at : to + max(SPANS) - 1]])
            # pairs of own places and padding: every other segment is a text's own
            cuts = np.stack([starts[first:last], ends[first:last]], axis=1).clip(at, to).ravel() - at
            padded = np.concatenate([some[: to - at], np.full((1, some.shape[1]), -np.inf, np.float32)])
            found[first:last] = np.maximum(found[first:last], np.maximum.reduceat(padded, cuts, axis=0)[::2])
        return found

    def logits(self, laid: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return np.maximum(self.pooled(laid, starts, ends) + self.bias, 0) @ self.out + self.constant

    def scores(self, texts: list[str]) -> np.ndarray:
        hashes, owner = words(texts)
        logits = self.logits(*layout(table_row(hashes), owner, len(texts)))
        return sigmoid((logits - self.thresholds[languages(hashes, owner, len(texts))]) / self.divisor)


class Learner:
    """A network under training by Adagrad on log loss, with the sums of squares that its steps go by."""

    def __init__(self, net: Network, seen: np.ndarray, trust: np.ndarray, shares: list[np.ndarray] | None = None):
        self.net, self.seen, self.trust = net, seen, trust
        self.shares = shares or [np.full_like(each, 1e-4) for each in self.weights()]
        self.met = np.zeros(ROWS, bool)

    def weights(self) -> list[np.ndarray]:
        net = self.net
        return [net.embedding, *net.filters, net.bias, net.out]

    def sent(self) -> tuple:
        """Plain arrays for a task; rows of words without an embedding, which stay as they began, are left out."""
        rows, net = np.flatnonzero(self.seen), self.net
        return rows, self.trust[rows], net.embedding[rows], self.shares[0][rows], net.filters, net.bias, net.out, net.constant, self.shares[1:]

    @classmethod
    def received(cls, sent: tuple) -> Learner:
        rows, trust_, embedding_, squares_, filters, bias, out, constant, shares = copy.deepcopy(sent)
        embedding, squares = np.zeros((ROWS, WIDTH), np.float32), np.full((ROWS, WIDTH), 1e-4, np.float32)
        seen, trust = np.zeros(ROWS, bool), np.zeros(ROWS, np.float32)
        embedding[rows], squares[rows], seen[rows], trust[rows] = embedding_, squares_, True, trust_
        return cls(Network(embedding, filters, bias, out, constant), seen, trust, [squares, *shares])

    def steps(self, texts: list[np.ndarray], labels: np.ndarray, rate: float, rng: np.random.Generator) -> None:
        """One pass over the texts in random order."""
        net, seen, trust, shares = self.net, self.seen, self.trust, self.shares
        order = rng.permutation(len(texts))
        for at in range(0, len(texts), BATCH):
            some = order[at : at + BATCH]
            owner = np.repeat(np.arange(len(some)), [len(texts[i]) for i in some])
            laid, starts, ends = layout(np.concatenate([texts[i] for i in some]), owner, len(some))
            vectors = net.embedding[laid]
            found = net.responses(vectors)
            at_most = np.stack([a + found[a:b].argmax(axis=0) for a, b in zip(starts.tolist(), ends.tolist())])
            raised = found[at_most, np.arange(found.shape[1])] + net.bias
            active = np.maximum(raised, 0)
            error = ((sigmoid(active @ net.out + net.constant) - labels[some]) / len(some)).astype(np.float32)
            back = error[:, None] * net.out * (raised > 0)
            grads = []
            touched, moved = [], []
            for i, weight in enumerate(net.filters):
                part = slice(i * FILTERS, (i + 1) * FILTERS)
                grad = np.zeros_like(weight)
                for j in range(SPANS[i]):
                    place = at_most[:, part] + j
                    grad[j] = np.einsum("bf,bfw->wf", back[:, part], vectors[place])
                    touched.append(laid[place].ravel())
                    moved.append((back[:, part, None] * weight[j].T[None]).reshape(-1, WIDTH))
                grads.append(grad)
            for kept, grad, value in zip(shares[1:], [*grads, back.sum(axis=0), error @ active], [*net.filters, net.bias, net.out]):
                kept += grad * grad
                value -= rate * grad / np.sqrt(kept)
            net.constant -= rate * float(error.sum())
            hit, which = np.unique(np.concatenate(touched), return_inverse=True)
            step = np.zeros((len(hit), WIDTH), np.float32)
            np.add.at(step, which, np.concatenate(moved))
            step *= seen[hit, None]
            step[hit == 0] = 0
            shares[0][hit] += step * step
            net.embedding[hit] -= rate * trust[hit, None] * step / np.sqrt(shares[0][hit])
            self.met[hit] = True

    def flat(self) -> np.ndarray:
        """Weights and sums of squares in one vector, the embedding and its sums first."""
        return np.concatenate([self.net.embedding.ravel(), self.shares[0].ravel(), *map(np.ravel, self.weights()[1:]), *map(np.ravel, self.shares[1:]), np.array([self.net.constant], np.float32)])

    def take(self, flat: np.ndarray) -> None:
        at = 0
        for each in (self.net.embedding, self.shares[0], *self.weights()[1:], *self.shares[1:]):
            each[:] = flat[at : at + each.size].reshape(each.shape)
            at += each.size
        self.net.constant = float(flat[at])


def learner(toxic: np.ndarray, n_toxic: float, clean: np.ndarray, n_clean: float, seed: int = 1) -> Learner:
    """A learner at its start, from the texts of either label that hold each word row."""
    held = toxic + clean
    seen, trust = held >= LEAST_TEXTS, (held / (held + SHRINK)).astype(np.float32)
    return Learner(Network.start(seen, standard_score(toxic, n_toxic, clean, n_clean), trust, seed), seen, trust)


def epoch_rate(epoch: int) -> float:
    return RATE * (1 - epoch / EPOCHS)


def train(texts: list[np.ndarray], labels: np.ndarray, seed: int = 1) -> Network:
    """Fit a network to word rows per text that are at hand, all texts alike."""
    toxic, clean = (holders([text for text, own in zip(texts, labels) if (own > 0) == label]) for label in (True, False))
    made = learner(toxic, labels.sum(), clean, len(labels) - labels.sum(), seed)
    rng = np.random.default_rng(seed)
    for epoch in range(EPOCHS):
        made.steps(texts, labels, epoch_rate(epoch), rng)
    return made.net


def word_rows(part: pa.RecordBatch) -> tuple[list[np.ndarray], np.ndarray]:
    """Word rows of each text of a batch of ``words``, and its labels as 0 or 1."""
    texts = [np.frombuffer(each, np.int32) for each in part.column("words").to_pylist()]
    return texts, (part.column("label").to_numpy(zero_copy_only=False) > 0).astype(float)


def train_on_all(rows: DataFrame, n_toxic: int, n_clean: int, seed: int = 1) -> Network:
    """Fit a network to ``words`` and ``label`` of every row, where a partition is a learner's."""

    def counting():
        def add(batch: pa.RecordBatch, total: np.ndarray) -> None:
            for part in sliced([batch], "words", LEARNER_BYTES):
                texts, labels = word_rows(part)
                for i, label in enumerate((1, 0)):
                    total[i * ROWS : (i + 1) * ROWS] += holders([text for text, own in zip(texts, labels) if own == label])

        return add

    toxic, clean = block_sums(rows, 2 * ROWS, counting).reshape(2, ROWS)
    made = learner(toxic, n_toxic, clean, n_clean, seed)
    words_ = 2 * ROWS * WIDTH
    for epoch in range(EPOCHS):
        before, sent = made.flat(), rows.sparkSession.sparkContext.broadcast(made.sent())

        def stepping():
            own, rng = Learner.received(sent.value), np.random.default_rng([seed, epoch])
            start = own.flat()

            def add(batch: pa.RecordBatch, total: np.ndarray) -> None:
                for part in sliced([batch], "words", LEARNER_BYTES):
                    own.steps(*word_rows(part), epoch_rate(epoch), rng)
                # how far this learner has come, the words it met, and one learner
                total[:] = np.concatenate([own.flat() - start, own.met, [1]])

            return add

        moved = block_sums(rows, len(before) + ROWS + 1, stepping)
        sent.destroy()
        far, met, learners = moved[: len(before)], moved[len(before) : -1], max(1.0, moved[-1])
        over = np.tile(np.repeat(np.maximum(met, 1), WIDTH), 2)
        made.take(before + np.concatenate([far[:words_] / over, far[words_:] / learners]))
    return made.net


def holders(texts: list[np.ndarray]) -> np.ndarray:
    """Texts that hold each word row."""
    return np.bincount(np.concatenate([np.unique(rows) for rows in texts] or [np.zeros(0, np.int64)]), minlength=ROWS)


def standard_score(one: np.ndarray, of_one: float, other: np.ndarray, of_other: float) -> np.ndarray:
    """How many standard errors two shares are apart; 0 where both are 0."""
    share = (one + other) / (of_one + of_other)
    error = np.sqrt(np.maximum(share * (1 - share) * (1 / max(of_one, 1) + 1 / max(of_other, 1)), 1e-12))
    return (one / max(of_one, 1) - other / max(of_other, 1)) / error


def best_threshold(logits: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> float:
    """The middle between two neighbouring logits that gives the best weighted F1."""
    order = np.argsort(-logits, kind="stable")
    hits = np.cumsum((labels * weights)[order])
    picked = np.cumsum(weights[order])
    f1 = 2 * hits / (picked + (labels * weights).sum())
    ranked = logits[order]
    apart = np.append(ranked[:-1] > ranked[1:], True)
    i = int(np.argmax(np.where(apart, f1, -1)))
    return float((ranked[i] + ranked[i + 1]) / 2) if i + 1 < len(ranked) else float(ranked[i]) - 1e-6


def within_words(sampled: DataFrame, most: int) -> DataFrame:
    """The rows, or as even a part of each label as keeps their ``words`` to about ``most``; weights follow."""
    found = sampled.groupBy("label").agg(F.sum(F.octet_length("words") / 4).alias("words")).collect()
    if sum(row["words"] for row in found) <= most:
        return sampled
    # each label has an equal part of the words, and what one leaves goes to the other
    rate, left = F.lit(0.0), float(most)
    for n, row in enumerate(sorted(found, key=lambda row: row["words"])):
        own = min(1.0, left / (len(found) - n) / max(1.0, row["words"]))
        left -= own * row["words"]
        rate = F.when(F.col("label") == row["label"], own).otherwise(rate)
    return sampled.where(share(WORDS_SEED) < rate).withColumn("weight", F.col("weight") / rate)


def fit(docs: DataFrame, labels: DataFrame, learn_from: Column, sample_rows: int | None = None, sample_words: int | None = None) -> Network | None:
    """A calibrated network from all labelled documents that ``learn_from`` admits; None without both labels.

    ``labels`` has ``doc_id`` and ``label``; ``learn_from`` is a condition on ``doc_id``.
    Only a caller who gives a number of rows or words has a sample of that size
    learned from, words on the driver; counts and thresholds then are the sample's.
    """
    marks = one_label(labels, "label").where(learn_from)
    rows = labelled(docs, marks) if sample_rows is None else sample(docs, marks, sample_rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in sliced(batches):
            texts = part.column("text").to_pylist()
            hashes, owner = words(texts)
            ends = np.cumsum(np.bincount(owner, minlength=len(texts)))[:-1]
            found = [rows.astype(np.int32).tobytes() for rows in np.split(table_row(hashes), ends)]
            spoken = languages(hashes, owner, len(texts))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(found, pa.binary()), pa.array(spoken, pa.int64()), part.column("label"), part.column("weight")],
                names=["doc_id", "words", "language", "label", "weight"],
            )

    typed = rows.select("doc_id", "text", F.col("label").cast("double").alias("label"), F.col("weight").cast("double").alias("weight"))
    taken = cut_lineage(typed.mapInArrow(run, "doc_id long, words binary, language long, label double, weight double"))
    if sample_words is not None:
        taken = cut_lineage(within_words(taken, sample_words))
    back = share(BACK_SEED) < 0.2
    counts = {(row["back"], row["toxic"]): row["count"] for row in taken.groupBy(back.alias("back"), (F.col("label") > 0).alias("toxic")).count().collect()}
    n_toxic, n_clean = (sum(n for (_, toxic), n in counts.items() if toxic == label) for label in (True, False))
    if not (n_toxic and n_clean):
        return None
    learned = held = taken
    if len(counts) == 4:
        learned, held = taken.where(~back), taken.where(back)
        n_toxic, n_clean = counts[False, True], counts[False, False]
    if sample_words is not None:
        own = sorted(learned.select("doc_id", "words", "label").collect(), key=lambda row: (row["doc_id"], row["words"]))
        net = train([np.frombuffer(row["words"], np.int32) for row in own], np.array([row["label"] > 0 for row in own], float))
    else:
        key = F.xxhash64("doc_id", "words", F.lit(DEAL_SEED))
        learners = -(-(n_toxic + n_clean) // LEARNER_ROWS)
        dealt = learned.select("doc_id", "words", "label", key.alias("key")).repartition(learners, "key").sortWithinPartitions("key", "doc_id", "words")
        net = train_on_all(cut_lineage(dealt.select("words", "label")), n_toxic, n_clean)
    calibrate(net, held)
    return net


def calibrate(net: Network, held: DataFrame) -> None:
    """Thresholds and temperature from the counts of all held-back rows by language, label and logit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in sliced(batches, "words"):
            texts, labels = word_rows(part)
            owner = np.repeat(np.arange(len(texts)), [len(text) for text in texts])
            logits = net.logits(*layout(np.concatenate(texts), owner, len(texts)))
            grains = np.floor(np.clip(logits, -FARTHEST, FARTHEST) * GRAIN).astype(np.int64)
            yield pa.RecordBatch.from_arrays([part.column("language"), pa.array(labels), pa.array(grains), part.column("weight")], names=["language", "label", "grain", "weight"])

    told = held.select("language", "label", "words", "weight").mapInArrow(run, "language long, label double, grain long, weight double")
    rows = told.groupBy("language", "label", "grain").agg(F.count("*").alias("n"), F.sum("weight").alias("weight")).orderBy("language", "grain", "label").toPandas()
    logits, labels = (rows["grain"].to_numpy() + 0.5) / GRAIN, rows["label"].to_numpy()
    spoken, n, weights = (rows[name].to_numpy() for name in ("language", "n", "weight"))
    net.thresholds[:] = best_threshold(logits, labels, weights)
    for language in range(len(LANGUAGES)):
        own = spoken == language
        if n[own].sum() >= LEAST_ROWS and (n * labels)[own].sum() >= LEAST_TOXIC:
            net.thresholds[language] = best_threshold(logits[own], labels[own], weights[own])
    net.divisor = temperature(logits - net.thresholds[spoken], labels, weights)


def score(docs: DataFrame, net: Network | None) -> DataFrame:
    """``row`` (all columns of the input) and ``score`` of every document. No shuffle."""
    rows = struct_of(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in sliced(batches, text_of):
            made = net.scores(text_of(part).to_pylist()) if net else np.zeros(part.num_rows)
            yield pa.RecordBatch.from_arrays([part.column("row"), pa.array(made.astype(float), pa.float64())], names=["row", "score"])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields]).add("score", "double"))
