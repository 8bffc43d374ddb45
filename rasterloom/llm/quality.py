"""Document quality from random-indexing word vectors and a small network.

A token is a run of letters, of digits or of other signs. It has a random index
vector, fixed by its hash: a few entries of +1 or -1. A token's word vector is
the sum, over the whole corpus, of the index vectors of its neighbours within
two places, of their shapes (case, digits or sign), and of a mark where the
neighbour is the same token. Tokens share ``ROWS`` vectors by hash, so the table
does not grow with the vocabulary; with a larger vocabulary words share one. A document is the mean and the spread
of its tokens' vectors and its length.

A two-layer network in numpy learns the label from a bounded sample, and a
temperature fitted on held-back rows calibrates its probabilities.

Null and empty texts pool to zeros and are scored like any other. Without
labelled rows of both kinds every score is 0.5. Where labels of one id disagree
the larger one counts; every row of a repeated id is learned from and scored; a
score of exactly 0.5 is predicted 1; further columns pass through in ``row``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from rasterloom.llm.texts import grouped, joined, mixed, pieces, run_hashes, sliced, struct_of, text_of, whole_text
from rasterloom.llm.training import block_sums, one_label, sample, sigmoid, temperature

# Labelled documents to learn from at most.
SAMPLE_ROWS = 12_000
ROWS, WIDTH, REACH, ENTRIES = 1 << 14, 64, 2, 2
# Tokens whose vectors are gathered at once.
TOKENS = 1 << 12
HIDDEN, EPOCHS, BATCH, RATE, DECAY = 32, 60, 128, 0.003, 1e-4

_KIND = np.full(256, 3, np.uint8)  # other signs
_KIND[list(b" \t\n\v\f\r")] = 0
_KIND[48:58] = 2
_KIND[65:91] = _KIND[97:123] = _KIND[128:] = 1
_UPPER = np.zeros(256, np.int64)
_UPPER[65:91] = 1
SAME = np.array([0x5A3E], np.uint64)


def tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash and shape of every token and the text it is from."""
    data, begins = joined(texts)
    kind = _KIND[data]
    edges = np.flatnonzero(np.diff(kind, prepend=0, append=0))
    starts, ends = edges[:-1], edges[1:]
    held = kind[starts] > 0 if len(starts) else np.zeros(0, bool)
    starts, ends = starts[held], ends[held]
    upper = np.zeros(len(data) + 1, np.int64)
    np.cumsum(_UPPER[data], out=upper[1:])
    raised = upper[ends] - upper[starts]
    hashes = run_hashes(data, starts, ends)
    case = np.where(raised == 0, 0, np.where(raised * 2 > ends - starts, 2, 1)).astype(np.uint64)
    shape = np.where(kind[starts] == 1, case, np.where(kind[starts] == 2, np.uint64(3), hashes | np.uint64(4)))
    return hashes, mixed(shape + np.uint64(77)), np.searchsorted(begins, starts, "right") - 1


def table_row(hashes: np.ndarray) -> np.ndarray:
    return (hashes % np.uint64(ROWS)).astype(np.int64)


def entries(units: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places and signs of each unit's random index vector."""
    for i in range(ENTRIES):
        bits = units >> np.uint64(16 * i)
        yield (bits % np.uint64(WIDTH)).astype(np.int64), 1.0 - 2.0 * ((bits >> np.uint64(12)) & np.uint64(1)).astype(float)


def add_contexts(texts: list[str], table: np.ndarray) -> None:
    """Add the index vectors of all neighbours of every token to the token's row of the flat table."""
    hashes, shapes, owner = tokens([text.encode() for text in texts])
    base = table_row(hashes) * WIDTH
    same = mixed(SAME)
    for step in range(1, REACH + 1):
        together = owner[:-step] == owner[step:]
        repeat = together & (hashes[:-step] == hashes[step:])
        for here, there in ((slice(None, -step), slice(step, None)), (slice(step, None), slice(None, -step))):
            for units in (hashes, shapes):
                for place, sign in entries(units[there][together]):
                    np.add.at(table, base[here][together] + place, sign)
            for place, sign in entries(same):
                np.add.at(table, base[here][repeat] + place, np.full(int(repeat.sum()), sign[0]))


def word_vectors(docs: DataFrame) -> np.ndarray:
    """The table of word vectors, a row per token hash, each of length one, from the whole corpus."""

    def measure():
        def add(batch: pa.RecordBatch, total: np.ndarray) -> None:
            for part in sliced(iter([batch])):
                add_contexts(part.column("text").to_pylist(), total)

        return add

    sums = block_sums(docs.select(whole_text().alias("text")), ROWS * WIDTH, measure).reshape(ROWS, WIDTH)
    norms = np.linalg.norm(sums, axis=1, keepdims=True)
    return (sums / np.where(norms > 0, norms, 1)).astype(np.float32)


def pooled(texts: list[str], vectors: np.ndarray) -> np.ndarray:
    """Mean and spread of the word vectors and the length of every text.

    Vectors are gathered for a few thousand tokens at a time, and long texts
    are tokenised in pieces cut at blanks, so neither needs memory for all.
    """
    sums = np.zeros((len(texts), 2 * WIDTH))
    counts = np.zeros(len(texts), np.int64)
    encoded = [piece for i, text in enumerate(texts) for piece in pieces(text.encode(), i)]
    for some in grouped(encoded):
        hashes, _, part = tokens([piece for _, piece in some])
        owner = np.array([i for i, _ in some])[part]
        counts += np.bincount(owner, minlength=len(texts))
        rows = table_row(hashes)
        for at in range(0, len(rows), TOKENS):
            each, own = vectors[rows[at : at + TOKENS]], owner[at : at + TOKENS]
            firsts = np.flatnonzero(np.diff(own, prepend=-1))
            sums[own[firsts], :WIDTH] += np.add.reduceat(each, firsts, axis=0)
            np.multiply(each, each, out=each)
            sums[own[firsts], WIDTH:] += np.add.reduceat(each, firsts, axis=0)
    found = np.zeros((len(texts), 2 * WIDTH + 1), np.float32)
    sums /= np.maximum(counts, 1)[:, None]
    found[:, :WIDTH] = sums[:, :WIDTH]
    found[:, WIDTH:-1] = np.sqrt(np.maximum(sums[:, WIDTH:] - sums[:, :WIDTH] ** 2, 0))
    found[:, -1] = np.log1p(counts)
    return found


@dataclass
class Network:
    """Standardising shifts and scales, two layers, and the temperature."""

    shift: np.ndarray
    scale: np.ndarray
    first: np.ndarray
    bias: np.ndarray
    out: np.ndarray
    constant: float
    divisor: float = 1.0

    def logits(self, features: np.ndarray) -> np.ndarray:
        hidden = np.tanh((features - self.shift) * self.scale @ self.first + self.bias)
        return hidden @ self.out + self.constant

    def probabilities(self, features: np.ndarray) -> np.ndarray:
        return sigmoid(self.logits(features) / self.divisor)


def train(features: np.ndarray, labels: np.ndarray, weights: np.ndarray, seed: int = 1) -> Network:
    """Fit by Adam on weighted log loss."""
    rng = np.random.default_rng(seed)
    spread = features.std(axis=0)
    net = Network(features.mean(axis=0), 1 / np.where(spread > 1e-6, spread, 1), rng.normal(0, features.shape[1] ** -0.5, (features.shape[1], HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN**-0.5, HIDDEN), 0.0)
    weights = weights / weights.mean()
    given = (features - net.shift) * net.scale
    values = [net.first, net.bias, net.out, np.zeros(1)]
    means, squares = [np.zeros_like(v) for v in values], [np.zeros_like(v) for v in values]
    step = 0
    for epoch in range(EPOCHS):
        order = rng.permutation(len(given))
        for at in range(0, len(order), BATCH):
            some = order[at : at + BATCH]
            hidden = np.tanh(given[some] @ values[0] + values[1])
            error = (sigmoid(hidden @ values[2] + values[3][0]) - labels[some]) * weights[some] / len(some)
            back = error[:, None] * values[2] * (1 - hidden * hidden)
            grads = [given[some].T @ back + DECAY * values[0], back.sum(axis=0), hidden.T @ error + DECAY * values[2], np.array([error.sum()])]
            step += 1
            for value, grad, mean, square in zip(values, grads, means, squares):
                mean += 0.1 * (grad - mean)
                square += 0.001 * (grad * grad - square)
                value -= RATE * (1 - epoch / EPOCHS) * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    net.constant = float(values[3][0])
    return net


def fit(docs: DataFrame, labels: DataFrame, learn_from: Column, sample_rows: int = SAMPLE_ROWS) -> tuple[np.ndarray, Network | None]:
    """Word vectors of all documents and a calibrated network from the labelled ones that ``learn_from`` admits."""
    vectors = word_vectors(docs)
    rows = sample(docs, one_label(labels, "label").where(learn_from), sample_rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in sliced(batches):
            made = [each.tobytes() for each in pooled(part.column("text").to_pylist(), vectors)]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(made, pa.binary()), part.column("label"), part.column("weight")], names=["doc_id", "features", "label", "weight"])

    typed = rows.select("doc_id", "text", F.col("label").cast("double").alias("label"), F.col("weight").cast("double").alias("weight"))
    taken = typed.mapInArrow(run, "doc_id long, features binary, label double, weight double").collect()
    taken.sort(key=lambda row: (row["doc_id"], row["features"]))
    marks = np.array([row["label"] > 0 for row in taken], float)
    if not 0 < marks.sum() < len(taken):
        return vectors, None
    features = np.stack([np.frombuffer(row["features"], np.float32) for row in taken]).astype(float)
    weights = np.array([row["weight"] for row in taken])
    back = np.arange(len(taken)) % 5 == 0
    if not 0 < marks[~back].sum() < (~back).sum():
        back[:] = False
    net = train(features[~back], marks[~back], weights[~back])
    net.divisor = temperature(net.logits(features[back]), marks[back], weights[back])
    return vectors, net


def score(docs: DataFrame, vectors: np.ndarray, net: Network | None) -> DataFrame:
    """``row`` (all columns of the input) and ``score`` of every document. No shuffle."""
    rows = struct_of(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in sliced(batches, text_of):
            texts = text_of(part).to_pylist()
            made = net.probabilities(pooled(texts, vectors)) if net else np.full(len(texts), 0.5)
            yield pa.RecordBatch.from_arrays([part.column("row"), pa.array(made.astype(float), pa.float64())], names=["row", "score"])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields]).add("score", "double"))
