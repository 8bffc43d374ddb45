"""Language of documents by the nearest of several centroids per language.

A text is a vector of its one-, two- and three-byte sequences over lower-case
letters, hashed to a fixed number of places, weighted by inverse document
frequency and normalised. Document frequencies are counted over all documents
that may be learned from. Centroids come from a bounded sample, by spherical
k-means within each language. A text goes to the centroid with the greatest
cosine; it is ``rejected`` if it is farther from it than nearly all of the
documents the centroid was made from.

Null texts and texts without any letter are ``und`` with score 0. Without
documents to learn from all are. Equal cosines go to the first centroid in
order of language.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from rasterloom.llm.texts import joined, mixed, sliced, whole_text
from rasterloom.llm.training import block_sums, sample

# Documents that centroids are made from at most, in equal shares per language.
SAMPLE_ROWS = 3_000
PLACES, LENGTHS, CENTROIDS, ROUNDS = 1 << 12, (1, 2, 3), 3, 10
# Share of a centroid's own documents that may be rejected.
REJECTED_SHARE = 0.005
UNKNOWN = "und"

_LETTER = re.compile(r"[^\W\d_]")
_BYTE = np.zeros(256, np.uint64)
_BYTE[97:123] = np.arange(97, 123)
_BYTE[128:] = np.arange(128, 256)


def counts(texts: list[str]) -> np.ndarray:
    """Damped counts of the byte sequences of every text; runs of other signs are one boundary."""
    data, begins = joined([text.lower().encode() for text in texts])
    kinds = _BYTE[data]
    held = np.ones(len(data), bool)
    held[1:] = (kinds[1:] > 0) | (kinds[:-1] > 0)
    held[begins] = True
    kinds = kinds[held]
    owner = np.repeat(np.arange(len(texts)), np.diff(np.append(begins, len(data))))[held]
    found = np.zeros(len(texts) * PLACES)
    code = np.zeros(len(kinds), np.uint64)
    for n in LENGTHS:
        # extend every sequence by its next byte, within its text
        code = code[: len(kinds) - n + 1] * np.uint64(256) + kinds[n - 1 :]
        whole = owner[: len(code)] == owner[n - 1 :]
        places = (mixed(code + np.uint64(n << 32)) % np.uint64(PLACES)).astype(np.int64)
        found += np.bincount(owner[: len(code)][whole] * PLACES + places[whole], minlength=len(found))
    return np.log1p(found).reshape(len(texts), PLACES).astype(np.float32)


def normalised(vectors: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(vectors, axis=1, keepdims=True)
    return vectors / np.where(norms > 0, norms, 1)


@dataclass
class Model:
    weights: np.ndarray  # inverse document frequencies
    centroids: np.ndarray
    names: list[str]  # language of each centroid
    least: np.ndarray  # cosine below which each rejects

    def nearest(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, cosine and whether it is rejected."""
        cosines = normalised(counts(texts) * self.weights) @ self.centroids.T
        best = cosines.argmax(axis=1)
        top = cosines[np.arange(len(texts)), best]
        return [self.names[i] for i in best], np.clip(top, 0, 1), top < self.least[best]


def clusters(vectors: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Centroids of length one and the members' centroid, from spread-out first members."""
    picked = [0]
    while len(picked) < min(k, len(vectors)):
        closest = (vectors @ vectors[picked].T).max(axis=1)
        picked.append(int(closest.argmin()))
    centroids = vectors[picked]
    for _ in range(ROUNDS):
        member = (vectors @ centroids.T).argmax(axis=1)
        sums = np.stack([vectors[member == i].sum(axis=0) if (member == i).any() else centroids[i] for i in range(len(centroids))])
        centroids = normalised(sums)
    return centroids, (vectors @ centroids.T).argmax(axis=1)


def fit(docs: DataFrame, learn_from: Column, sample_rows: int = SAMPLE_ROWS) -> Model | None:
    """A model from texts and languages of the documents that ``learn_from`` (a condition on ``doc_id``) admits."""
    admitted = docs.where(learn_from & F.col("lang").isNotNull())
    texts = admitted.select(whole_text().alias("text"))

    def measure():
        def add(batch: pa.RecordBatch, total: np.ndarray) -> None:
            for part in sliced(iter([batch])):
                total[:-1] += (counts(part.column("text").to_pylist()) > 0).sum(axis=0)
                total[-1] += part.num_rows

        return add

    seen = block_sums(texts, PLACES + 1, measure, PLACES + 1)
    if not seen[-1]:
        return None
    weights = (np.log((1 + seen[-1]) / (1 + seen[:-1])) + 1).astype(np.float32)
    marks = admitted.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("lang").alias("label"))
    rows = sample(docs.where(learn_from), marks, sample_rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in sliced(batches):
            made = [each.astype(np.float16).tobytes() for each in normalised(counts(part.column("text").to_pylist()) * weights)]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("label"), pa.array(made, pa.binary())], names=["doc_id", "label", "vector"])

    taken = rows.select("doc_id", "text", "label").mapInArrow(run, "doc_id long, label string, vector binary").collect()
    taken.sort(key=lambda row: (row["label"], row["doc_id"], row["vector"]))
    centroids, names, least = [], [], []
    for name in sorted({row["label"] for row in taken}):
        vectors = np.stack([np.frombuffer(row["vector"], np.float16) for row in taken if row["label"] == name]).astype(np.float32)
        made, member = clusters(vectors, CENTROIDS)
        for i, centroid in enumerate(made):
            own = vectors[member == i] @ centroid
            centroids.append(centroid)
            names.append(name)
            least.append(float(np.quantile(own, REJECTED_SHARE)) if len(own) else 0.0)
    if not names:
        return None
    return Model(weights, np.stack(centroids).astype(np.float32), names, np.array(least))


PREDICTED = T.StructType().add("doc_id", "long").add("lang_pred", "string").add("score", "double").add("rejected", "boolean")


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """``doc_id``, ``lang_pred``, ``score`` and ``rejected`` of every document. No shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in sliced(batches):
            texts = part.column("text").to_pylist()
            lettered = np.array([model is not None and bool(_LETTER.search(text)) for text in texts])
            names, scores, rejected = model.nearest(texts) if model else ([UNKNOWN] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool))
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    pa.array([name if ok else UNKNOWN for name, ok in zip(names, lettered)], pa.string()),
                    pa.array(np.where(lettered, scores, 0.0).astype(float), pa.float64()),
                    pa.array(rejected | ~lettered, pa.bool_()),
                ],
                names=PREDICTED.names,
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text")).mapInArrow(run, PREDICTED)
