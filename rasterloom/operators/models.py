"""Models fitted as Spark jobs on silver pixels.

A classifier is a linear softmax (weights, bias); a reconstructor is a mean
image plus orthonormal components. Both are small: classes or components times
pixels, whatever the number of images.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, functions as F, types as T

from rasterloom.functions.batches import gray_stacks, with_kernel
from rasterloom.functions.sums import vector_sum
from rasterloom.operators.manifest import has_label, normal_only
from rasterloom.operators.statistics import best_epoch, evaluate

# Largest model that may be gathered on the driver and broadcast to executors.
MODEL_BYTES = 1 << 30
# Directions that a search for components carries beyond those asked for.
SPARE = 8


@dataclass(frozen=True)
class SoftmaxModel:
    """``softmax(x · weightsᵀ + bias)`` over pixels scaled to 0..1."""

    weights: np.ndarray
    bias: np.ndarray
    height: int
    width: int
    history: list = field(default_factory=list)

    @property
    def arrays(self) -> tuple[np.ndarray, np.ndarray]:
        return self.weights, self.bias

    def widened(self, classes: int) -> SoftmaxModel:
        """With at least ``classes`` classes; those added are never chosen."""
        more = max(0, classes - len(self.bias))
        weights = np.concatenate([self.weights, np.zeros((more, self.weights.shape[1]))])
        return SoftmaxModel(weights, np.concatenate([self.bias, np.full(more, -np.inf)]), self.height, self.width, self.history)


@dataclass(frozen=True)
class Reconstructor:
    """``mean + components · componentsᵀ (x - mean)``; without components, the mean."""

    mean: np.ndarray
    components: np.ndarray
    height: int
    width: int

    @property
    def arrays(self) -> tuple[np.ndarray, np.ndarray]:
        return self.mean, self.components


def bounded_model(values: int, what: str) -> None:
    """Fail before a model too large for one process is gathered."""
    if values * 8 > MODEL_BYTES:
        raise ValueError(f"{what} of {values} values exceeds {MODEL_BYTES} bytes")


def scaled_pixels(df: DataFrame, height: int, width: int, out: str = "x") -> DataFrame:
    """The pixels as an array of doubles in 0..1 in place of the bytes, null for another shape."""

    def start():
        def run(batch: pa.RecordBatch) -> list:
            made = [None] * batch.num_rows
            for rows, stack in gray_stacks(batch, "processed_bytes", height, width):
                for i, image in zip(rows, stack.reshape(len(rows), -1) / 255.0):
                    made[i] = image
            return [made]

        return run

    return with_kernel(df, [T.StructField(out, T.ArrayType(T.DoubleType()))], start, drop=("processed_bytes",))


def class_sums(df: DataFrame, height: int, width: int) -> DataFrame:
    """``(label_idx, images, mean)`` of the scaled pixels of each class.

    Each task adds up its images and emits one row per class it met; these
    partial sums are merged first in groups of tasks and then per class. No row
    of pixels is shuffled, and a dominant class is merged by many tasks.
    """
    size = height * width

    def partial(batches):
        sums: dict[int, np.ndarray] = {}
        counts: dict[int, int] = {}
        for batch in batches:
            labels = batch.column("label_idx").to_numpy(zero_copy_only=False)
            for rows, stack in gray_stacks(batch, "processed_bytes", height, width):
                flat = stack.reshape(len(rows), size)
                for label in np.unique(labels[rows]):
                    of_label = flat[labels[rows] == label]
                    sums[label] = sums.get(label, 0) + of_label.sum(axis=0, dtype=np.int64)
                    counts[label] = counts.get(label, 0) + len(of_label)
        if sums:
            keys = sorted(sums)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([int(k) for k in keys], pa.int32()),
                    pa.array([counts[k] for k in keys], pa.int64()),
                    pa.array([sums[k].astype(np.float64) for k in keys], pa.list_(pa.float64())),
                ],
                names=["label_idx", "images", "total"],
            )

    schema = "label_idx int, images long, total array<double>"
    partials = has_label(df).select("label_idx", "processed_bytes").mapInArrow(partial, schema)
    total = Summarizer.metrics("sum").summary(F.col("v")).getField("sum").alias("v")
    images = F.sum("images").alias("images")
    merged = (
        partials.select("label_idx", "images", array_to_vector("total").alias("v"))
        .withColumn("part", F.spark_partition_id() % 32)
        .groupBy("label_idx", "part").agg(images, total)
        .groupBy("label_idx").agg(images, total)
    )
    mean = F.transform(vector_to_array("v"), lambda s: s / F.col("images") / 255.0)
    return merged.select("label_idx", "images", mean.alias("mean"))


@dataclass(frozen=True)
class ClassMeans:
    """Mean scaled image of each class, the source of both simple models."""

    means: dict[int, np.ndarray]
    height: int
    width: int

    def classifier(self) -> SoftmaxModel:
        """Nearest-centroid softmax: class scores are minus the squared distance to the class mean.

        ``-|x-m|² = 2 m·x - |m|² - |x|²``, and the last term cancels in the softmax,
        so the model is linear. A label that never occurs scores minus infinity.
        """
        classes = max(self.means) + 1
        weights, bias = np.zeros((classes, self.height * self.width)), np.full(classes, -np.inf)
        for label, mean in self.means.items():
            weights[label], bias[label] = 2 * mean, -(mean @ mean)
        return SoftmaxModel(weights, bias, self.height, self.width)

    def reconstructor(self, label_idx: int) -> Reconstructor:
        """The class's mean image, a reconstructor without components."""
        if label_idx not in self.means:
            raise ValueError("no normal training images")
        return Reconstructor(self.means[label_idx], np.zeros((self.height * self.width, 0)), self.height, self.width)


def fit_class_means(df: DataFrame, height: int, width: int) -> ClassMeans:
    """Class means in one pass over the training images."""
    sums = class_sums(df, height, width).select("label_idx", "mean")
    # one row per class; one more than a model may hold is enough to refuse it
    most = MODEL_BYTES // (8 * height * width)
    rows = sums.limit(most + 1).collect()
    if not rows:
        raise ValueError("no labelled training images")
    bounded_model(max(len(rows), max(row["label_idx"] for row in rows) + 1) * height * width, "class means")
    return ClassMeans({row["label_idx"]: np.array(row["mean"]) for row in rows}, height, width)


def fit_reconstructor(
    train: DataFrame, label_idx: int, height: int, width: int, latent: int = 128,
    tolerance: float = 1e-7, most_rounds: int = 500, seed: int = 42,
) -> Reconstructor:
    """Principal components of the normal training images, by block Lanczos on their scatter.

    Each round is one pass in which every task adds up its share of ``Xᵀ(XQ)``
    for the newest block of directions, and all blocks so far span the search.
    It ends when every wanted component is an eigenvector of the scatter but for
    ``tolerance`` of the largest eigenvalue, or when the blocks span all pixels,
    where the answer is exact. The same holds for images of any size. Not having
    got there within ``most_rounds`` is an error, not an approximate result.
    """
    normal = normal_only(train, label_idx)
    mean = fit_class_means(normal, height, width).reconstructor(label_idx).mean
    size = height * width
    latent = min(latent, size)
    block = min(latent + SPARE, size)
    bounded_model(2 * size * block, "components")
    newest = np.linalg.qr(np.random.default_rng(seed).standard_normal((size, block)))[0]
    spanned, images = newest, np.zeros((size, 0))
    for _ in range(most_rounds):
        images = np.concatenate([images, _covariance_times(normal, mean, newest, height, width)], axis=1)
        share, turn = np.linalg.eigh(_symmetric(spanned.T @ images))
        best = np.argsort(-share)[:block]
        share, found, mapped = share[best], spanned @ turn[:, best], images @ turn[:, best]
        rest = np.linalg.norm(mapped[:, :latent] - found[:, :latent] * share[:latent], axis=0)
        if spanned.shape[1] == size or rest.max() <= tolerance * max(share[0], 1e-300):
            return Reconstructor(mean, found[:, :latent], height, width)
        if (spanned.shape[1] + block) * size * 16 > MODEL_BYTES:
            # start again from the best directions when the span has become too large to hold
            spanned, images = found, mapped
        newest = _new_directions(images[:, -block:], spanned, size, seed)
        spanned = np.concatenate([spanned, newest], axis=1)
    raise ValueError(f"components not found to {tolerance} in {most_rounds} rounds")


def _symmetric(matrix: np.ndarray) -> np.ndarray:
    return (matrix + matrix.T) / 2


def _new_directions(images: np.ndarray, spanned: np.ndarray, size: int, seed: int) -> np.ndarray:
    """Orthonormal directions outside the span: those of the images, filled up with random ones."""
    room = min(images.shape[1], size - spanned.shape[1])
    noise = np.random.default_rng(seed + spanned.shape[1]).standard_normal((size, room))
    wanted = np.concatenate([images / max(np.abs(images).max(), 1e-300), 1e-9 * noise], axis=1)
    for _ in range(2):
        wanted = wanted - spanned @ (spanned.T @ wanted)
    directions, weight, _ = np.linalg.svd(wanted, full_matrices=False)
    directions = directions[:, :room]
    directions = directions - spanned @ (spanned.T @ directions)
    return np.linalg.qr(directions)[0]


def _covariance_times(df: DataFrame, mean: np.ndarray, basis: np.ndarray, height: int, width: int) -> np.ndarray:
    """``Σ (x-m)(x-m)ᵀ · basis`` over all images, one pass."""
    shared = df.sparkSession.sparkContext.broadcast((mean, basis))

    def start():
        centre, q = shared.value

        def add(batch: pa.RecordBatch, total: np.ndarray) -> None:
            for rows, stack in gray_stacks(batch, "processed_bytes", height, width):
                x = stack.reshape(len(rows), -1) / 255.0 - centre
                total += np.ravel(x.T @ (x @ q))

        return add

    try:
        return vector_sum(df.select("processed_bytes"), basis.size, start).reshape(basis.shape)
    finally:
        shared.destroy()


def fit_classifier(
    train: DataFrame,
    val: DataFrame,
    height: int,
    width: int,
    penalties: tuple[float, ...] = (0.0, 0.01, 0.1),
    max_iter: int = 100,
) -> SoftmaxModel:
    """Multinomial logistic regression; the penalty with the best validation accuracy wins.

    Every penalty is one entry of ``history`` (epoch, accuracy and loss), chosen
    by the same rule as the best epoch of a training run.
    """
    from rasterloom.operators.scoring import classify

    spark = train.sparkSession
    rows = scaled_pixels(has_label(train).select("label_idx", "processed_bytes"), height, width)
    vectors = rows.where(F.col("x").isNotNull()).select("label_idx", array_to_vector("x").alias("v"))
    fitted, history = [], []
    for epoch, penalty in enumerate(penalties):
        learner = LogisticRegression(
            featuresCol="v", labelCol="label_idx", family="multinomial", regParam=penalty, maxIter=max_iter
        )
        found = learner.fit(vectors)
        model = SoftmaxModel(found.coefficientMatrix.toArray(), found.interceptVector.toArray(), height, width)
        fitted.append(model)
        scores = evaluate(
            classify(has_label(val), model).withColumn("pred_idx", F.col("classifier_pred_idx"))
        ).first()
        # without validation rows the training order decides
        history.append((epoch, float(scores["accuracy"] or 0.0), float(scores["loss"] or 0.0), float(penalty)))
    runs = spark.createDataFrame(history, "epoch long, metric double, loss double, penalty double")
    best = best_epoch(runs.withColumn("run", F.lit("classifier"))).first()["best_epoch"]
    chosen = fitted[best]
    return SoftmaxModel(chosen.weights, chosen.bias, height, width, history)
