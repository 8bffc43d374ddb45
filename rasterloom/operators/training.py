"""Classifiers trained epoch by epoch: gradients are added up where the pixels are, steps are taken on the driver.

A network is one linear layer or more, with values below zero cut between them
and a softmax at the end. One pass over the images serves all candidates (one
per penalty): it adds up their gradients over the training rows and their
metrics over both splits. Pixels stay bytes until a batch is worked on.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from rasterloom.functions import kernels
from rasterloom.functions.batches import gray_stacks
from rasterloom.functions.checks import positive_int
from rasterloom.functions.sums import vector_sum
from rasterloom.operators.manifest import has_label
from rasterloom.operators.models import bounded_model

# Constants of the Adam step, and the least probability a loss is taken from.
MEAN_DECAY, SQUARE_DECAY, TINY = 0.9, 0.999, 1e-8
LEAST_PROBABILITY = 1e-7

# What a pass counts per candidate and split: rows, hits, sum of losses.
COUNTS = 3
STATE = "epoch int, candidate int, name string, shape array<int>, vals binary"


@dataclass(frozen=True)
class Network:
    """Weights and bias of each layer, first to last; ``history`` has one entry per epoch."""

    arrays: tuple[np.ndarray, ...]
    height: int
    width: int
    history: list = field(default_factory=list, compare=False)

    @property
    def bias(self) -> np.ndarray:
        return self.arrays[-1]

    def widened(self, classes: int) -> Network:
        """With at least ``classes`` classes; those added are never chosen."""
        more = max(0, classes - len(self.bias))
        weights = np.concatenate([self.arrays[-2], np.zeros((more, self.arrays[-2].shape[1]))])
        last = (weights, np.concatenate([self.bias, np.full(more, -np.inf)]))
        return Network((*self.arrays[:-2], *last), self.height, self.width, self.history)


@dataclass(frozen=True)
class Plan:
    """Settings of a training run. ``hidden`` is the size of the layer between pixels and classes, None for none.

    ``patience`` ends a candidate after so many epochs without a better monitored
    metric: accuracy on the validation rows, or on the training rows without any.
    """

    epochs: int = 20
    rate: float = 0.01
    penalties: tuple[float, ...] = (0.0,)
    hidden: int | None = None
    patience: int | None = None
    adam: bool = True
    seed: int = 42

    def __post_init__(self):
        positive_int(self.epochs, "epochs")
        if not self.penalties or min(self.penalties) < 0 or self.rate <= 0:
            raise ValueError("penalties must not be negative or none, and the rate must be positive")
        for name in ("hidden", "patience"):
            if getattr(self, name) is not None:
                positive_int(getattr(self, name), name)


def first_arrays(classes: int, pixels: int, plan: Plan) -> tuple[np.ndarray, ...]:
    """Zeros for a linear model; small random weights, the same for a seed, below a hidden layer."""
    if plan.hidden is None:
        return np.zeros((classes, pixels)), np.zeros(classes)
    rng = np.random.default_rng(plan.seed)
    below = rng.normal(0, (2 / pixels) ** 0.5, (plan.hidden, pixels))
    above = rng.normal(0, (1 / plan.hidden) ** 0.5, (classes, plan.hidden))
    return below, np.zeros(plan.hidden), above, np.zeros(classes)


def flat(arrays) -> np.ndarray:
    return np.concatenate([np.ravel(each) for each in arrays])


def unflat(values: np.ndarray, like) -> tuple[np.ndarray, ...]:
    ends = np.cumsum([each.size for each in like])
    return tuple(part.reshape(each.shape) for part, each in zip(np.split(values, ends[:-1]), like))


def epoch_sums(rows: DataFrame, candidates: list[tuple[np.ndarray, ...]], height: int, width: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Of every candidate: its summed gradient over training rows, and rows, hits and losses of training and validation rows.

    ``rows`` has ``label_idx``, ``processed_bytes`` and ``held`` (a validation
    row). Rows of another shape, without a label or of a label beyond the
    classes are left out.
    """
    shared = rows.sparkSession.sparkContext.broadcast(candidates)
    sizes = [sum(each.size for each in arrays) + 2 * COUNTS for arrays in candidates]
    starts = np.cumsum(sizes) - sizes

    def start():
        held_candidates = shared.value

        def add(batch: pa.RecordBatch, total: np.ndarray) -> None:
            labels = batch.column("label_idx").fill_null(-1).to_numpy(zero_copy_only=False)
            held = batch.column("held").to_numpy(zero_copy_only=False)
            for numbers, stack in gray_stacks(batch, "processed_bytes", height, width):
                pixels = stack.reshape(len(numbers), -1) / 255.0
                for arrays, at, size in zip(held_candidates, starts, sizes):
                    own = labels[numbers]
                    fits = (own >= 0) & (own < len(arrays[-1]))
                    add_one(arrays, pixels[fits], own[fits].astype(int), held[numbers][fits], total[at : at + size])

        return add

    try:
        total = vector_sum(rows.select("label_idx", "processed_bytes", "held"), int(sum(sizes)), start)
    finally:
        shared.destroy()
    parts = [total[at : at + size] for at, size in zip(starts, sizes)]
    return [(part[: -2 * COUNTS], part[-2 * COUNTS :].reshape(2, COUNTS)) for part in parts]


def add_one(arrays: tuple[np.ndarray, ...], pixels: np.ndarray, labels: np.ndarray, held: np.ndarray, total: np.ndarray) -> None:
    """Add one batch's gradient (of training rows) and counts of one candidate."""
    inputs, scores = kernels.layer_inputs(pixels, arrays)
    probs = kernels.softmax(scores)
    chosen = probs[np.arange(len(labels)), labels]
    hit, loss = probs.argmax(axis=1) == labels, -np.log(np.maximum(chosen, LEAST_PROBABILITY))
    counts = total[-2 * COUNTS :].reshape(2, COUNTS)
    for split, of_split in enumerate((~held, held)):
        counts[split] += of_split.sum(), hit[of_split].sum(), loss[of_split].sum()
    back = probs.copy()
    back[np.arange(len(labels)), labels] -= 1
    back[held] = 0
    at = len(total) - 2 * COUNTS
    for i in range(len(inputs) - 1, -1, -1):
        weights = arrays[2 * i]
        at -= len(weights)
        total[at : at + len(weights)] += back.sum(axis=0)
        at -= weights.size
        total[at : at + weights.size] += np.ravel(back.T @ inputs[i])
        back = (back @ weights) * (inputs[i] > 0) if i else back


def metrics(counts: np.ndarray) -> dict[str, float | None]:
    """Accuracy and mean loss of both splits; None for a split without rows."""
    made = {}
    for name, (rows, hits, loss) in zip(("", "val_"), counts.tolist()):
        made |= {f"{name}accuracy": hits / rows if rows else None, f"{name}loss": loss / rows if rows else None}
    return made


@dataclass
class Candidate:
    """One penalty's parameters as they are trained, the best so far, and what Adam remembers."""

    arrays: tuple[np.ndarray, ...]
    penalty: float
    best: tuple[np.ndarray, ...] | None = None
    best_metric: float = -np.inf
    waited: int = 0
    steps: int = 0
    mean: np.ndarray | None = None
    square: np.ndarray | None = None

    def step(self, gradient: np.ndarray, rows: float, plan: Plan) -> None:
        """Down the gradient of mean loss and penalty; biases are not penalised."""
        pull = flat([each * self.penalty if each.ndim > 1 else np.zeros(each.shape) for each in self.arrays])
        gradient = gradient / rows + pull
        self.steps += 1
        if plan.adam:
            self.mean = MEAN_DECAY * (0 if self.mean is None else self.mean) + (1 - MEAN_DECAY) * gradient
            self.square = SQUARE_DECAY * (0 if self.square is None else self.square) + (1 - SQUARE_DECAY) * gradient**2
            gradient = (self.mean / (1 - MEAN_DECAY**self.steps)) / (np.sqrt(self.square / (1 - SQUARE_DECAY**self.steps)) + TINY)
        self.arrays = unflat(flat(self.arrays) - plan.rate * gradient, self.arrays)

    def judge(self, metric: float) -> None:
        if metric > self.best_metric:
            self.best, self.best_metric, self.waited = self.arrays, metric, 0
        else:
            self.waited += 1

    def ended(self, plan: Plan) -> bool:
        return plan.patience is not None and self.waited >= plan.patience


def train(
    train_rows: DataFrame, val_rows: DataFrame, classes: int, height: int, width: int, plan: Plan = Plan(), state_path: str | None = None,
) -> Network:
    """The candidate with the best monitored epoch, with the weights of that epoch; ties go to the earlier penalty and epoch.

    One pass per epoch: it gives the metrics of the epoch before and the
    gradient of the next. With a ``state_path`` every epoch is stored there,
    and a run that was cut off goes on after the last stored epoch.
    """
    spark = train_rows.sparkSession
    first = first_arrays(classes, height * width, plan)
    bounded_model(4 * len(plan.penalties) * sum(each.size for each in first), "candidates")
    candidates, history, done = [Candidate(first, float(penalty)) for penalty in plan.penalties], [], 0
    if state_path and (stored := load_state(spark, state_path, candidates)) is not None:
        done, history = stored
    columns = ["label_idx", "processed_bytes"]
    train_part, val_part = (has_label(rows).select(*columns).withColumn("held", F.lit(held)) for rows, held in ((train_rows, False), (val_rows, True)))
    rows = train_part.unionByName(val_part)
    for epoch in range(done, plan.epochs + 1):
        going = [c for c in candidates if not c.ended(plan)]
        if not going:
            break
        for candidate, (gradient, counts) in zip(going, epoch_sums(rows, [c.arrays for c in going], height, width)):
            if not counts[0][0]:
                raise ValueError("no labelled training images of this shape")
            found = metrics(counts)
            if epoch:
                history.append({"epoch": epoch, "penalty": candidate.penalty, **found})
                candidate.judge(found["accuracy"] if found["val_accuracy"] is None else found["val_accuracy"])
            if epoch < plan.epochs and not candidate.ended(plan):
                candidate.step(gradient, counts[0][0], plan)
        if state_path:
            save_state(spark, state_path, epoch + 1, candidates, history)
    chosen = max(candidates, key=lambda c: c.best_metric)
    return Network(chosen.best, height, width, history)


def save_state(spark: SparkSession, path: str, epoch: int, candidates: list[Candidate], history: list[dict]) -> None:
    """All candidates after an epoch as one small table of its own folder."""
    rows = []
    for number, candidate in enumerate(candidates):
        counters = np.array([candidate.best_metric, candidate.waited, candidate.steps], float)
        named = {"counters": counters, "mean": candidate.mean, "square": candidate.square}
        named |= {f"arrays_{i}": each for i, each in enumerate(candidate.arrays)}
        named |= {f"best_{i}": each for i, each in enumerate(candidate.best or ())}
        rows += [(epoch, number, name, list(values.shape), bytearray(np.ascontiguousarray(values, float).tobytes())) for name, values in named.items() if values is not None]
    told = [[np.nan if entry[name] is None else entry[name] for name in HISTORY] for entry in history]
    rows.append((epoch, -1, "history", [len(history), len(HISTORY)], bytearray(np.array(told, float).tobytes())))
    spark.createDataFrame(rows, STATE).coalesce(1).write.mode("overwrite").parquet(f"{path}/state-{epoch:06d}")


HISTORY = ("epoch", "penalty", "accuracy", "loss", "val_accuracy", "val_loss")


def load_state(spark: SparkSession, path: str, candidates: list[Candidate]) -> tuple[int, list[dict]] | None:
    """Fill the candidates from the newest whole epoch; how many passes are done, and the history."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return None
    names = sorted(entry.getPath().getName() for entry in fs.listStatus(folder))
    whole = [name for name in names if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{name}/_SUCCESS"))]
    if not whole:
        return None
    held = {(row["candidate"], row["name"]): np.frombuffer(row["vals"]).reshape(row["shape"]).copy() for row in spark.read.parquet(f"{path}/{whole[-1]}").collect()}
    if {number for number, _ in held} - {-1} != set(range(len(candidates))):
        raise ValueError(f"{path} holds another run")
    for number, candidate in enumerate(candidates):
        arrays, best = (tuple(held[number, f"{part}_{i}"] for i in range(len(candidate.arrays)) if (number, f"{part}_{i}") in held) for part in ("arrays", "best"))
        if [each.shape for each in arrays] != [each.shape for each in candidate.arrays]:
            raise ValueError(f"{path} holds a model of another shape")
        candidate.arrays, candidate.best = arrays, best or None
        metric, waited, steps = held[number, "counters"]
        candidate.best_metric, candidate.waited, candidate.steps = float(metric), int(waited), int(steps)
        candidate.mean, candidate.square = held.get((number, "mean")), held.get((number, "square"))
    told = [dict(zip(HISTORY, [None if np.isnan(value) else value for value in entry])) for entry in held[-1, "history"].tolist()]
    return int(whole[-1].rsplit("-", 1)[1]), [{**entry, "epoch": int(entry["epoch"])} for entry in told]
