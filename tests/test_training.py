"""Training by epoch: gradients, steps, early stopping and resuming, and what is done with the networks."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from rasterloom.functions import kernels
from rasterloom.functions.sums import vector_sum
from rasterloom.operators import models, scoring, training
from rasterloom.operators.training import Network, Plan
from rasterloom.plans import jobs
from rasterloom.sources import model_tables

SIDE = 4
SCHEMA = "label_idx int, processed_bytes binary"


def picture(rng, label):
    """Left or right half bright, or both or none, which no linear model can tell apart as labels 0 and 1."""
    image = rng.integers(0, 40, (SIDE, SIDE))
    left, right = {0: (False, False), 1: (True, False), 2: (False, True), 3: (True, True)}[label]
    image[:, :2] += 200 * left
    image[:, 2:] += 200 * right
    return bytearray(image.astype(np.uint8).tobytes())


@pytest.fixture(scope="module")
def halves(spark):
    rng = np.random.default_rng(2)
    rows = [((k % 4 in (1, 2)) * 1, picture(rng, k % 4)) for k in range(120)] + [(None, picture(rng, 0)), (0, bytearray(3)), (7, picture(rng, 1))]
    return spark.createDataFrame(rows[:80] + rows[120:], SCHEMA).repartition(5), spark.createDataFrame(rows[80:120], SCHEMA)


def pixels_of(rows):
    held = [r for r in rows.collect() if r.label_idx in (0, 1) and len(r.processed_bytes) == SIDE * SIDE]
    return np.array([np.frombuffer(r.processed_bytes, np.uint8) for r in held]) / 255.0, np.array([r.label_idx for r in held])


def plain_loss(values, like, x, y):
    probs = kernels.class_probabilities(x, *training.unflat(values, like))
    return -np.log(probs[np.arange(len(y)), y]).sum()


@pytest.mark.parametrize("hidden", [None, 5])
def test_gradients_equal_finite_differences(spark, halves, hidden):
    rng = np.random.default_rng(3)
    like = training.first_arrays(2, SIDE * SIDE, Plan(hidden=hidden))
    arrays = tuple(each + rng.normal(0, 0.3, each.shape) for each in like)
    other = tuple(each + rng.normal(0, 0.3, each.shape) for each in like)
    rows = halves[0].withColumn("held", F.lit(False)).unionByName(halves[1].withColumn("held", F.lit(True)))
    (found, counts), (again, _) = training.epoch_sums(rows, [arrays, other], SIDE, SIDE)
    x, y = pixels_of(halves[0])
    for gradient, own in ((found, arrays), (again, other)):
        values, step = training.flat(own), 1e-6
        expected = [(plain_loss(values + step * e, own, x, y) - plain_loss(values - step * e, own, x, y)) / (2 * step) for e in np.eye(len(values))]
        assert np.allclose(gradient, expected, atol=1e-4)
    probs = kernels.class_probabilities(x, *arrays)
    assert counts[0].tolist()[:2] == [80, (probs.argmax(axis=1) == y).sum()] and counts[1][0] == 40
    assert np.isclose(counts[0][2], plain_loss(training.flat(arrays), arrays, x, y))


def test_full_batch_steps_equal_plain_steps(halves):
    plan = Plan(epochs=5, rate=0.3, penalties=(0.0, 0.1), adam=False)
    net = training.train(*halves, 2, SIDE, SIDE, plan)
    (x, y), (vx, vy) = map(pixels_of, halves)
    expected = []
    for penalty in plan.penalties:
        w, b = np.zeros((2, SIDE * SIDE)), np.zeros(2)
        for epoch in range(1, 6):
            back = (kernels.class_probabilities(x, w, b) - np.eye(2)[y]) / len(y)
            w, b = w - 0.3 * (back.T @ x + penalty * w), b - 0.3 * back.sum(axis=0)
            probs = kernels.class_probabilities(vx, w, b)
            expected.append((epoch, penalty, (probs.argmax(axis=1) == vy).mean(), w, b))
    told = {(h["epoch"], h["penalty"]): h["val_accuracy"] for h in net.history}
    assert told == {(e, p): pytest.approx(a) for e, p, a, _, _ in expected}
    best = max(expected, key=lambda e: (e[2], e[1] == 0.0, -e[0]))
    assert np.allclose(net.arrays[0], best[3]) and np.allclose(net.arrays[1], best[4])


def test_a_hidden_layer_learns_what_a_linear_model_cannot(halves):
    linear = training.train(*halves, 2, SIDE, SIDE, Plan(epochs=9, rate=0.05))
    hidden = training.train(*halves, 2, SIDE, SIDE, Plan(epochs=9, rate=0.05, hidden=32))
    best = lambda net: max(h["val_accuracy"] for h in net.history)
    assert best(hidden) == 1.0 > 0.8 > best(linear)


def test_patience_ends_a_run_and_keeps_the_best_epoch(halves):
    plan = Plan(epochs=14, rate=0.05, hidden=32, patience=2)
    net = training.train(*halves, 2, SIDE, SIDE, plan)
    told = [h["val_accuracy"] for h in net.history]
    assert len(told) < 14 and max(told[-2:]) <= max(told[:-2]) == max(told)
    x, y = pixels_of(halves[1])
    assert (kernels.class_probabilities(x, *net.arrays).argmax(axis=1) == y).mean() == max(told)


def test_a_run_goes_on_where_it_was_cut_off(halves, tmp_path, monkeypatch):
    plan = Plan(epochs=4, rate=0.05, penalties=(0.0, 0.01), hidden=3)
    whole = training.train(*halves, 2, SIDE, SIDE, plan)
    passes, real = [], training.epoch_sums

    def failing(*given):
        if len(passes) == 3:
            raise RuntimeError("lost")
        passes.append(1)
        return real(*given)

    monkeypatch.setattr(training, "epoch_sums", failing)
    with pytest.raises(RuntimeError):
        training.train(*halves, 2, SIDE, SIDE, plan, str(tmp_path / "state"))
    # a folder that was not finished does not count
    (tmp_path / "state" / "state-000009").mkdir()
    passes.clear()
    passes.extend([1] * 10)
    again = training.train(*halves, 2, SIDE, SIDE, plan, str(tmp_path / "state"))
    assert len(passes) == 12 and again.history == whole.history
    assert all(np.allclose(a, b) for a, b in zip(again.arrays, whole.arrays))
    with pytest.raises(ValueError, match="another shape"):
        training.train(*halves, 2, SIDE, SIDE, Plan(epochs=4, penalties=(0.0, 0.01), hidden=4), str(tmp_path / "state"))


def test_rows_without_use(spark, halves):
    empty = spark.createDataFrame([], SCHEMA)
    with pytest.raises(ValueError, match="no labelled"):
        training.train(empty, empty, 2, SIDE, SIDE, Plan(epochs=1))
    net = training.train(halves[0], empty, 2, SIDE, SIDE, Plan(epochs=2))
    assert net.history[0]["val_accuracy"] is None and net.history[0]["accuracy"] > 0
    for wrong in ({"epochs": 0}, {"penalties": ()}, {"penalties": (-1.0,)}, {"rate": 0}, {"hidden": 0}, {"patience": 0}):
        with pytest.raises(ValueError):
            Plan(**wrong)


def test_networks_are_stored_scored_and_explained(spark, halves, tmp_path):
    rng = np.random.default_rng(8)
    like = training.first_arrays(2, SIDE * SIDE, Plan(hidden=6))
    net = Network(tuple(each + rng.normal(0, 0.5, each.shape) for each in like), SIDE, SIDE)
    model_tables.save_classifier(spark, net, str(tmp_path / "net"))
    read = model_tables.load_classifier(spark, str(tmp_path / "net"))
    assert isinstance(read, Network) and all(np.array_equal(a, b) for a, b in zip(read.arrays, net.arrays))
    flat = models.SoftmaxModel(np.ones((2, SIDE * SIDE)), np.zeros(2), SIDE, SIDE)
    model_tables.save_classifier(spark, flat, str(tmp_path / "flat"))
    assert isinstance(model_tables.load_classifier(spark, str(tmp_path / "flat")), models.SoftmaxModel)
    rows = halves[1].withColumn("image_id", F.monotonically_increasing_id().cast("string"))
    x = np.array([np.frombuffer(r.processed_bytes, np.uint8) for r in rows.collect()]) / 255.0
    probs = kernels.class_probabilities(x, *net.arrays)
    scored = scoring.classify(rows, net.widened(3)).collect()
    assert np.allclose(sorted(r.classifier_confidence for r in scored), sorted(probs.max(axis=1)))
    # gradient of the best class by every pixel, through the hidden layer
    step, heat = 1e-6, kernels.saliency(x, probs, *net.arrays)
    for i in range(5):
        best = probs[i].argmax()
        moved = kernels.class_probabilities(x[i] + step * np.eye(x.shape[1]), *net.arrays)[:, best]
        grad = np.maximum((moved - probs[i, best]) / step * x[i], 0)
        assert np.allclose(heat[i], grad / max(grad.max(), 1e-30), atol=1e-3)
    assert scoring.artifacts(rows, net).where("gradcam IS NOT NULL").count() == len(x)


def test_vector_sums(spark):
    def start():
        def add(batch, total):
            for v in batch.column("id").to_pylist():
                total[v % len(total)] += v

        return add

    expected = np.zeros(40_000)
    np.add.at(expected, np.arange(3000) % 40_000, np.arange(3000))
    assert np.array_equal(vector_sum(spark.range(3000).repartition(200), 40_000, start), expected)
    assert not vector_sum(spark.range(0), 10, start).any()


def test_fit_trains_by_plan(spark, tmp_path):
    rng = np.random.default_rng(5)
    rows = [(f"i{k}", ("train", "val", "test")[k % 5 // 2 if k % 5 < 4 else 2], "_NORMAL" if k % 4 in (0, 3) else "A", int(k % 4 in (1, 2)), picture(rng, k % 4), "v1", "p", "s1") for k in range(100)]
    table = spark.createDataFrame(rows, "image_id string, split string, pathology string, label_idx int, processed_bytes binary, transform_version string, raw_path string, split_id string")
    table.withColumn("modality", F.lit("T1")).write.parquet(str(tmp_path / "manifest"))
    done = jobs.fit(spark, str(tmp_path / "manifest"), str(tmp_path / "models"), SIDE, SIDE, latent=2, plan=Plan(epochs=12, rate=0.05, hidden=32, patience=3))
    assert isinstance(model_tables.load_classifier(spark, str(tmp_path / "models/classifier.parquet")), Network)
    assert done["test_metrics"]["accuracy"] > 0.9 and 1 <= len(done["history"]) <= 12
