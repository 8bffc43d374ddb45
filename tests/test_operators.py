"""Operators beyond what the SQL comparison covers: properties, skew and edge cases."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from rasterloom.functions import checks, paths
from rasterloom.functions.labels import label_name
from rasterloom.operators import (
    images, manifest as manifests, models, requests as request_ops, sampling, scoring, splits, statistics, summary,
)
from rasterloom.session import broadcast_within


def ids(spark, n):
    return spark.range(n).select(F.sha2(F.col("id").cast("string"), 256).alias("image_id"))


# -- splits --------------------------------------------------------------------------------


def test_split_is_stable_and_near_its_ratio(spark):
    rows = ids(spark, 20000)
    first = splits.assign_split(rows).select("image_id", "split")
    again = splits.assign_split(rows.repartition(13).orderBy("image_id")).select("image_id", "split")
    assert first.exceptAll(again).count() == 0
    share = {r.split: r["count"] / 20000 for r in first.groupBy("split").count().collect()}
    assert abs(share["train"] - 0.7) < 0.02 and abs(share["val"] - 0.15) < 0.02


def test_growing_train_never_moves_a_row_out_of_it(spark):
    rows = ids(spark, 5000)
    small = splits.assign_split(rows, (0.5, 0.2, 0.3)).where("split = 'train'").select("image_id")
    large = splits.assign_split(rows, (0.8, 0.1, 0.1)).where("split = 'train'").select("image_id")
    assert small.exceptAll(large).count() == 0


def test_another_seed_gives_another_split(spark):
    rows = ids(spark, 1000)
    a, b = (splits.assign_split(rows, seed=s).withColumnRenamed("split", f"s{s}") for s in (1, 2))
    assert a.join(b, "image_id").where("s1 <> s2").count() > 100


def test_null_ids_are_refused(spark):
    rows = spark.createDataFrame([(None,), ("a",)], "image_id string")
    with pytest.raises(Exception, match="must not be null"):
        splits.assign_split(rows).collect()


def test_absent_split_counts_zero(spark):
    rows = spark.createDataFrame([("train",), ("train",)], "split string")
    got = {r.split: (r.rows, r.rows_total) for r in splits.counts_by_split(rows).collect()}
    assert got == {"train": (2, 2), "val": (0, 2), "test": (0, 2)}


# -- checks --------------------------------------------------------------------------------


def test_argument_checks():
    assert checks.split_ratios([0.7, 0.15, 0.15]) == (0.7, 0.15, 0.15)
    for bad in ([0.7, 0.3], [0.7, 0.3, 0.0], [1.0, 0.5, -0.5], [0.6, 0.15, 0.15], "a", ["x", 0.1, 0.1]):
        with pytest.raises(ValueError):
            checks.split_ratios(bad)
    assert checks.positive_int("8", "n") == 8
    for bad in (0, -1, "x", None):
        with pytest.raises(ValueError):
            checks.positive_int(bad, "n")
    assert checks.grey_level(255) == 255
    for bad in (-1, 256):
        with pytest.raises(ValueError):
            checks.grey_level(bad)
    assert checks.column_list(" a, ,b ") == ["a", "b"] == checks.column_list(["a", " b"])
    assert checks.column_list(None) == []
    with pytest.raises(ValueError):
        checks.column_list(3)
    assert [checks.yes_no(v, "f", False) for v in ("Yes", "0", True, None)] == [True, False, True, False]
    with pytest.raises(ValueError):
        checks.yes_no("maybe", "f", False)
    assert checks.name_or_none("  ") is None
    with pytest.raises(ValueError):
        images.TransformOptions(strategy="zoom")


def test_missing_columns_are_named_in_order(spark):
    with pytest.raises(ValueError, match="image_id, processed_bytes, split"):
        splits.export_rows(spark.range(1).select(F.lit(1).alias("label_idx"), F.lit("s").alias("split_id")), "e")


# -- manifest ------------------------------------------------------------------------------


def test_class_and_modality_rules(spark):
    cases = {
        "Glioma T1": ("Glioma", "T1"), "Glioma T1C+": ("Glioma", "T1C+"), "GliomaT1": ("GliomaT1", "T1"),
        "Glioma": ("Glioma", None), "T1": ("T1", "T1"), "_NORMAL T2": ("_NORMAL", "T2"), "A  T2": ("A", "T2"),
    }
    rows = spark.createDataFrame([(k,) for k in cases], "d string")
    got = {r.d: (r.p, r.m) for r in rows.select("d", paths.pathology(F.col("d")).alias("p"), paths.modality(F.col("d")).alias("m")).collect()}
    # blanks before the modality belong to neither, except those the greedy name keeps
    assert got.pop("A  T2")[0].strip() == "A" and cases.pop("A  T2")
    assert got == cases


def test_unmatched_class_has_a_null_label(spark):
    rows = spark.createDataFrame([("a", 1), ("b", 2)], "pathology string, x int")
    mapping = spark.createDataFrame([("a", 0)], "pathology string, label_idx int")
    got = {r.pathology: r.label_idx for r in manifests.attach_labels(rows, mapping).collect()}
    assert got == {"a": 0, "b": None}


def test_broadcast_only_within_its_bound(spark):
    mapping = spark.range(1000).select(F.col("id").cast("string").alias("pathology"), F.col("id").cast("int").alias("label_idx"))
    hinted = broadcast_within(mapping)
    plain = broadcast_within(mapping, limit=1000)
    rows = spark.range(10).select(F.col("id").cast("string").alias("pathology"))

    def logical(side):
        return rows.join(side, "pathology", "left")._jdf.queryExecution().analyzed().toString()

    assert "ResolvedHint" in logical(hinted) and "ResolvedHint" not in logical(plain)
    assert rows.join(plain, "pathology", "left").count() == 10


def test_labels_are_dense_in_byte_order(spark):
    rows = spark.createDataFrame([("b",), ("_x",), ("B",), ("",), (None,), ("b",)], "pathology string")
    got = [(r.pathology, r.label_idx) for r in manifests.label_mapping(rows).orderBy("label_idx").collect()]
    assert got == [("B", 0), ("_x", 1), ("b", 2)]


def test_ranked_labels_equal_the_mapping(spark):
    names = ["b", "_x", "B", "", None, "b", "é", "Z"]
    rows = spark.createDataFrame([(n, i) for i, n in enumerate(names)], "pathology string, i int")
    ranked = {r.pathology: r.label_idx for r in summary.index_labels(rows).collect()}
    joined = {r.pathology: r.label_idx for r in manifests.attach_labels(rows, manifests.label_mapping(rows)).collect()}
    assert ranked == joined and ranked[None] is None and ranked[""] is None


def test_request_id_is_carried(spark):
    columns = {c: F.lit(None).cast("string") for c in manifests.BRONZE}
    rows = spark.range(1).select(*[v.alias(k) for k, v in columns.items()], F.lit("r1").alias("request_id"))
    assert manifests.select_manifest(rows).columns == ["request_id", *manifests.BRONZE]


# -- summary -------------------------------------------------------------------------------


def test_image_spec_of_one_several_and_no_shape(spark):
    one = spark.createDataFrame([("train", 0, "a", 8, 8, 1), ("val", 0, "a", 8, 8, 1)], "split string, label_idx int, pathology string, new_height int, new_width int, channels int")
    assert tuple(summary.image_spec(summary.label_cells(one)).first()) == (8, 8, 1)
    two = one.withColumn("new_width", F.when(F.col("split") == "val", 9).otherwise(8))
    assert tuple(summary.image_spec(summary.label_cells(two)).first()) == (None, None, None)
    none = one.drop("new_height")
    assert tuple(summary.image_spec(summary.label_cells(none)).first()) == (None, None, None)


def test_number_of_classes(spark):
    labels = spark.createDataFrame([(0, "a"), (4, "b")], "label_idx int, pathology string")
    assert summary.num_classes(labels).first()[0] == 5
    assert summary.num_classes(labels, 7).first()[0] == 7
    assert summary.num_classes(spark.createDataFrame([(None, "a")], "label_idx int, pathology string")).first()[0] == 1
    with pytest.raises(Exception, match="no labels"):
        summary.num_classes(labels.where("false")).collect()
    assert summary.label_of(labels, " b ").first()[0] == 4


def test_steps_round_up(spark):
    got = spark.createDataFrame([(0,), (1,), (32,), (33,)], "n long").select(summary.steps(F.col("n"), 32).alias("s"))
    assert [r.s for r in got.collect()] == [1, 1, 1, 2]


def test_missing_summary_is_an_error(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        summary.read_summary(spark, str(tmp_path / "absent")).collect()


# -- statistics ----------------------------------------------------------------------------


@pytest.mark.parametrize("kind", ["distinct", "skewed", "constant", "single"])
def test_exact_quantiles(spark, kind):
    rng = np.random.default_rng(4)
    values = {
        "distinct": rng.random(5001),
        "skewed": np.where(rng.random(5000) < 0.4, 0.25, rng.random(5000)),
        "constant": np.full(300, 0.5),
        "single": np.array([3.0]),
    }[kind]
    rows = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "v double").repartition(7)
    shares = {"a": 0.0, "b": 0.5, "c": 0.95, "d": 0.99, "e": 1.0}
    got = statistics.exact_quantiles(rows, "v", shares, partitions=5).first()
    assert np.allclose([got[k] for k in shares], [np.percentile(values, s * 100) for s in shares.values()])


def test_thresholds_are_exact(spark):
    rng = np.random.default_rng(8)
    errors = rng.random((500, 2))
    rows = spark.createDataFrame([(float(m), float(x)) for m, x in errors], "mean_error double, max_error double")
    found = statistics.calibrate_threshold(rows).first()
    assert found["threshold_strict"] == errors[:, 1].max() and found["normal_images_evaluated"] == 500
    for name, share in (("threshold_p99", 99), ("threshold_p95", 95)):
        assert np.isclose(found[name], np.percentile(errors[:, 1], share))
    assert np.isclose(found["max_pixel_error_std"], errors[:, 1].std()) and np.isclose(found["mean_pixel_error_mean"], errors[:, 0].mean())


def test_running_best_over_blocks(spark):
    rng = np.random.default_rng(4)
    rows = [(run, epoch, float(rng.integers(0, 9)) if rng.random() < 0.95 else None) for run in ("a", "b") for epoch in sorted(rng.choice(200, 60, replace=False).tolist())]
    table = spark.createDataFrame(rows, "run string, epoch long, score double")
    for width in (1, 7, 1000):
        got = {(r.run, r.epoch): (r.nth, r.best) for r in statistics.running_best(table, width).collect()}
        for run in ("a", "b"):
            best = None
            for nth, (_, epoch, score) in enumerate([r for r in rows if r[0] == run], 1):
                if best is None or (score is not None and (best[0] is None or score > best[0])):
                    best = (score, epoch, nth)
                assert got[run, epoch] == (nth, (best[0], -best[1], best[2]))


def test_patience_equals_a_plain_reading(spark):
    rng = np.random.default_rng(6)
    rows = [(f"r{k}", epoch, float(rng.integers(0, 6))) for k in range(12) for epoch in range(int(rng.integers(1, 40)))]
    table = spark.createDataFrame(rows, "run string, epoch long, metric double")
    for mode, patience, width in (("max", 3, 5), ("min", 1, 1), ("max", 8, 100)):
        sign = 1 if mode == "max" else -1
        expected = set()
        for k in range(12):
            best, waited, stop, n = None, 0, None, 0
            for run, epoch, metric in rows:
                if run == f"r{k}" and stop is None:
                    n += 1
                    if best is None or sign * metric > sign * best[1]:
                        best, waited = (epoch, metric), 0
                    else:
                        waited += 1
                        stop = epoch if waited >= patience else None
            expected.add((f"r{k}", *best, n, stop))
        assert {tuple(r) for r in statistics.best_epoch(table, mode, patience, width).collect()} == expected


def test_best_epoch_stops_after_patience(spark):
    metric = [0.1, 0.5, 0.4, 0.5, 0.3, 0.9]
    rows = spark.createDataFrame([("a", i, m) for i, m in enumerate(metric)], "run string, epoch long, metric double")
    early = statistics.best_epoch(rows, "max", 3, width=2).first()
    assert (early.best_epoch, early.stopped_epoch, early.epochs_run) == (1, 4, 5)
    full = statistics.best_epoch(rows, "max").first()
    assert (full.best_epoch, full.best_metric, full.stopped_epoch) == (5, 0.9, None)
    assert statistics.best_epoch(rows, "min", 10, width=3).first().best_epoch == 0


def test_sample_per_class_of_a_hot_class(spark):
    rows = ids(spark, 3000).withColumn("pathology", F.when(F.rand(1) < 0.8, "hot").otherwise("cold"))
    rows = spark.createDataFrame(rows.collect(), rows.schema)
    got = sampling.sample_per_class(rows, 20, 7, method="md5", salts=8)
    import hashlib

    for name in ("hot", "cold"):
        members = [r.image_id for r in rows.where(F.col("pathology") == name).collect()]
        want = sorted(members, key=lambda i: hashlib.md5(f"{i}::7".encode()).hexdigest())[:20]
        assert {r.image_id for r in got.where(F.col("pathology") == name).collect()} == set(want)
    again = sampling.sample_per_class(rows.repartition(11), 20, 7, method="md5")
    assert got.exceptAll(again).count() == 0
    assert sampling.sample(rows, n=5).count() == 5 and sampling.sample(rows, per_class=2).count() == 4


# -- scores --------------------------------------------------------------------------------


def test_label_names(spark):
    rows = spark.createDataFrame([(0,), (14,), (15,)], "i int").select(label_name(F.col("i")).alias("n"))
    assert [r.n for r in rows.collect()] == ["Astrocitoma", "_NORMAL", "idx=15"]


def test_topk_breaks_ties_by_index(spark):
    rows = spark.createDataFrame([([0.2, 0.3, 0.3, 0.2],)], "p array<double>")
    got = rows.select(scoring.topk(F.col("p"), 3).alias("t")).first().t
    assert [e.label_idx for e in got] == [1, 2, 0]


def test_threshold_modes(spark):
    info = {"threshold_strict": 3.0, "threshold_p99": 2.0, "threshold_p95": 1.0}
    rows = spark.createDataFrame([("strict", None), ("p99", None), ("p95", 9.0), ("custom", 0.5), ("other", 0.1)], "m string, c double")
    got = rows.select(scoring.pick_threshold(F.col("m"), F.col("c"), info).alias("t")).collect()
    assert [r.t for r in got] == [3.0, 2.0, 1.0, 0.5, 3.0]
    with pytest.raises(Exception, match="needs a threshold"):
        rows.limit(1).select(scoring.pick_threshold(F.lit("custom"), F.lit(None).cast("double"), info)).collect()


def test_disabled_outputs_are_null(spark):
    model = models.SoftmaxModel(np.zeros((2, 4)), np.zeros(2), 2, 2)
    rows = spark.createDataFrame([("a", "p", bytearray(4))], "image_id string, raw_path string, processed_bytes binary")
    row = scoring.predict(rows, model).first()
    assert row.classifier_pred_idx == 0 and row.anomaly_threshold is None and row.request_id is None
    assert list(row.asDict()) == list(scoring.PREDICTIONS)
    with pytest.raises(ValueError):
        scoring.predict(rows, model, outputs=("anomaly_autoencoder",))
    again = models.Reconstructor(np.ones(4), np.zeros((4, 0)), 2, 2)
    row = scoring.predict(rows, None, again, F.lit(0.5), ("anomaly_autoencoder",)).first()
    assert (row.anomalous_pixel_count, row.anomaly_ratio, row.classifier_topk_json) == (4, 1.0, None)


def test_total_pixels_order(spark):
    def at(*values):
        return spark.range(1).select(scoring.total_pixels(*[F.lit(v).cast("double") for v in values]).alias("n")).first().n

    assert at(2, 3, 9, 9, 1, 0.5) == 6
    assert at(None, 3, 9, 9, 1, 0.5) == 81
    assert at(None, None, None, 9, 7, 0.25) == 28
    assert at(None, None, None, None, 0, 0.0) is None


def test_empty_topk_has_no_rows(spark):
    rows = spark.createDataFrame([(1, None), (2, ""), (3, '[{"label_idx":1,"label_name":"x","probability":0.5}]')], "id int, classifier_topk_json string")
    got = scoring.parse_topk(rows).collect()
    assert [(r.id, r.label_idx, r.probability) for r in got] == [(3, 1, 0.5)]


# -- models --------------------------------------------------------------------------------


def pixel_rows(spark, n=60, size=16, seed=9):
    rng = np.random.default_rng(seed)
    basis = rng.normal(size=(3, size))
    levels = np.clip(rng.normal(size=(n, 3)) @ basis * 25 + 128, 0, 255).astype(np.uint8)
    data = [(int(i % 2), bytearray(v.tobytes())) for i, v in enumerate(levels)]
    return levels, spark.createDataFrame(data, "label_idx int, processed_bytes binary").repartition(5)


def test_class_sums_equal_numpy(spark):
    levels, rows = pixel_rows(spark)
    got = {r.label_idx: np.array(r["mean"]) for r in models.class_sums(rows, 4, 4).collect()}
    for label in (0, 1):
        assert np.allclose(got[label], levels[label::2].mean(axis=0) / 255)


def test_reconstructor_spans_the_principal_components(spark):
    levels, rows = pixel_rows(spark)
    x = levels[0::2] / 255
    _, _, vt = np.linalg.svd(x - x.mean(axis=0))
    for latent in (2, 16, 40):
        model = models.fit_reconstructor(rows, 0, 4, 4, latent=latent)
        assert np.allclose(model.components @ model.components.T, vt[:latent].T @ vt[:latent], atol=1e-6)
        assert np.allclose(model.mean, x.mean(axis=0))


def test_reconstructor_of_many_pixels_and_a_slow_spectrum(spark):
    side, images = 68, 60  # more than 4,096 pixels
    rng = np.random.default_rng(4)
    levels = rng.integers(0, 256, (images, side * side), dtype=np.uint8)
    rows = spark.createDataFrame([(0, bytearray(x.tobytes())) for x in levels], "label_idx int, processed_bytes binary").repartition(4)
    x = levels / 255 - (levels / 255).mean(axis=0)
    _, weight, vt = np.linalg.svd(x, full_matrices=False)
    assert weight[20] > 0.7 * weight[0]
    model = models.fit_reconstructor(rows, 0, side, side, latent=20)
    expected = np.abs(x - x @ vt[:20].T @ vt[:20]).max(axis=1)
    found = np.abs(x - x @ model.components @ model.components.T).max(axis=1)
    assert np.allclose(found, expected, rtol=1e-3)


def test_fitted_classifier_learns(spark):
    rng = np.random.default_rng(1)
    data = []
    for i in range(80):
        image = rng.integers(0, 60, (4, 4))
        image[:, (i % 2) * 2 : (i % 2) * 2 + 2] += 150
        data.append((i % 2, bytearray(image.astype(np.uint8).tobytes())))
    rows = spark.createDataFrame(data, "label_idx int, processed_bytes binary")
    model = models.fit_classifier(rows.limit(60), rows, 4, 4, (0.0, 1.0), 30)
    assert max(h[1] for h in model.history) == 1.0
    means = models.fit_class_means(rows, 4, 4).classifier()
    scored = scoring.classify(rows, means).withColumn("pred_idx", F.col("classifier_pred_idx"))
    assert statistics.evaluate(scored).first().accuracy == 1.0


def test_oversized_models_are_refused(spark, monkeypatch):
    with pytest.raises(ValueError, match="exceeds"):
        models.bounded_model(10**9, "model")
    monkeypatch.setattr(models, "MODEL_BYTES", 16 * 8)
    with pytest.raises(ValueError, match="exceeds"):
        models.fit_class_means(pixel_rows(spark)[1], 4, 4)


# -- requests ------------------------------------------------------------------------------


def test_settings_override_the_base(spark):
    rows = spark.createDataFrame([("a", 3, ["x"]), ("b", None, None)], "request_id string, top_k int, enabled_outputs array<string>")
    got = {r.request_id: r for r in request_ops.effective_settings(rows, {"top_k": 5, "enabled_outputs": ["y"], "partitions": 1}).collect()}
    assert (got["a"].top_k, got["a"].enabled_outputs, got["a"].partitions) == (3, ["x"], 1)
    assert (got["b"].top_k, got["b"].enabled_outputs, got["b"].master) == (5, ["y"], None)


def test_file_counts_decide_request_rows(spark):
    requests = spark.createDataFrame([("none",), ("one",), ("two",)], "request_id string")
    files = spark.createDataFrame([("one", "/one/raw/x", 3), ("two", "/two/raw/x", 3), ("two", "/two/raw/y", 4)], "request_id string, path string, length long")
    got = {r.request_id: (r.raw_path, r.error) for r in request_ops.request_bronze(requests, files).collect()}
    assert got["one"] == ("/one/raw/x", None)
    assert "no raw image" in got["none"][1] and "found 2" in got["two"][1]


def test_templates_are_no_request(spark):
    rows = spark.createDataFrame([("templates", "pending"), ("a", "pending"), ("b", "done")], "request_id string, status string")
    assert [r.request_id for r in request_ops.pending(rows).collect()] == ["a"]
