"""Fitted models and thresholds as small Parquet tables."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession, functions as F

from rasterloom.operators.models import Reconstructor, SoftmaxModel
from rasterloom.operators.training import Network

VECTORS = "part string, idx int, height int, width int, bias double, vector array<double>"


def save_classifier(spark: SparkSession, model: SoftmaxModel | Network, path: str) -> None:
    """One row per unit of each layer; the last layer's units are the classes."""
    layers = list(zip(model.arrays[::2], model.arrays[1::2]))
    named = [*[f"layer{i}" for i in range(len(layers) - 1)], "class"]
    rows = [
        (part, i, model.height, model.width, float(bias), [float(v) for v in weights])
        for part, layer in zip(named, layers)
        for i, (weights, bias) in enumerate(zip(*layer))
    ]
    spark.createDataFrame(rows, VECTORS).write.mode("overwrite").parquet(path)


def load_classifier(spark: SparkSession, path: str) -> SoftmaxModel | Network:
    rows = spark.read.parquet(path).orderBy("idx").collect()  # one row per unit
    # "class" sorts before "layer…", but comes last
    parts = sorted({r["part"] for r in rows}, key=lambda part: (part == "class", len(part), part))
    layers = [[r for r in rows if r["part"] == part] for part in parts]
    arrays = [np.array([r[name] for r in layer]) for layer in layers for name in ("vector", "bias")]
    size = rows[0]["height"], rows[0]["width"]
    return SoftmaxModel(*arrays, *size) if len(arrays) == 2 else Network(tuple(arrays), *size)


def save_reconstructor(spark: SparkSession, model: Reconstructor, path: str) -> None:
    """The mean image and one row per component."""
    vectors = [("mean", 0, model.mean)] + [("component", i, c) for i, c in enumerate(model.components.T)]
    rows = [(part, i, model.height, model.width, None, [float(v) for v in vector]) for part, i, vector in vectors]
    spark.createDataFrame(rows, VECTORS).write.mode("overwrite").parquet(path)


def load_reconstructor(spark: SparkSession, path: str) -> Reconstructor:
    table = spark.read.parquet(path)
    mean = table.where(F.col("part") == "mean").first()
    rows = table.where(F.col("part") == "component").orderBy("idx").collect()  # one row per component
    size = mean["height"] * mean["width"]
    components = np.array([r["vector"] for r in rows]).reshape(len(rows), size).T
    return Reconstructor(np.array(mean["vector"]), components, mean["height"], mean["width"])


def save_thresholds(info: DataFrame, path: str) -> None:
    info.coalesce(1).write.mode("overwrite").parquet(path)


def load_thresholds(spark: SparkSession, path: str) -> dict[str, object]:
    return spark.read.parquet(path).first().asDict()
