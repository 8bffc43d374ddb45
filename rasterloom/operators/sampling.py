"""Reproducible samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from rasterloom.functions.hashing import salt, sample_order

SALTS = 64


def sample_per_class(
    df: DataFrame, n: int, seed: int, by: str = "pathology", method: str = "xxhash64", salts: int = SALTS
) -> DataFrame:
    """The first ``n`` rows of each class in a seeded random order.

    Ranked twice: within salted parts of a class, then among the survivors. A
    class with most of the rows is spread over ``salts`` tasks, and the second
    ranking sees at most ``n * salts`` of its rows. The answer is exact.
    """
    order = sample_order(F.col("image_id"), seed, method)
    parts = Window.partitionBy(by, "_part").orderBy(*order)
    whole = Window.partitionBy(by).orderBy(*order)
    return (
        df.withColumn("_part", salt(F.col("image_id"), salts))
        .withColumn("_rank", F.row_number().over(parts))
        .where(F.col("_rank") <= n)
        .withColumn("_rank", F.row_number().over(whole))
        .where(F.col("_rank") <= n)
        .drop("_part", "_rank")
    )


def sample_n(df: DataFrame, n: int = 100, seed: int = 42, method: str = "xxhash64") -> DataFrame:
    """The first ``n`` rows in a seeded random order."""
    return df.orderBy(*sample_order(F.col("image_id"), seed, method)).limit(n)


def preview(df: DataFrame, n: int = 10) -> DataFrame:
    """Any ``n`` rows."""
    return df.limit(n)


def sample(df: DataFrame, n: int = 100, per_class: int | None = None, seed: int = 42) -> DataFrame:
    """Preview sample: per class when ``per_class`` is given, else ``n`` rows overall."""
    return sample_per_class(df, per_class, seed) if per_class else sample_n(df, n, seed)
