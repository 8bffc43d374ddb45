"""Reproducible pseudo-random columns: they depend on the id and the seed alone."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: number of steps of the split key.
SPLIT_STEPS = 1_000_000


def seeded_hash(id_col: Column, seed: int) -> Column:
    """xxhash64 of ``id::seed``. A null id is an error: nulls would all hash alike."""
    checked = F.when(id_col.isNull(), F.raise_error(F.lit("image_id must not be null"))).otherwise(id_col)
    return F.xxhash64(F.concat_ws("::", checked, F.lit(str(seed))))


def hash_bucket(id_col: Column, seed: int, n: int) -> Column:
    """Bucket in [0, n)."""
    return F.pmod(seeded_hash(id_col, seed), F.lit(n))


def split_key(id_col: Column, seed: int) -> Column:
    """Fraction in [0, 1) that places a row in a split."""
    return hash_bucket(id_col, seed, SPLIT_STEPS) / F.lit(float(SPLIT_STEPS))


def shard_id(id_col: Column, seed: int, n_shards: int) -> Column:
    """Shard in [0, n_shards)."""
    return hash_bucket(id_col, seed, n_shards).cast("int")


def salt(id_col: Column, n: int) -> Column:
    """Spread of one key's rows over n tasks, independent of split and shard."""
    return F.pmod(F.xxhash64(id_col, F.lit("salt")), F.lit(n)).cast("int")


def sample_order(id_col: Column, seed: int, method: str = "xxhash64") -> list[Column]:
    """Sort columns of a random order that no repartitioning changes."""
    if method == "md5":
        return [F.md5(F.concat_ws("::", id_col, F.lit(str(seed)))), id_col]
    return [seeded_hash(id_col, seed), id_col]
