"""Seeded, reproducible sampling of distinct keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candleframe.schema import SAMPLE_SEED, SAMPLE_SIZE


def seeded_key_sample(
    df: DataFrame, key: str, k: int = SAMPLE_SIZE, seed: int = SAMPLE_SEED
) -> DataFrame:
    """``k`` distinct values of ``key`` without replacement, chosen by seed.

    Keys are ordered by md5(seed || ':' || key) (ties by key): the choice depends only on
    the seed and the key set, not on row arrival order or partitioning, and any SQL engine
    with md5 reproduces it. The limit is the feature: a top-k over distinct keys.
    """
    h = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))
    return (
        df.select(key)
        .distinct()
        .withColumn("sample_hash", h)
        .orderBy("sample_hash", key)
        .limit(k)
    )
