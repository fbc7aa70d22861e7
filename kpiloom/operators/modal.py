"""Deterministic mode: most frequent value per key, ties go to the smallest."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def most_frequent(
    df: DataFrame, keys: Sequence[str], value: str, earliest: Sequence[str] = ()
) -> DataFrame:
    """One row per key with its modal non-NULL ``value`` (NULL when it has none).

    Counting first and choosing second keeps both steps combinable before the shuffle,
    so a key that holds most of the rows arrives as a few partial rows. ``earliest``
    columns are carried along as minima over all rows of the key.
    """
    counted = df.groupBy(*keys, value).agg(
        (-F.count(F.lit(1))).alias("_rarity"), *[F.min(c).alias(c) for c in earliest]
    )
    best = F.min(F.when(F.col(value).isNotNull(), F.struct("_rarity", value)))
    return (
        counted.groupBy(*keys)
        .agg(best.alias("_best"), *[F.min(c).alias(c) for c in earliest])
        .select(*keys, F.col(f"_best.{value}").alias(value), *earliest)
    )
