"""Seeded sampling and train/test splitting by key hash.

Both depend only on the key and the seed, never on partition layout or task
retries, unlike ``sample``/``randomSplit``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orrery.functions.columns import hash_order, hash_percent


def seeded_sample(df: DataFrame, keys: Sequence[str], k: int, seed: int) -> DataFrame:
    """Exactly min(k, n) rows without replacement: the k smallest md5 of
    seed:key (a global top-k; each task keeps at most k rows)."""
    return (df.withColumn("_h", hash_order(F.lit(seed), *keys))
            .orderBy("_h").limit(k).drop("_h"))


def hash_split_flag(keys: Sequence[str], percent: int, seed: int):
    """True for the ``percent``% side of a key-hash split."""
    return hash_percent(F.lit(seed), *keys) < percent
