"""Row-level cleaning: required fields, exclusion, de-duplication."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def all_present(columns: Sequence[str]):
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])


def required_fields(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keep rows whose listed columns are all non-null."""
    return df.filter(all_present(columns))


def exclude_by_pattern(df: DataFrame, column: str, pattern: str) -> DataFrame:
    """Drop rows whose text contains a match of ``pattern`` (unanchored,
    case-sensitive, over the whole multi-value string); nulls are kept."""
    return df.filter(F.col(column).isNull() | ~F.col(column).rlike(pattern))


def first_row_per_key(df: DataFrame, keys: Sequence[str],
                      order: Sequence[str] | None = None) -> DataFrame:
    """One survivor per key: the smallest row in ``order`` (nulls last).

    ``order`` defaults to all non-key columns, so the survivor is fully
    determined. Expressed as ``min(struct)`` per key: a map-side partial
    aggregate collapses copies before the shuffle, so a key holding a large
    share of the rows never lands in one task as raw rows.
    """
    order = list(order) if order is not None else [c for c in df.columns if c not in keys]
    rest = [c for c in df.columns if c not in keys and c not in order]
    fields = []
    for i, c in enumerate([*order, *rest]):
        fields += [F.col(c).isNull().alias(f"_null{i}"), F.col(c).alias(c)]
    best = df.groupBy(*keys).agg(F.min(F.struct(*fields)).alias("_best"))
    return best.select(*[F.col(k) for k in keys],
                       *[F.col(f"_best.{c}").alias(c) for c in df.columns if c not in keys]
                       ).select(*df.columns)


def max_per_key(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """One row per key keeping the largest non-null ``value`` (null if none)."""
    return df.groupBy(*keys).agg(F.max(value).alias(value)).select(*df.columns)


def exclude_tokens(df: DataFrame, column: str, separator: str, words) -> DataFrame:
    """Exact-token variant of the exclusion: drop rows having a token (split
    on ``separator``, trimmed) equal to one of ``words``; nulls are kept."""
    tokens = F.transform(F.split(F.col(column), separator), lambda t: F.trim(t))
    banned = F.array(*[F.lit(w) for w in words])
    return df.filter(F.col(column).isNull() | ~F.arrays_overlap(tokens, banned))
