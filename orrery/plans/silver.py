"""Silver layer: typed, cleaned, one row per key (jobs B1, B2)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orrery import config
from orrery.functions.columns import (blank_to_null, lenient_cast, literal_alternation,
                                      sentinel_flag, sentinel_to_null, trimmed)
from orrery.operators.cleaning import (exclude_by_pattern, exclude_tokens, first_row_per_key,
                                       max_per_key, required_fields)

ITEM_ORDER = ["name", "tags", "kind", "units", "is_open", "score", "members"]


def typed_items(raw: DataFrame) -> DataFrame:
    """Lenient typing of the raw catalogue.

    ``is_open`` is read from the raw units before anything else (null stays
    null); the unit sentinel becomes null; name, tags and kind are trimmed;
    blank tags become null while a blank name stays ''. The id is cast before
    de-duplication so that "1" and "01" are one item.
    """
    return raw.select(
        lenient_cast("item_id", "int").alias("item_id"),
        trimmed("name").alias("name"),
        blank_to_null("tags").alias("tags"),
        trimmed("kind").alias("kind"),
        sentinel_to_null("units", config.UNITS_SENTINEL, "int").alias("units"),
        sentinel_flag("units", config.UNITS_SENTINEL).alias("is_open"),
        lenient_cast("score", "double").alias("score"),
        lenient_cast("members", "int").alias("members"),
    )


def silver_items(raw: DataFrame, excluded: Sequence[str] = config.EXCLUDED_TAGS,
                 exact_tokens: bool = False) -> DataFrame:
    """B1: required id and name, excluded tags dropped, one row per id (the
    smallest in name, tags, kind, units, is_open, score, members; nulls last).

    Exclusion matches the words as substrings of the whole tag string (the
    original rule, which also hits longer tags containing a word); with
    ``exact_tokens`` only whole tags count."""
    items = required_fields(typed_items(raw), ["item_id", "name"])
    if exact_tokens:
        items = exclude_tokens(items, "tags", config.TAG_SEPARATOR, excluded)
    else:
        items = exclude_by_pattern(items, "tags", literal_alternation(excluded))
    return first_row_per_key(items, ["item_id"], ITEM_ORDER)


def typed_ratings(raw: DataFrame) -> DataFrame:
    """Lenient int casts; the rating sentinel -1 (seen, not rated) -> null."""
    return raw.select(
        lenient_cast("user_id", "int").alias("user_id"),
        lenient_cast("item_id", "int").alias("item_id"),
        sentinel_to_null("rating", config.RATING_SENTINEL, "int").alias("rating"),
    )


def dedup_ratings(raw: DataFrame) -> DataFrame:
    """Required keys, then one row per (user, item) with its highest rating."""
    ratings = required_fields(typed_ratings(raw), ["user_id", "item_id"])
    return max_per_key(ratings, ["user_id", "item_id"], "rating")


def silver_ratings(raw: DataFrame, items: DataFrame) -> DataFrame:
    """B2: de-duplicated ratings whose item is in the clean catalogue.

    De-duplication (a partial aggregate) runs before the semi join so the
    join sees at most one row per pair.
    """
    return dedup_ratings(raw).join(items.select("item_id"), "item_id", "left_semi").select(
        "user_id", "item_id", "rating")


def item_tags(items: DataFrame) -> DataFrame:
    """(item_id, tag_name) pairs: split on ", ", trim, drop empty tokens."""
    return (items.filter(F.col("tags").isNotNull())
            .select("item_id", F.explode(F.split("tags", config.TAG_SEPARATOR)).alias("tag_name"))
            .withColumn("tag_name", F.trim("tag_name"))
            .filter(F.col("tag_name") != ""))
