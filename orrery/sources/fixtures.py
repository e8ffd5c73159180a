"""Dirty catalogue and rating inputs derived from the driver's tables.

The driver tables are clean, so the raw item and rating files the pipeline
expects are projections of ``part`` and ``lineitem``/``orders`` that plant
nulls, extra copies, blanks, sentinels and orphans (rules in FIXTURES.md).
Every column is text, as a header-only CSV read would give.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RAW_ITEM_COLUMNS = ["item_id", "name", "tags", "kind", "units", "score", "members"]
RAW_RATING_COLUMNS = ["user_id", "item_id", "rating"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def raw_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    key = F.col("p_partkey")
    return p.select(
        F.when(key % 97 == 5, F.lit(None).cast("string"))
        .when(key % 41 == 7, (key - 1).cast("string"))
        .otherwise(key.cast("string")).alias("item_id"),
        F.when(key % 89 == 3, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit(" "), F.col("p_name"), F.lit(" "))).alias("name"),
        F.when(key % 23 == 0, F.lit("  "))
        .otherwise(F.concat(F.replace(F.col("p_name"), F.lit(" "), F.lit(", ")),
                            F.lit(", "), F.col("p_type"))).alias("tags"),
        F.when(key % 53 == 11, F.lit(None).cast("string"))
        .otherwise(F.col("p_brand")).alias("kind"),
        F.when(F.col("p_size") % 10 == 0, F.lit("Unknown"))
        .otherwise(F.col("p_size").cast("string")).alias("units"),
        F.when(key % 17 == 0, F.lit(None).cast("string"))
        .otherwise(F.round((F.col("p_retailprice") - 900) / 10, 2).cast("string")).alias("score"),
        ((key * 7919) % 50000).cast("string").alias("members"),
    )


def raw_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    rating = F.when(F.col("l_returnflag") == "N", F.lit("-1")) \
        .otherwise(F.ceil(F.col("l_quantity") / 5).cast("int").cast("string"))
    # What the join moves: two keys and a short text.
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey",
                                                 rating.alias("rating"))
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    return j.select(
        F.when(F.col("l_orderkey") % 211 == 0, F.lit(None).cast("string"))
        .otherwise(F.col("o_custkey").cast("string")).alias("user_id"),
        F.col("l_partkey").cast("string").alias("item_id"),
        "rating",
    )


#: Decimal and odd texts of whole numbers, dealt over the items in turn.
DECIMAL_TEXTS = ["{k}", "{k}.0", "{k}.7", "-{k}.9", ".5", ".", "+{k}", " {k}.2 ", "1e3", "{k}.x",
                 "", "2147483648.5", "99999999999", "5."]


def decimal_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(p_partkey, raw): one of DECIMAL_TEXTS with the key in it."""
    key = F.col("p_partkey")
    turn = F.element_at(F.array(*[F.lit(t) for t in DECIMAL_TEXTS]),
                        (key % len(DECIMAL_TEXTS) + 1).cast("int"))
    return table(spark, sf_dir, "part").select(
        "p_partkey", F.replace(turn, F.lit("{k}"), key.cast("string")).alias("raw"))
