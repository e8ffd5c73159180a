"""Connected components of a link table, as alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orrery.llm.common import written


def _large_star(e: DataFrame) -> DataFrame:
    """Link each larger neighbour to the least of a node's neighbourhood."""
    both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")) \
        .select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").filter("v > u").select(F.col("v").alias("u"),
                                                        F.col("m").alias("v"))


def _small_star(e: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the least of them (u > v)."""
    least = e.groupBy("u").agg(F.min("v").alias("m"))
    moved = e.join(least, "u").filter("v > m").select(F.col("v").alias("u"),
                                                      F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v")))


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of ``links`` (u, v): the label is the
    least node of its component. Each round is written to the shared folder;
    rounds grow with the logarithm of a component's diameter. A node with very
    many links is a skewed join key, which adaptive execution splits."""
    e = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")) \
        .filter("u > v").distinct()
    last = None
    while True:
        e = written(_small_star(_large_star(e).filter("u > v").distinct()).distinct(), "stars")
        state = tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")))
                      .first())
        if state == last:
            break
        last = state
    roots = e.select(F.col("v").alias("node")).distinct().withColumn("label", F.col("node"))
    return e.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(roots)
