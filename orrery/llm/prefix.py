"""Positions and running totals over rows in a total order, without a
single-task window.

The rows are range-partitioned and sorted, numbered within their partition
and written; totals per (partition, group), a row for each, give the offset
of each partition in its group. A group that holds most of the rows spans as
many partitions as its rows need."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orrery.llm.common import written
from orrery.operators.joins import bounded_broadcast


def ranked_rows(df: DataFrame, group: Column, order: list[Column], name: str
                ) -> tuple[DataFrame, DataFrame]:
    """(rows, spans). ``rows`` has row, group, part and at: the input rows,
    sorted by (group, order) within range partitions. ``spans`` has a row for
    each partition and group in it: part, group, first (at of its first row)
    and offset (rows of the group before). So a row's 0-based position in its
    group is at - first + offset."""
    ranked = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"),
                       group.alias("group"), F.struct(*order).alias("key"))
    ranked = written(
        ranked.repartitionByRange("group", "key").sortWithinPartitions("group", "key")
        .select("row", "group", F.spark_partition_id().alias("part"),
                F.monotonically_increasing_id().alias("at")), name)
    spans = ranked.groupBy("part", "group").agg(F.min("at").alias("first"),
                                                F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("group").orderBy("part").rowsBetween(
        Window.unboundedPreceding, -1)
    return ranked, spans.select("part", "group", "first", F.coalesce(
        F.sum("n").over(before), F.lit(0)).alias("offset"))


def with_span(rows: DataFrame, spans: DataFrame) -> DataFrame:
    """``rows`` (of ranked_rows) with the columns of ``spans``. The spans are
    written and counted: up to a bound they are broadcast and no row moves."""
    spans = written(spans, "spans")
    few = bounded_broadcast(spans.withColumnsRenamed({"part": "_part", "group": "_group"}),
                            spans.count())
    return rows.join(few, (F.col("part") == F.col("_part"))
                     & F.col("group").eqNullSafe(F.col("_group"))).drop("_part", "_group")


def running_start(df: DataFrame, part: str, at: str, amount: str) -> DataFrame:
    """``df`` with ``start``: the sum of ``amount`` over all rows before it in
    the order (part, at). ``part`` numbers files or partitions: their totals
    are one small row each."""
    totals = df.groupBy(F.col(part).alias("_part")).agg(F.sum(amount).alias("_total"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("_part", F.coalesce(F.sum("_total").over(before),
                                               F.lit(0)).alias("_offset"))
    inside = Window.partitionBy(part).orderBy(at).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn("start", F.coalesce(F.sum(amount).over(inside), F.lit(0))) \
        .join(totals, F.col(part) == F.col("_part")) \
        .withColumn("start", F.col("start") + F.col("_offset")).drop("_part", "_offset")
