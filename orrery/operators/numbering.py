"""Global dense numbering without a single-partition window.

``row_number() OVER (ORDER BY k)`` with no partition clause moves every row
into one task. Here the rows are range-partitioned on the order key and
sorted inside each partition; each row gets a partition-local position, the
per-partition counts (one row per partition, a bounded frame) give
cumulative offsets, and position + offset is the global number. The
range-partitioned frame is checkpointed to the shared checkpoint folder
first so that positions stay fixed between the two passes (and survive a
lost executor).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orrery.operators.joins import bounded_broadcast


def global_row_number(df: DataFrame, order: Sequence[str | Column], out: str,
                      num_partitions: int | None = None) -> DataFrame:
    """Add ``out`` = 1-based position of each row in ``order`` (ascending,
    nulls first, like ``row_number() OVER (ORDER BY ...)``). Make ``order``
    unique (append a key) for a deterministic result."""
    # Without an explicit count AQE coalesces contiguous range partitions to
    # the advisory size; coalescing keeps partition order, so positions and
    # offsets stay correct.
    spread = (df.repartitionByRange(num_partitions, *order) if num_partitions
              else df.repartitionByRange(*order))
    ranged = (spread.sortWithinPartitions(*order)
              .withColumn("_pid", F.spark_partition_id())
              .withColumn("_mid", F.monotonically_increasing_id())
              .checkpoint(eager=True))
    counts = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"),
                                        F.min("_mid").alias("_first"))
    # One row per partition: a global window over it is bounded by n.
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    offsets = counts.select("_pid", "_first",
                            (F.sum("_n").over(w) - F.col("_n")).alias("_offset"))
    numbered = ranged.join(F.broadcast(offsets), "_pid")
    return numbered.withColumn(
        out, (F.col("_offset") + F.col("_mid") - F.col("_first") + 1)
    ).drop("_pid", "_mid", "_first", "_offset")


def quantile_bins(df: DataFrame, order: Sequence[str | Column], q_max: int,
                  out: str = "bin", rank_col: str | None = None) -> DataFrame:
    """Equal-frequency bins 1..q over the rows ranked by ``order``.

    rank r (1..n, ties broken by ``order``), q = min(q_max, n):
    bin = max(1, ceil((r - 1) * q / (n - 1))) -- the bins a quantile cut of the
    ranks into q intervals produces, in whole numbers (``div``). n is a count
    of ``df``; rows are dropped when n < 2. ``rank_col`` keeps r.
    """
    ranked = global_row_number(df, order, "_rank")
    n = df.agg(F.count(F.lit(1))).scalar()
    binned = ranked.withColumn("_n", n).filter("_n >= 2").withColumn(out, F.expr(
        f"cast(greatest(1, ((_rank - 1) * least({q_max}, _n) + _n - 2) div (_n - 1)) as int)"))
    binned = binned.drop("_n")
    return binned.withColumnRenamed("_rank", rank_col) if rank_col else binned.drop("_rank")


def group_medians(df: DataFrame, group: str, values: Sequence[str], tie: str,
                  max_groups: int | None = None) -> DataFrame:
    """Exact median of each ``values`` column per ``group`` (mean of the two
    middle values for even counts), without holding a group's values in one
    aggregation buffer.

    For each value column the rows are numbered globally in (group, value,
    tie) order with ``global_row_number``; per group the first number and
    the count (one small row per group) locate the middle position(s); only
    those rows are kept and averaged.
    """
    out = None
    for v in values:
        ranked = global_row_number(df.select(group, v, tie).filter(F.col(v).isNotNull()),
                                   [group, v, tie], "_pos")
        med = medians_at_positions(ranked, group, "_pos", v, max_groups)
        out = med if out is None else out.join(med, group, "full")
    return out


def medians_at_positions(ranked: DataFrame, group: str, pos: str, value: str,
                         max_groups: int | None = None) -> DataFrame:
    """Median of ``value`` per group when ``pos`` numbers the rows of each
    group consecutively in ``value`` order: per group the first position and
    the count (one small row per group) locate the middle row(s). They are
    broadcast when ``max_groups`` bounds the groups, so no row is shuffled."""
    stats = ranked.groupBy(group).agg(F.min(pos).alias("_first"),
                                      F.count(F.lit(1)).alias("_n"))
    lo = F.col("_first") + F.floor((F.col("_n") - 1) / 2)
    hi = F.col("_first") + F.floor(F.col("_n") / 2)
    stats = bounded_broadcast(stats, max_groups)
    return (ranked.join(stats, group)
            .filter((F.col(pos) == lo) | (F.col(pos) == hi))
            .groupBy(group).agg(F.avg(F.col(value).cast("double")).alias(value)))
