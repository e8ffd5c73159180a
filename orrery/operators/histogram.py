"""Equal-width histograms as a table of bins.

Bins split [min, max] into ``bins`` equal intervals, the last one closed; a
single bin when min = max. min/max come from one scalar-subquery aggregate
(no cross join, no global window); bins without rows are listed with 0.
Nulls and NaN have no place on the axis and are left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def equal_width_histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    x = F.col(column).cast("double")
    values = df.select(x.alias("_x")).filter(F.col("_x").isNotNull() & ~F.isnan("_x"))
    bounds = values.agg(F.struct(F.min("_x").alias("lo"), F.max("_x").alias("hi")).alias("b"))
    b = bounds.scalar()
    lo, hi = b.getField("lo"), b.getField("hi")
    idx = F.when(hi == lo, F.lit(0)).otherwise(
        F.least(F.floor((F.col("_x") - lo) * bins / (hi - lo)), F.lit(bins - 1))
    ).cast("int")
    counts = values.groupBy(idx.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    n_bins = F.when(hi == lo, F.lit(1)).otherwise(F.lit(bins))
    grid = bounds.filter(F.col("b.lo").isNotNull()).select(
        F.explode(F.sequence(F.lit(0), n_bins - 1)).alias("bin"))
    width = F.when(hi == lo, F.lit(0.0)).otherwise((hi - lo) / bins)
    return (grid.join(counts, "bin", "left")
            .select("bin",
                    (lo + F.col("bin") * width).alias("bin_start"),
                    F.when(hi == lo, hi).otherwise(lo + (F.col("bin") + 1) * width).alias("bin_end"),
                    F.coalesce(F.col("n"), F.lit(0)).alias("n")))
