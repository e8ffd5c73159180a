"""Exact order statistics without sorting: ranges of values are counted and
the range that holds a wanted rank is split further until it is one value.

Each pass is a scan with a partial aggregate into at most SPLIT ranges for
each open rank; no row is shuffled or written. A pass also takes the least and
greatest value of every range, so the next one splits only what occurs there:
even one wide gap among the values costs no extra pass, and every pass sets
apart at least the two ends, so it ends with one value.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SPLIT = 4096
#: Ranks asked for in one call.
MAX_TARGETS = 200

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


@dataclass(frozen=True)
class Found:
    value: float | int
    below: int  # values of the group that are less


@dataclass
class _Range:
    group: object
    low: float | int
    high: float | int
    below: int
    ranks: list[int]


def _bucket(value: Column, r: _Range, whole: bool) -> Column:
    if whole:
        step = (r.high - r.low) // SPLIT + 1
        return F.call_function("div", value - F.lit(r.low), F.lit(step)).cast("int")
    share = (value - F.lit(r.low)) / F.lit(r.high - r.low)
    return F.least(F.floor(share * SPLIT).cast("int"), F.lit(SPLIT - 1))


def order_statistics(df: DataFrame, value: str, targets: Iterable[tuple[object, int]],
                     group: str | None = None) -> dict[tuple[object, int], Found]:
    """For each target (group, rank): the value of that rank, from 1, among
    the non-null ``value`` of the group (None: of all rows), and how many are
    less. Whole numbers are compared as such within +-2^62, others as doubles.
    Ranks beyond a group's size are left out."""
    targets = sorted(set(targets), key=lambda t: (str(t[0]), t[1]))
    if len(targets) > MAX_TARGETS:
        raise ValueError(f"more than {MAX_TARGETS} ranks")
    whole = isinstance(df.schema[value].dataType, _WHOLE)
    own = F.col(group) if group else F.lit(None).cast("int")
    rows = df.select(own.alias("g"), F.col(value).cast("bigint" if whole else "double")
                     .alias("v")).filter(F.col("v").isNotNull())
    if group:
        rows = rows.filter(F.col("g").isin(sorted({g for g, _ in targets})))
    ends = {r.g: r for r in rows.groupBy("g").agg(
        F.min("v").alias("low"), F.max("v").alias("high"),
        F.count(F.lit(1)).alias("n")).collect()}
    found: dict[tuple[object, int], Found] = {}
    open_: list[_Range] = []
    for g in {g for g, _ in targets}:
        ranks = [k for x, k in targets if x == g and g in ends and 1 <= k <= ends[g].n]
        if ranks:
            open_.append(_Range(g, ends[g].low, ends[g].high, 0, ranks))
    while True:
        for r in [r for r in open_ if r.low == r.high]:
            found.update({(r.group, k): Found(r.low, r.below) for k in r.ranks})
        open_ = [r for r in open_ if r.low != r.high]
        if not open_:
            return found
        place, bucket = F.lit(None).cast("int"), F.lit(None).cast("int")
        for i, r in reversed(list(enumerate(open_))):
            inside = F.col("g").eqNullSafe(F.lit(r.group)) & F.col("v").between(r.low, r.high)
            place = F.when(inside, F.lit(i)).otherwise(place)
            bucket = F.when(inside, _bucket(F.col("v"), r, whole)).otherwise(bucket)
        counted = rows.select(place.alias("i"), bucket.alias("b"), "v") \
            .filter("i is not null").groupBy("i", "b").agg(
                F.count(F.lit(1)).alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
        after: list[_Range] = []
        by_range: dict[int, list] = {}
        for row in counted.collect():  # at most SPLIT rows for each open rank
            by_range.setdefault(row.i, []).append(row)
        for i, r in enumerate(open_):
            below = r.below
            for row in sorted(by_range[i], key=lambda x: x.b):
                ranks = [k for k in r.ranks if below < k <= below + row.n]
                if ranks:
                    after.append(_Range(r.group, row.low, row.high, below, ranks))
                below += row.n
        open_ = after


def middle_ranks(n: int) -> tuple[int, int]:
    """Ranks of the two middle values of ``n`` (the same one if odd)."""
    return (n + 1) // 2, n // 2 + 1
