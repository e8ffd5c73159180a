"""Joins with an explicit size check before broadcasting, and with hot keys
split from the rest."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orrery import config


def bounded_broadcast(small: DataFrame, known_rows: int | None,
                      max_rows: int = config.BROADCAST_MAX_ROWS) -> DataFrame:
    """Broadcast hint only when a row count (from a manifest or a bounded
    construction) proves the side small; otherwise AQE decides at run time
    from measured shuffle sizes and falls back to a sort-merge join."""
    if known_rows is not None and known_rows <= max_rows:
        return F.broadcast(small)
    return small


def hot_keys(df: DataFrame, on: Sequence[str], partitions: int) -> DataFrame:
    """The keys of ``df`` with more rows than a shuffle partition holds on
    average, so at most ``partitions`` keys: from per-key counts, which are
    summed within a task first. Checkpointed to the shared folder. A key with
    a null is never hot: it joins nothing."""
    known = df.select(*on).dropna(subset=list(on))
    counts = known.groupBy(*on).agg(F.count(F.lit(1)).alias("_n"))
    total = known.agg(F.count(F.lit(1))).scalar()
    return counts.filter(F.col("_n") * F.lit(partitions) > total).select(*on) \
        .checkpoint(eager=True)


def skew_join(df: DataFrame, dim: DataFrame, on: Sequence[str], how: str = "inner",
              dim_rows: int | None = None, max_rows: int = config.BROADCAST_MAX_ROWS,
              partitions: int | None = None) -> DataFrame:
    """``df`` joined to ``dim`` on the columns ``on`` (``how``: inner or left).

    A ``dim`` known to have at most ``max_rows`` rows is broadcast whole.
    Otherwise the rows of hot keys stay where they are and meet the few rows
    of ``dim`` with these keys, which are counted and broadcast; only the rest
    is shuffled. Rows of a left join whose key is null meet nothing and stay
    too. Should the hot keys' rows of ``dim`` exceed ``max_rows`` (keys that
    repeat very often in ``dim``), every such row is copied to ``partitions``
    salts and the hot rows are dealt out by them. ``partitions`` also sets
    into how many the rest is shuffled; without it Spark's setting does."""
    if how not in ("inner", "left"):
        raise ValueError(how)
    on = list(on)
    if dim_rows is not None and dim_rows <= max_rows:
        return df.join(F.broadcast(dim), on, how)
    parts = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot = hot_keys(df, on, parts)
    out = [df.join(F.broadcast(hot), on, "left_anti")]
    if how == "left":
        whole = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in on])
        out[0] = out[0].filter(whole)
        out.append(df.filter(~whole).join(F.broadcast(dim.limit(0)), on, "left"))
    rest = dim
    if partitions:
        out[0] = out[0].repartition(partitions, *on)
        rest = dim.repartition(partitions, *on)
    out[0] = out[0].join(rest.hint("merge"), on, how)
    if hot.isEmpty():
        return reduce(DataFrame.unionByName, out)
    rows = df.join(F.broadcast(hot), on, "left_semi")
    facts = dim.join(F.broadcast(hot), on, "left_semi").checkpoint(eager=True)
    if facts.count() <= max_rows:
        out.append(rows.join(F.broadcast(facts), on, how))
    else:
        salt = F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
        out.append(rows.withColumn("_salt", F.pmod(F.monotonically_increasing_id(),
                                                   F.lit(parts)).cast("int"))
                   .join(facts.withColumn("_salt", salt).hint("merge"), [*on, "_salt"], how)
                   .drop("_salt"))
    return reduce(DataFrame.unionByName, out)
