"""Row validation with reasons: not-null, foreign-key and uniqueness rules.

``validate`` runs rules in order over one frame and writes the first failing
rule's text into ``error_reason`` (null = valid). A rule only sees rows that
are still valid: a uniqueness count ignores rows an earlier rule rejected.
Afterwards ``split`` gives (valid, rejects) and ``reject_records`` the rows
for the append-only reject log.

Scale: the not-null rule is a projection. The foreign-key rule is one left
join against the distinct reference keys with a match flag (not a semi plus
an anti join). The uniqueness rule aggregates counts per key (map-side
partial aggregation) and joins back only the duplicated keys, null-safely,
so no key's rows are ever gathered into one window partition. With a
``store`` (a function that writes a frame to the shared folder and reads it
back) the rule's input is computed once, and the list of duplicated keys is
counted before it is joined: an empty list joins nothing, a bounded one is
broadcast, and the rows themselves are shuffled only beyond that bound.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orrery import config
from orrery.functions.columns import payload_json
from orrery.operators.joins import bounded_broadcast, skew_join

REASON = "error_reason"
Store = Callable[[DataFrame], DataFrame]


def _reason(df_reason: Column, failed: Column, text: str) -> Column:
    return F.coalesce(df_reason, F.when(failed, F.lit(text)))


@dataclass(frozen=True)
class NotNull:
    """The reason names all required columns (as the original text does);
    with ``report_missing`` a ``missing_columns`` column also lists the ones
    actually null."""
    columns: tuple[str, ...]
    reason: str | None = None
    report_missing: bool = False

    def text(self) -> str:
        return self.reason or config.REASON_MISSING_PREFIX + ", ".join(self.columns)

    def apply(self, df: DataFrame) -> DataFrame:
        failed = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in self.columns])
        out = df.withColumn(REASON, _reason(F.col(REASON), failed, self.text()))
        if self.report_missing:
            missing = F.concat_ws(", ", *[F.when(F.col(c).isNull(), F.lit(c))
                                          for c in self.columns])
            out = out.withColumn("missing_columns", F.when(failed, missing))
        return out


@dataclass(frozen=True)
class Unique:
    columns: tuple[str, ...]
    reason: str | None = None

    def text(self) -> str:
        return self.reason or config.REASON_DUPLICATE_PREFIX + ", ".join(self.columns)

    def apply(self, df: DataFrame, store: Store | None = None) -> DataFrame:
        if store is not None:
            df = store(df)
        alias = {c: f"_uq_{i}" for i, c in enumerate(self.columns)}
        dups = (df.filter(F.col(REASON).isNull())
                .groupBy(*self.columns).count()
                .filter(F.col("count") > 1)
                .select(*[F.col(c).alias(alias[c]) for c in self.columns])
                .withColumn("_uq_hit", F.lit(True)))
        if store is not None:
            dups = store(dups)
            n = dups.count()  # from the files' footers
            if n == 0:
                return df
            dups = bounded_broadcast(dups, n)
        cond = reduce(lambda a, b: a & b,
                      [F.col(c).eqNullSafe(F.col(alias[c])) for c in self.columns])
        joined = df.join(dups, cond, "left")
        failed = F.col("_uq_hit").isNotNull()
        return (joined.withColumn(REASON, _reason(F.col(REASON), failed, self.text()))
                .select(*df.columns))


@dataclass(frozen=True)
class ForeignKey:
    columns: tuple[str, ...]
    ref: DataFrame
    reason: str
    ref_columns: tuple[str, ...] | None = None
    ref_rows: int | None = None

    def apply(self, df: DataFrame, store: Store | None = None) -> DataFrame:
        ref_cols = self.ref_columns or self.columns
        most = config.BROADCAST_MAX_KEY_ROWS if len(self.columns) == 1 \
            else config.BROADCAST_MAX_ROWS
        if store is not None and (self.ref_rows is None or self.ref_rows > most):
            df = store(df)  # the join below reads it several times
        alias = {c: f"_fk_{i}" for i, c in enumerate(self.columns)}
        keys = (self.ref.select(*[F.col(r).alias(alias[c])
                                  for c, r in zip(self.columns, ref_cols)])
                .distinct().withColumn("_fk_hit", F.lit(True)))
        keyed = df.withColumns({alias[c]: F.col(c) for c in self.columns})
        joined = skew_join(keyed, keys, list(alias.values()), "left", self.ref_rows, most)
        failed = F.col("_fk_hit").isNull()
        return (joined.withColumn(REASON, _reason(F.col(REASON), failed, self.reason))
                .select(*df.columns))


def validate(df: DataFrame, rules: Sequence, store: Store | None = None) -> DataFrame:
    """Apply rules in order; returns ``df`` plus ``error_reason``.

    A uniqueness rule reads its input twice (rows and per-key counts), and a
    foreign-key rule several times if its reference is too large to broadcast;
    with ``store`` that input is written first, so upstream scans and joins
    run once and a lost executor costs a read of files.
    """
    flagged = df.withColumn(REASON, F.lit(None).cast("string"))
    for rule in rules:
        flagged = rule.apply(flagged) if isinstance(rule, NotNull) else rule.apply(flagged, store)
    return flagged


def split(flagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    valid = flagged.filter(F.col(REASON).isNull()).drop(REASON)
    rejects = flagged.filter(F.col(REASON).isNotNull())
    return valid, rejects


def split_null_rejects(df: DataFrame, required: Sequence[str]):
    return split(validate(df, [NotNull(tuple(required))]))


def split_duplicate_rejects(df: DataFrame, keys: Sequence[str], store: Store | None = None):
    """Every copy of a duplicated key is rejected; none survives."""
    return split(validate(df, [Unique(tuple(keys))], store))


def reject_missing_reference(df: DataFrame, ref: DataFrame, keys: Sequence[str], reason: str,
                             ref_rows: int | None = None):
    """(rows whose key exists in ``ref``, rows whose key does not, with reason).
    Null keys never match and are rejected."""
    return split(validate(df, [ForeignKey(tuple(keys), ref, reason, ref_rows=ref_rows)]))


def reject_records(rejects: DataFrame, job_name: str, target_table: str) -> DataFrame:
    """Reject-log rows: job, target, reason and the JSON of the other columns
    (null fields omitted)."""
    payload = [c for c in rejects.columns if c != REASON]
    return rejects.select(
        F.lit(job_name).alias("job_name"),
        F.lit(target_table).alias("target_table"),
        F.col(REASON).alias(REASON),
        payload_json(payload).alias("payload"),
    )


def union_rejects(*frames: DataFrame) -> DataFrame:
    """Union by name; columns missing on one side become null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def key_counts(df: DataFrame, keys: Sequence[str], out: str = "key_count") -> DataFrame:
    """``count(*) OVER (PARTITION BY keys)`` as an aggregate joined back
    null-safely (null keys form one group). The per-key counts are
    pre-aggregated map-side, so a hot key never moves as raw rows into one
    window partition."""
    alias = {c: f"_kc_{i}" for i, c in enumerate(keys)}
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out)).select(
        *[F.col(c).alias(alias[c]) for c in keys], out)
    cond = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(alias[c])) for c in keys])
    return df.join(counts, cond, "inner").select(*df.columns, out)
