"""Mixing sources to target weights by systematic sampling.

The sources share ``share`` times the words of all documents by weight. No
target exceeds ``cap`` times its source's words; the excess is shared again
by weight among the others until none is above. (In order of cap to weight
the capped sources come first, so running sums give the level at once.)

A document's expected copies are its source's target over its words. In the
order of document size the expected copies are summed within the source, one
random offset per source is added, and a document is emitted once for each
integer boundary crossed: the floor or the ceiling of its expectation.
Because the order is by size, what one document gets too much its neighbour
of almost the same size gets too little: a source's words differ from its
target by one large document at most. The arithmetic is in whole numbers
(2^-24 copies), so a rerun gives the same rows.

Defined results: a null text has no words; null is a source of its own;
repeated rows are sampled one by one; a source without words has the target
0 and no copies; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orrery.llm.common import written
from orrery.llm.prefix import ranked_rows, with_span
from orrery.llm.quality import words_of
from orrery.session import unique_name

SHARE = 1.5
CAP = 2.0
SEED = "mix-1"
#: Weights by turns, in the order of the sources' code points, null last.
TURNS = (5, 2, 1)
#: Binary places of copies: positions up to 2^38 in a source fit 64 bits.
_PLACES = 24


def weights_by_turns(sizes: DataFrame, turns: tuple = TURNS) -> DataFrame:
    """(source, weight). ``sizes`` has one row per source."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(order) - 1) % len(turns)
    return sizes.select("source", F.array(*[F.lit(float(w)) for w in turns])[turn]
                        .alias("weight"))


def targets(sizes: DataFrame, weights: DataFrame, share: float = SHARE,
            cap: float = CAP) -> DataFrame:
    """(source, source_size, target) from (source, source_size) and (source,
    weight), one row per source each."""
    s = sizes.alias("s").join(weights.alias("w"),
                              F.col("s.source").eqNullSafe(F.col("w.source")), "left") \
        .select("s.source", "source_size", F.coalesce("weight", F.lit(0.0)).alias("weight"),
                (F.col("source_size") * cap).alias("most"))
    everything = Window.partitionBy()
    before = Window.orderBy(F.try_divide("most", "weight").asc_nulls_last(),
                            F.col("source").asc_nulls_last()) \
        .rowsBetween(Window.unboundedPreceding, -1)
    sure = F.coalesce(F.sum("most").over(before), F.lit(0.0))
    used = F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    s = s.withColumn("to_share", F.sum("source_size").over(everything) * share - sure) \
        .withColumn("open", F.sum("weight").over(everything) - used)
    full = (F.col("weight") > 0) & (F.col("most") * F.col("open")
                                    <= F.col("to_share") * F.col("weight"))
    # The level is that of the first source that is not full; the later ones,
    # from which too much is subtracted, have lower values.
    level = F.max(F.when(~full & (F.col("weight") > 0),
                         F.try_divide("to_share", "open"))).over(everything)
    return s.withColumn("level", level).select(
        "source", "source_size",
        F.when(full, F.col("most")).when(F.col("weight") > 0, F.least(
            F.col("most"), F.col("level") * F.col("weight"))).otherwise(0.0).alias("target"))


def sample(docs: DataFrame, weights: DataFrame | None = None, text: str = "text",
           source: str = "source", ids: str = "doc_id", share: float = SHARE, cap: float = CAP,
           seed: str = SEED, keep: list[str] | None = None) -> DataFrame:
    """(row: columns ``keep``, source, size, source_size, target, copies)."""
    keep = docs.columns if keep is None else keep
    sized = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"),
        F.col(f"`{source}`").alias("source"), F.col(f"`{ids}`").alias("id"),
        F.xxhash64(f"`{text}`").alias("hash"),
        F.size(words_of(F.col(f"`{text}`"))).cast("long").alias("size"))
    rows, spans = ranked_rows(sized.select("row", "source", "size", "id", "hash"),
                              F.col("source"),
                              [F.col("size"), F.col("id"), F.col("hash")], "mix")
    sizes = rows.groupBy(F.col("group").alias("source")).agg(
        F.sum("row.size").alias("source_size"))
    goal = targets(sizes, weights if weights is not None else weights_by_turns(sizes),
                   share, cap)
    offset = F.conv(F.substring(F.md5(F.concat(F.lit(seed), F.coalesce(
        F.concat(F.lit(":"), F.col("source")), F.lit("")))), 1, 6), 16, 10).cast("bigint")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    goal = goal.select(F.col("source").alias("goal_source"), "source_size", "target",
                       F.floor(rate * (1 << _PLACES)).cast("bigint").alias("rate"),
                       offset.alias("shift"))
    # Each partition's share of a source carries the source's goal, so the
    # rows themselves are joined with that small table only.
    known = spans.join(goal, F.col("group").eqNullSafe(F.col("goal_source"))).drop("goal_source")
    placed = with_span(rows, known)
    low = (F.col("at") - F.col("first") + F.col("offset")) * F.col("rate") + F.col("shift")
    return placed.select(
        "row.row", "row.source", "row.size", "source_size", "target",
        (F.shiftright(low + F.col("rate"), _PLACES) - F.shiftright(low, _PLACES)).alias("copies"))


def mix(docs: DataFrame, ids: str = "doc_id", **params) -> DataFrame:
    """The mixed corpus: each document as often as it has copies; columns as
    given. The sampling moves ids, sizes and row hashes; rows are then looked
    up once. Rows repeated in full are interchangeable: their copies together
    are made of one of them."""
    hashed = [f"`{f.name}`" for f in docs.schema.fields if not isinstance(f.dataType, T.MapType)]
    key = unique_name("_row")
    keyed = docs.withColumn(key, F.xxhash64(*hashed))
    found = sample(keyed, ids=ids, keep=[ids, key], **params)
    taken = written(found.groupBy(
        F.col("row")[ids].alias("_id"), F.col("row")[key].alias("_key")).agg(
        F.sum("copies").alias("_copies"), F.count(F.lit(1)).alias("_rows"))
        .filter("_copies > 0"), "copies")
    rows = keyed.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                        F.col(f"`{ids}`").alias("id"), F.col(f"`{key}`").alias("key"))
    # Merged at every size: a row of the small side for each document.
    met = rows.join(taken.hint("merge"), F.col("id").eqNullSafe(F.col("_id"))
                    & (F.col("key") == F.col("_key")))
    many = met.filter("_rows > 1").groupBy("id", "key").agg(
        F.first("row").alias("row"), F.first("_copies").alias("_copies"))
    return met.filter("_rows = 1").select("row", "_copies").unionByName(
        many.select("row", "_copies")).select(
        "row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies")))).select("row.*")
