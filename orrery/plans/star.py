"""Gold star schema: item, tag and user dimensions, item-tag bridge, rating
fact (jobs B3-B7), each as a flagged frame (``error_reason`` null = valid).
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orrery import config
from orrery.operators.joins import bounded_broadcast
from orrery.operators.numbering import global_row_number
from orrery.operators.quality import REASON, ForeignKey, NotNull, Store, Unique, validate
from orrery.plans.silver import item_tags

DIM_ITEM_COLUMNS = ["item_id", "name", "kind", "units", "is_open", "score", "members"]
DIM_TAG_COLUMNS = ["tag_id", "tag_name"]
BRIDGE_COLUMNS = ["item_id", "tag_id"]
FACT_COLUMNS = ["user_id", "item_id", "rating"]
DIM_USER_COLUMNS = ["user_id", "user_total_reviews", "user_average_given_rating"]
RECO_COLUMNS = ["user_id", "item_id", "predicted_rating", "rank"]

# Within-file sort order of each published table (row-group pruning for
# lookups by these keys).
SORT_KEYS = {
    "dim_item": ["item_id"],
    "dim_tag": ["tag_id"],
    "bridge_item_tag": ["item_id", "tag_id"],
    "fact_ratings": ["user_id", "item_id"],
    "dim_user": ["user_id"],
    "recommendations": ["user_id", "rank"],
}

# Tables dealt out by ranges of those keys, for lookups of one user.
CLUSTERED = {"fact_ratings", "dim_user", "recommendations"}

ITEM_NOT_FOUND = config.REASON_NOT_FOUND.format(column="item_id", table="dim_item")
TAG_NOT_FOUND = config.REASON_NOT_FOUND.format(column="tag_name", table="dim_tag")


def dim_item_rows(items: DataFrame) -> DataFrame:
    return items.select(
        F.col("item_id").cast("int"), "name", "kind",
        F.col("units").cast("int"), F.col("is_open").cast("boolean"),
        F.col("score").cast("float"), F.col("members").cast("int"),
    )


def validate_dim_item(items: DataFrame, store: Store | None = None) -> DataFrame:
    """Not-null (item_id, name) -> unique item_id."""
    return validate(dim_item_rows(items), [NotNull(("item_id", "name")), Unique(("item_id",))],
                    store)


def validate_dim_tag(items: DataFrame, store: Store | None = None) -> DataFrame:
    """Distinct tag names numbered alphabetically from 1, then
    not-null -> unique id -> unique name."""
    names = item_tags(items).select("tag_name").distinct()
    numbered = global_row_number(names, ["tag_name"], "tag_id").select(
        F.col("tag_id").cast("int"), "tag_name")
    return validate(numbered, [NotNull(("tag_id", "tag_name")), Unique(("tag_id",)),
                               Unique(("tag_name",))], store)


def bridge_stages(items: DataFrame, dim_tag: DataFrame, dim_item: DataFrame,
                  tag_rows: int | None = None, item_rows: int | None = None,
                  store: Store | None = None):
    """B5 in two stages, as (tag lookup flagged, bridge flagged).

    Stage 1 resolves tag names to ids with one left join against the tag
    dimension (broadcast when its published row count is bounded); a name
    without id is rejected. Stage 2 validates (item_id, tag_id): not-null ->
    item exists -> unique pair.
    """
    tags = bounded_broadcast(dim_tag.select("tag_name", "tag_id"), tag_rows)
    looked_up = item_tags(items).join(tags, "tag_name", "left").select(
        "item_id", "tag_name", "tag_id")
    stage1 = looked_up.withColumn(
        REASON, F.when(F.col("tag_id").isNull(), F.lit(TAG_NOT_FOUND)).cast("string"))
    resolved = stage1.filter(F.col(REASON).isNull()).select(*BRIDGE_COLUMNS)
    stage2 = validate(resolved, [
        NotNull(("item_id", "tag_id")),
        ForeignKey(("item_id",), dim_item, ITEM_NOT_FOUND, ref_rows=item_rows),
        Unique(("item_id", "tag_id")),
    ], store)
    return stage1, stage2


def bridge_rejects(stage1: DataFrame, stage2: DataFrame) -> DataFrame:
    """Union of both stages' rejects by name; missing columns become null
    (and drop out of the JSON payload)."""
    r1 = stage1.filter(F.col(REASON).isNotNull()).select("item_id", "tag_name", REASON)
    r2 = stage2.filter(F.col(REASON).isNotNull())
    return r1.unionByName(r2, allowMissingColumns=True)


def fact_rows(ratings: DataFrame) -> DataFrame:
    return ratings.select(F.col("user_id").cast("int"), F.col("item_id").cast("int"),
                          F.col("rating").cast("int"))


def validate_fact(ratings: DataFrame, dim_item: DataFrame, item_rows: int | None = None,
                  store: Store | None = None) -> DataFrame:
    """Not-null (user, item) -> item exists -> unique (user, item)."""
    return validate(fact_rows(ratings), [
        NotNull(("user_id", "item_id")),
        ForeignKey(("item_id",), dim_item, ITEM_NOT_FOUND, ref_rows=item_rows),
        Unique(("user_id", "item_id")),
    ], store)


def dim_user_rows(fact: DataFrame) -> DataFrame:
    """Per user: list size (rated or not) and average of the given ratings."""
    return fact.groupBy("user_id").agg(
        F.count(F.lit(1)).cast("int").alias("user_total_reviews"),
        F.avg("rating").cast("float").alias("user_average_given_rating"),
    )


def validate_dim_user(fact: DataFrame, store: Store | None = None) -> DataFrame:
    """Derived from the fact; not-null -> unique user."""
    return validate(dim_user_rows(fact), [NotNull(("user_id",)), Unique(("user_id",))], store)


@dataclass(frozen=True)
class _Keys:
    """A key that one table owns, and the (table, columns) that refer to it."""
    table: str
    name: str
    columns: tuple[str, ...]
    required: tuple[str, ...] = ()
    references: tuple[tuple[str, str, tuple[str, ...]], ...] = ()


_DECLARED = (
    _Keys("dim_item", "primary_key", ("item_id",), ("item_id", "name"),
          (("bridge_item_tag", "fk_item", ("item_id",)), ("fact_ratings", "fk_item", ("item_id",)),
           ("recommendations", "fk_item", ("item_id",)))),
    _Keys("dim_tag", "primary_key", ("tag_id",), ("tag_id", "tag_name"),
          (("bridge_item_tag", "fk_tag", ("tag_id",)),)),
    _Keys("dim_tag", "unique_name", ("tag_name",)),
    _Keys("bridge_item_tag", "primary_key", ("item_id", "tag_id"), ("item_id", "tag_id")),
    _Keys("fact_ratings", "primary_key", ("user_id", "item_id"), ("user_id", "item_id")),
    _Keys("dim_user", "primary_key", ("user_id",), ("user_id",)),
    _Keys("recommendations", "primary_key", ("user_id", "rank"), ("user_id", "item_id", "rank")),
)


def constraint_audit(dim_item: DataFrame, dim_tag: DataFrame, bridge: DataFrame,
                     fact: DataFrame, dim_user: DataFrame, recos: DataFrame) -> DataFrame:
    """Violations per declared constraint of the gold tables (all 0 when the
    tables came out of validation).

    Each table is scanned once: a row gives one entry per key it owns and per
    key it refers to, tagged with the key's number. One grouping by (number,
    key) then counts owners and references together, so that a column's
    primary key and all its foreign keys share an exchange; partial counts go
    ahead of it, so a hot item is one entry per task. Duplicates are the rows
    of keys owned twice or more; a reference is an orphan if nobody owns its
    key, and a null reference is none (as in SQL)."""
    frames = {"dim_item": dim_item, "dim_tag": dim_tag, "bridge_item_tag": bridge,
              "fact_ratings": fact, "dim_user": dim_user, "recommendations": recos}

    def entry(number, columns, role, nulls):
        text = columns == ("tag_name",)
        whole = [F.lit(None).cast("bigint") if text or k >= len(columns)
                 else F.col(columns[k]).cast("bigint") for k in range(2)]
        name = F.col(columns[0]) if text else F.lit(None).cast("string")
        return F.struct(F.lit(number).alias("number"), whole[0].alias("k1"), whole[1].alias("k2"),
                        name.alias("name"), F.lit(role).alias("role"), nulls.alias("nulls"))

    def entries(table):
        found = []
        for number, keys in enumerate(_DECLARED):
            if keys.table == table:
                missing = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in keys.required],
                                 F.lit(False))
                found.append(entry(number, keys.columns, 0, F.when(missing, 1).otherwise(0)))
            found += [entry(number, columns, role, F.lit(0))
                      for role, (source, _, columns) in enumerate(keys.references, 1)
                      if source == table]
        return frames[table].select(F.inline(F.array(*found)))

    roles = 1 + max(len(keys.references) for keys in _DECLARED)
    per_key = reduce(DataFrame.unionByName, map(entries, frames)) \
        .groupBy("number", "k1", "k2", "name") \
        .agg(*[F.count(F.when(F.col("role") == r, 1)).alias(f"n{r}") for r in range(roles)],
             F.sum("nulls").alias("nulls"))

    found, sums = [], []

    def row(table, name, number, value):
        column = f"v{len(sums)}"
        sums.append(F.sum(F.when(F.col("number") == number, value)).alias(column))
        found.append(F.struct(F.lit(table).alias("table_name"), F.lit(name).alias("constraint_name"),
                              F.coalesce(column, F.lit(0)).cast("bigint").alias("violations")))

    for number, keys in enumerate(_DECLARED):
        if keys.required:
            row(keys.table, "not_null", number, F.col("nulls"))
        row(keys.table, keys.name, number, F.when(F.col("n0") > 1, F.col("n0")))
        for role, (source, name, _) in enumerate(keys.references, 1):
            row(source, name, number,
                F.when((F.col("n0") == 0) & F.col("k1").isNotNull(), F.col(f"n{role}")))
    return per_key.agg(*sums).select(F.inline(F.array(*found)))
