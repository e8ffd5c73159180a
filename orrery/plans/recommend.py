"""Recommender (M1-M6): candidates -> drop already-rated -> top N -> validate.

Two candidate sources feed the same chain: MLlib ALS (``recommendForAllUsers``)
and a deterministic popularity scorer whose output SQL can reproduce, so the
chain after scoring can be checked row for row.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orrery import config
from orrery.operators.products import top_products
from orrery.operators.quality import ForeignKey, NotNull, Store, Unique, validate
from orrery.operators.sampling import hash_split_flag
from orrery.plans.star import ITEM_NOT_FOUND, RECO_COLUMNS


def rated_pairs(fact: DataFrame, exclude_unrated: bool = False) -> DataFrame:
    """Pairs counting as already seen: rated ones, so seen-but-unrated items
    may be recommended; with ``exclude_unrated`` every listed pair counts."""
    seen = fact if exclude_unrated else fact.filter(F.col("rating").isNotNull())
    return seen.select("user_id", "item_id")


def training_set(fact: DataFrame) -> DataFrame:
    """M1: rated rows as int, int, float."""
    return fact.filter(F.col("rating").isNotNull()).select(
        F.col("user_id").cast("int"), F.col("item_id").cast("int"),
        F.col("rating").cast("float"))


def split_flagged(ratings: DataFrame, percent: int = config.TRAIN_PERCENT,
                  seed: int = config.SEED) -> DataFrame:
    """K8: ``split`` = train/test by a hash of (seed, user, item)."""
    flag = hash_split_flag(["user_id", "item_id"], percent, seed)
    return ratings.withColumn("split", F.when(flag, F.lit("train")).otherwise(F.lit("test")))


def train_test(ratings: DataFrame, percent: int = config.TRAIN_PERCENT,
               seed: int = config.SEED) -> tuple[DataFrame, DataFrame]:
    flagged = split_flagged(ratings, percent, seed)
    return (flagged.filter(F.col("split") == "train").drop("split"),
            flagged.filter(F.col("split") == "test").drop("split"))


# ---- candidate sources ------------------------------------------------------

def item_scores(fact: DataFrame) -> DataFrame:
    """Popularity score of an item: its average given rating (as float)."""
    return (fact.filter(F.col("rating").isNotNull()).groupBy("item_id")
            .agg(F.avg("rating").cast("float").alias("score")))


def popularity_candidates(dim_user: DataFrame, fact: DataFrame,
                          n: int = config.TOP_N * config.OVERSAMPLE) -> DataFrame:
    """Per user the global top-``n`` items by (score desc, item id), shaped
    like ``recommendForAllUsers``: (user_id, recommendations array<struct<
    item_id, rating>>).

    The list is built once (a top-n over the per-item aggregate, at most n
    rows) and attached to every user as a scalar subquery -- no cross join,
    no collect to the driver.
    """
    top = item_scores(fact).orderBy(F.desc("score"), "item_id").limit(n)
    w = Window.orderBy(F.desc("score"), "item_id")  # over the n-row list only
    listed = top.withColumn("_pos", F.row_number().over(w)).agg(
        F.sort_array(F.collect_list(F.struct("_pos", "item_id", F.col("score").alias("rating"))))
        .alias("recs"))
    recs = listed.select(F.transform("recs", lambda r: F.struct(
        r["item_id"].alias("item_id"), r["rating"].alias("rating"))))
    return dim_user.select("user_id", recs.scalar().alias("recommendations"))


def explode_candidates(candidates: DataFrame) -> DataFrame:
    """one row per (user, candidate item, predicted score)."""
    return candidates.select("user_id", F.explode("recommendations").alias("rec")).select(
        "user_id", F.col("rec.item_id").alias("item_id"),
        F.col("rec.rating").cast("float").alias("predicted_rating"))


def exclude_seen(candidates: DataFrame, seen: DataFrame) -> DataFrame:
    """Drop candidate pairs the user already rated (two-column anti join)."""
    return candidates.join(seen, ["user_id", "item_id"], "left_anti")


def top_n_per_user(candidates: DataFrame, n: int = config.TOP_N) -> DataFrame:
    """Rank 1..n per user by (score desc, item id); Spark plans a partial
    group limit before the shuffle, so at most n rows per user move."""
    w = Window.partitionBy("user_id").orderBy(F.desc("predicted_rating"), "item_id")
    return (candidates.withColumn("rank", F.row_number().over(w))
            .filter(F.col("rank") <= n).select(*RECO_COLUMNS))


def recommendation_chain(candidates: DataFrame, fact: DataFrame,
                         exclude_unrated: bool = False) -> DataFrame:
    """Flatten -> exclude rated -> top N (the M6 chain before validation)."""
    flat = explode_candidates(candidates)
    return top_n_per_user(exclude_seen(flat, rated_pairs(fact, exclude_unrated)))


def popularity_recommendations(dim_user: DataFrame, fact: DataFrame,
                               n: int = config.TOP_N * config.OVERSAMPLE,
                               top: int = config.TOP_N,
                               exclude_unrated: bool = False) -> DataFrame:
    """Popularity chain without exploding users x n candidate rows.

    Every user shares one n-item list, so a user's recommendations are that
    list minus the user's rated items among those n, first ``top`` kept.
    Per user: the rated listed items (a set of at most n, from a partial
    ``collect_set``) joined to the user, ``array_except`` against the ordered
    list, ``slice``, ``posexplode``. One shuffle of users instead of two
    shuffles of users x n rows; the result equals explode -> anti join ->
    top-N (checked by the oracle against both forms).
    """
    # The n-row list is computed once (one aggregate over the fact) and its
    # lineage cut, so every reference below reads n checkpointed rows.
    listed = item_scores(fact).orderBy(F.desc("score"), "item_id").limit(n).checkpoint()
    w = Window.orderBy(F.desc("score"), "item_id")  # over the n-row list only
    shared = (listed.withColumn("_pos", F.row_number().over(w))
              .agg(F.sort_array(F.collect_list(F.struct("_pos", "item_id", "score"))).alias("l"))
              .select(F.struct(
                  F.transform("l", lambda r: r["item_id"]).alias("ids"),
                  F.map_from_arrays(F.transform("l", lambda r: r["item_id"]),
                                    F.transform("l", lambda r: r["score"])).alias("scores"))))
    lst = shared.scalar()
    seen = (rated_pairs(fact, exclude_unrated)
            .filter(F.array_contains(lst.getField("ids"), F.col("item_id")))
            .groupBy("user_id").agg(F.collect_set("item_id").alias("_seen")))
    users = dim_user.select("user_id").join(seen, "user_id", "left")
    keep = F.slice(F.array_except(lst.getField("ids"),
                                  F.coalesce(F.col("_seen"), F.array().cast("array<int>"))),
                   1, top)
    picked = users.select("user_id", F.posexplode(keep).alias("_p", "item_id"))
    return picked.select(
        "user_id", "item_id",
        F.element_at(lst.getField("scores"), F.col("item_id")).cast("float")
        .alias("predicted_rating"),
        (F.col("_p") + 1).cast("int").alias("rank"))


def validate_recommendations(recos: DataFrame, dim_item: DataFrame,
                             item_rows: int | None = None, store: Store | None = None
                             ) -> DataFrame:
    """not-null (user, item, rank) -> item exists -> unique (user, rank)."""
    return validate(recos.select(*RECO_COLUMNS), [
        NotNull(("user_id", "item_id", "rank")),
        ForeignKey(("item_id",), dim_item, ITEM_NOT_FOUND, ref_rows=item_rows),
        Unique(("user_id", "rank")),
    ], store)


# ---- ALS ----------------------------------------------------------------------

def als_estimator(blocks: int = 10):
    """Explicit-feedback ALS with the fixed hyper-parameters. ``blocks`` sets
    the user and item block counts, i.e. the parallelism of each factor
    update; it must grow with the cluster (MLlib's default is 10)."""
    from pyspark.ml.recommendation import ALS

    return ALS(userCol="user_id", itemCol="item_id", ratingCol="rating",
               rank=config.ALS_RANK, maxIter=config.ALS_MAX_ITER,
               regParam=config.ALS_REG_PARAM, coldStartStrategy="drop", seed=config.SEED,
               numUserBlocks=blocks, numItemBlocks=blocks, checkpointInterval=1)


def train_als(train: DataFrame, blocks: int | None = None):
    """M2: explicit-feedback ALS on the training split; blocks default to the
    cluster's default parallelism. The item factors are checkpointed in every
    iteration into the shared checkpoint folder, which keeps the lineage short
    and survives lost executors; MLlib then deletes the checkpoint before and
    the shuffle files that led to this one, so the disk holds those of about
    one iteration (of ten with its default interval)."""
    blocks = blocks or max(1, train.sparkSession.sparkContext.defaultParallelism)
    return als_estimator(blocks).fit(train)


def als_candidates(model, n: int = config.TOP_N * config.OVERSAMPLE,
                   every: bool = False) -> DataFrame:
    """M5: top-n candidates for every user with factors, shaped like
    ``recommendForAllUsers``: the same products, found by exact search with
    bounds instead of all users x items. ``every`` multiplies out all pairs."""
    found = top_products(model.userFactors, model.itemFactors, n, every=every)
    return found.select(F.col("id").alias("user_id"), F.arrays_zip(
        F.col("ids").alias("item_id"), F.col("scores").cast("array<float>").alias("rating"))
        .alias("recommendations"))


def candidate_rules(candidates: DataFrame, all_pairs: DataFrame) -> DataFrame:
    """(rule, violations) of ``candidates`` against those that comparing all
    pairs gives: users that one of them lacks, lists of another length, and
    places whose products differ by more than rounding."""
    # Items are looked at where they are: only the products are shuffled.
    items = F.col("recommendations.item_id")
    a = candidates.select("user_id", F.col("recommendations.rating").alias("a"),
                          (F.size(items) != F.size(F.array_distinct(items))).alias("twice"))
    b = all_pairs.select("user_id", F.col("recommendations.rating").alias("b"))
    both = a.join(b, "user_id", "full")
    differ = F.exists(F.zip_with("a", "b", lambda x, y: F.abs(
        x - y) > 1e-4 * (1 + F.abs(y))), lambda bad: bad)
    rules = {
        "user missing": F.col("a").isNull() | F.col("b").isNull(),
        "length": F.size("a") != F.size("b"),
        "product": (F.size("a") == F.size("b")) & differ,
        "item twice": F.col("twice"),
    }
    counted = both.agg(*[F.count_if(c).alias(name) for name, c in rules.items()])
    return counted.select(F.inline(F.array(*[F.struct(
        F.lit(name).alias("rule"), F.col(name).alias("violations")) for name in rules])))


def rmse_frame(predictions: DataFrame, label: str = "rating",
               prediction: str = "prediction") -> DataFrame:
    """M4: one row (n_test, rmse) over predicted held-out pairs."""
    return predictions.agg(
        F.count(F.lit(1)).alias("n_test"),
        F.sqrt(F.avg(F.pow(F.col(label) - F.col(prediction), 2))).alias("rmse"))


def baseline_rmse(fact: DataFrame) -> DataFrame:
    """RMSE of predicting the training mean for every held-out pair: the bar
    ALS must beat; fully SQL-checkable."""
    train, test = train_test(training_set(fact))
    mean = train.agg(F.avg("rating")).scalar()
    return test.agg(
        F.count(F.lit(1)).alias("n_test"),
        F.round(F.sqrt(F.avg(F.pow(F.col("rating") - mean, 2))).cast("decimal(18,9)"), 6)
        .cast("double").alias("rmse"))


def recommendation_rules(recos: DataFrame, fact: DataFrame, user_factors: DataFrame,
                         item_factors: DataFrame) -> DataFrame:
    """(rule, violations): rated pairs recommended, ranks with a gap or above
    TOP_N, scores that rise with the rank, predictions that are not the
    product of the factors."""
    def row(rule, broken):
        return broken.agg(F.count(F.lit(1)).alias("violations")).select(
            F.lit(rule).alias("rule"), "violations")

    w = Window.partitionBy("user_id").orderBy("rank")
    steps = recos.withColumn("_at", F.row_number().over(w)) \
        .withColumn("_before", F.lag("predicted_rating").over(w))
    product = F.aggregate(F.zip_with("u", "i", lambda a, b: a.cast("double") * b),
                          F.lit(0.0), lambda total, x: total + x)
    scored = recos.join(user_factors.select(F.col("id").alias("user_id"),
                                            F.col("features").alias("u")), "user_id") \
        .join(item_factors.select(F.col("id").alias("item_id"), F.col("features").alias("i")),
              "item_id")
    rules = [
        row("rated pair", recos.join(rated_pairs(fact), ["user_id", "item_id"], "left_semi")),
        row("rank gap", steps.filter((F.col("rank") != F.col("_at"))
                                     | (F.col("rank") > config.TOP_N))),
        row("rising score", steps.filter("predicted_rating > _before")),
        row("not the product", scored.filter(
            F.abs(product - F.col("predicted_rating")) > 1e-3)),
    ]
    return reduce(DataFrame.unionByName, rules)
