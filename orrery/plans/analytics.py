"""Dashboard analytics (D1-D23) as DataFrame functions of the gold tables.

Filters are composed from Columns (no SQL text built from user input). The
post-processing the dashboard did in pandas (merges, group means, quantile
bins, medians, samples) runs in the Spark plan; only final small tables
leave it. Every top-k has a total order (the key is the last tie-break).
Per-user queries take an optional list of users; without it they answer
for all users at once (window top-k per user).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orrery import config
from orrery.functions.columns import round2
from orrery.operators.histogram import equal_width_histogram
from orrery.operators.joins import bounded_broadcast, hot_keys, skew_join
from orrery.operators.sampling import seeded_sample
from orrery.operators.selection import middle_ranks, order_statistics


@dataclass
class Gold:
    dim_item: DataFrame
    dim_tag: DataFrame
    bridge: DataFrame
    fact: DataFrame
    dim_user: DataFrame
    recommendations: DataFrame
    rows: dict = field(default_factory=dict)

    def tags(self) -> DataFrame:
        """The tag dimension, broadcast when its published size is bounded."""
        return bounded_broadcast(self.dim_tag, self.rows.get("dim_tag"))

    def views(self, spark: SparkSession) -> None:
        for name in ("dim_item", "dim_tag", "bridge", "fact", "dim_user", "recommendations"):
            getattr(self, name).createOrReplaceTempView(
                {"bridge": "bridge_item_tag", "fact": "fact_ratings"}.get(name, name))


def _count(df: DataFrame):
    return df.agg(F.count(F.lit(1))).scalar()


def _only(df: DataFrame, user_ids: Sequence[int] | None) -> DataFrame:
    return df.filter(F.col("user_id").isin(list(user_ids))) if user_ids else df


def _ordered(df: DataFrame, user_ids: Sequence[int] | None, *order) -> DataFrame:
    """The dashboard's display order for a lookup of a few users; the
    all-users form stays unordered (no global sort)."""
    return df.orderBy("user_id", *order) if user_ids else df


# ---- overview ---------------------------------------------------------------

def kpi_overview(g: Gold) -> DataFrame:
    """Items, users, given ratings, tags -- one row, four scalar aggregates."""
    return g.dim_tag.agg(F.count(F.lit(1)).alias("n_tags")).select(
        _count(g.dim_item).alias("n_items"),
        _count(g.dim_user).alias("n_users"),
        _count(g.fact.filter(F.col("rating").isNotNull())).alias("n_ratings"),
        "n_tags")


def score_histogram(g: Gold, bins: int = config.SCORE_BINS) -> DataFrame:
    """Equal-width bins of the item score."""
    return equal_width_histogram(g.dim_item, "score", bins)


def kind_distribution(g: Gold) -> DataFrame:
    """D3: items per non-null kind, largest first."""
    return (g.dim_item.filter(F.col("kind").isNotNull()).groupBy("kind")
            .agg(F.count(F.lit(1)).alias("nb")).orderBy(F.desc("nb"), "kind"))


def top_items_by_score(g: Gold, n: int = config.TOP_ITEMS,
                       min_members: int = config.TOP_ITEMS_MIN_MEMBERS) -> DataFrame:
    """Best scores among items with more than ``min_members`` (strict)."""
    return (g.dim_item.filter(F.col("score").isNotNull() & (F.col("members") > min_members))
            .orderBy(F.desc("score"), F.desc("members"), "item_id").limit(n)
            .select("item_id", "name", "kind", "score", "members"))


def kind_list(g: Gold) -> DataFrame:
    """Distinct non-null kinds, sorted."""
    return g.dim_item.filter(F.col("kind").isNotNull()).select("kind").distinct().orderBy("kind")


def tag_list(g: Gold) -> DataFrame:
    """Tag names, sorted."""
    return g.dim_tag.select("tag_name").orderBy("tag_name")


# ---- catalogue ----------------------------------------------------------------

def item_tag_map(g: Gold) -> DataFrame:
    """(item_id, tag_name) through the bridge."""
    return g.bridge.join(g.tags(), "tag_id").select("item_id", "tag_name")


def catalog_filter(g: Gold, kinds: Sequence[str] | None = None,
                   tags: Sequence[str] | None = None,
                   min_members: int = config.CATALOG_MIN_MEMBERS,
                   min_score: float = config.CATALOG_MIN_SCORE) -> DataFrame:
    """Scored items with members >= and score >= the minimums, a kind
    list and an optional tag list that an item must carry completely
    (relational division: count of distinct matching tags = number of wanted
    tags). Without ``kinds`` every listed kind is selected, as the page
    starts, so items without a kind are left out; an empty list is no filter."""
    items = g.dim_item.filter(F.col("score").isNotNull()
                              & (F.col("members") >= min_members)
                              & (F.col("score") >= min_score))
    if kinds is None:
        items = items.filter(F.col("kind").isNotNull())
    elif kinds:
        items = items.filter(F.col("kind").isin(list(kinds)))
    if tags:
        wanted = sorted(set(tags))
        # The wanted tag rows are bounded by the length of the list.
        chosen = F.broadcast(g.dim_tag.filter(F.col("tag_name").isin(wanted)))
        having_all = (g.bridge.join(chosen, "tag_id").groupBy("item_id")
                      .agg(F.count_distinct("tag_name").alias("_n"))
                      .filter(F.col("_n") == len(wanted)).select("item_id"))
        items = items.join(having_all, "item_id", "left_semi")
    return items.select("item_id", "name", "kind", "units", "score", "members")


def catalog_top(items: DataFrame, n: int = config.CATALOG_TOP) -> DataFrame:
    """Best n of a selection by (score desc, members desc, id)."""
    return (items.orderBy(F.desc("score"), F.desc("members"), "item_id").limit(n)
            .select("item_id", "name", "kind", "units", "score", "members"))


def catalog_score_histogram(items: DataFrame, bins: int = config.CATALOG_SCORE_BINS):
    """D8."""
    return equal_width_histogram(items, "score", bins)


def catalog_points(items: DataFrame) -> DataFrame:
    """(members, score, kind) points of the selection."""
    return items.select("item_id", "name", "kind", "members", "score")


def tag_score_ranking(g: Gold, items: DataFrame, min_items: int = config.TAG_MIN_ITEMS,
                      top: int = config.TAG_TOP) -> DataFrame:
    """Mean score and item count per tag within the selection, tags
    with at least ``min_items`` items, best ``top`` by (mean, count, name)."""
    per_tag = (items.select("item_id", "score").join(item_tag_map(g), "item_id")
               .groupBy("tag_name")
               .agg(F.avg(F.col("score").cast("double")).alias("_avg"),
                    F.count_distinct("item_id").alias("n_items"))
               .filter(F.col("n_items") >= min_items))
    return (per_tag.orderBy(F.desc("_avg"), F.desc("n_items"), "tag_name").limit(top)
            .select("tag_name", round2("_avg").alias("avg_score"), "n_items"))


# ---- users ----------------------------------------------------------------------

def user_activity_bounds(g: Gold) -> DataFrame:
    """Smallest and largest list size."""
    return g.dim_user.agg(F.min("user_total_reviews").alias("min_reviews"),
                          F.max("user_total_reviews").alias("max_reviews"))


def band(avg_col, limits=config.BAND_LIMITS):
    lo, hi = limits
    return (F.when(avg_col < lo, F.lit("severe"))
            .when(avg_col.between(lo, hi), F.lit("moderate"))
            .when(avg_col > hi, F.lit("lenient")))


def user_band_filter(g: Gold, min_reviews: int = config.MIN_REVIEWS, which: str = "all",
                     limits=config.BAND_LIMITS) -> DataFrame:
    """Users with list size >= ``min_reviews``, a non-null average and,
    unless ``which`` is "all", the given severity band (limits inclusive
    for the middle band)."""
    users = g.dim_user.filter((F.col("user_total_reviews") >= min_reviews)
                              & F.col("user_average_given_rating").isNotNull())
    if which != "all":
        users = users.filter(band(F.col("user_average_given_rating"), limits) == which)
    return users.select("user_id", "user_total_reviews", "user_average_given_rating")


def user_band_counts(g: Gold, min_reviews: int = config.MIN_REVIEWS,
                     limits=config.BAND_LIMITS) -> DataFrame:
    """Users per severity band."""
    users = user_band_filter(g, min_reviews, "all", limits)
    return (users.groupBy(band(F.col("user_average_given_rating"), limits).alias("band"))
            .agg(F.count(F.lit(1)).alias("n_users")))


def user_group_summary(users: DataFrame) -> DataFrame:
    """Size of the group, its mean average rating and mean list size."""
    return users.agg(
        F.count(F.lit(1)).alias("n_users"),
        round2(F.avg(F.col("user_average_given_rating").cast("double"))).alias("mean_average"),
        round2(F.avg("user_total_reviews")).alias("mean_reviews"))


def user_activity_histogram(users: DataFrame, bins: int = config.ACTIVITY_BINS):
    """D14 (left)."""
    return equal_width_histogram(users, "user_total_reviews", bins)


def user_avg_histogram(users: DataFrame, bins: int = config.AVERAGE_BINS):
    """D14 (right)."""
    return equal_width_histogram(users, "user_average_given_rating", bins)


def user_sample(users: DataFrame, k: int = config.SAMPLE_SIZE, seed: int = config.SEED):
    """min(k, n) users, reproducible on any layout."""
    return seeded_sample(users, ["user_id"], k, seed)


def activity_trend(users: DataFrame, q_max: int = config.TREND_BINS) -> DataFrame:
    """Users ranked by (list size, id) into min(10, n) equal-frequency
    bins; exact median list size and median average per bin. The bins' last
    users and all medians are order statistics: no sort of the users. Empty
    when fewer than two users."""
    size, average = "user_total_reviews", "user_average_given_rating"
    n = users.filter(F.col(size).isNotNull()).count()
    q = min(q_max, n)
    # Rank r lies in bin max(1, ceil((r - 1) q / (n - 1))).
    last = {b: b * (n - 1) // q + 1 for b in range(1, q + 1)} if n >= 2 else {}
    first = {b: last.get(b - 1, 0) + 1 for b in last}
    middle = {b: [first[b] - 1 + k for k in middle_ranks(last[b] - first[b] + 1)] for b in last}
    sizes = order_statistics(users, size, [(None, r) for r in last.values()]
                             + [(None, r) for rs in middle.values() for r in rs])
    # The place of each bin's last user among those with as long a list.
    ends = {b: sizes[None, r] for b, r in last.items()}
    ties = order_statistics(users, "user_id", [(e.value, last[b] - e.below)
                                               for b, e in ends.items()], group=size)
    binned = F.lit(None).cast("int")
    for b, e in sorted(ends.items(), reverse=True):
        user = ties[e.value, last[b] - e.below].value
        binned = F.when((F.col(size) < e.value) | ((F.col(size) == e.value)
                                                   & (F.col("user_id") <= user)),
                        F.lit(b)).otherwise(binned)
    placed = users.select(binned.alias("bin"), average)
    rated = {r.bin: r.n for r in placed.groupBy("bin").agg(F.count(average).alias("n")).collect()}
    ranks = {b: middle_ranks(rated[b]) for b in last if rated.get(b)}
    averages = order_statistics(placed, average, [(b, k) for b, ks in ranks.items() for k in ks],
                                group="bin")
    rows = [(b, sum(sizes[None, r].value for r in middle[b]) / 2,
             sum(averages[b, k].value for k in ranks[b]) / 2 if b in ranks else None)
            for b in last if first[b] <= last[b]]
    return (users.sparkSession.createDataFrame(rows, "bin int, reviews double, average double")
            .select("bin",
                    F.round(F.col("reviews").cast("decimal(18,6)"), 4).cast("double")
                    .alias("median_reviews"),
                    F.round(F.col("average").cast("decimal(18,6)"), 4).cast("double")
                    .alias("median_average"))
            .orderBy("median_reviews", "bin"))


def top_active_users(users: DataFrame, n: int = config.TOP_USERS) -> DataFrame:
    """Largest lists first (ties by id), average rounded to 2."""
    return (users.orderBy(F.desc("user_total_reviews"), "user_id").limit(n)
            .select("user_id", "user_total_reviews",
                    round2("user_average_given_rating").alias("user_average_given_rating")))


# ---- recommendations page -----------------------------------------------------

def active_users_with_recos(g: Gold, n: int = config.TOP_USERS_WITH_RECOS) -> DataFrame:
    """Most active users that have recommendations (existence test as a
    semi join, no DISTINCT over a join)."""
    return (g.dim_user.join(g.recommendations.select("user_id"), "user_id", "left_semi")
            .orderBy(F.desc("user_total_reviews"), "user_id").limit(n)
            .select("user_id", "user_total_reviews",
                    round2("user_average_given_rating").alias("avg_rating")))


def user_reco_count(g: Gold, user_ids: Sequence[int] | None = None) -> DataFrame:
    """Recommendations per user."""
    return (_only(g.recommendations, user_ids).groupBy("user_id")
            .agg(F.count(F.lit(1)).alias("n_recommendations")))


def user_profile(g: Gold, user_ids: Sequence[int] | None = None) -> DataFrame:
    """D19 + D20: list size, average and number of recommendations."""
    return (_only(g.dim_user, user_ids).join(user_reco_count(g, user_ids), "user_id", "left")
            .select("user_id", "user_total_reviews", "user_average_given_rating",
                    F.coalesce(F.col("n_recommendations"), F.lit(0)).alias("n_recommendations")))


def user_history_top(g: Gold, n: int = config.HISTORY_TOP,
                     user_ids: Sequence[int] | None = None) -> DataFrame:
    """Each user's best-rated items, by (rating desc, members desc with
    nulls first, id); unrated rows excluded. The ranking sees (item, members)
    only; names and scores are joined to the ``n`` rows a user keeps."""
    rated = _only(g.fact, user_ids).filter(F.col("rating").isNotNull())
    order = g.dim_item.select("item_id", "members")
    w = Window.partitionBy("user_id").orderBy(F.desc("rating"), F.desc_nulls_first("members"),
                                              "item_id")
    out = (skew_join(rated, order, ["item_id"], dim_rows=g.rows.get("dim_item"),
                     max_rows=config.BROADCAST_MAX_KEY_ROWS)
           .withColumn("rank", F.row_number().over(w))
           .filter(F.col("rank") <= n))
    out = (skew_join(out, g.dim_item.select("item_id", "name", "kind", "score"), ["item_id"],
                     dim_rows=g.rows.get("dim_item"))
           .select("user_id", "rank", "item_id", "name", "kind",
                   round2("score").alias("score"), F.col("rating").alias("user_rating")))
    return _ordered(out, user_ids, "rank")


def user_recommendations(g: Gold, user_ids: Sequence[int] | None = None) -> DataFrame:
    """Recommendations with item attributes, scores rounded to 2."""
    items = g.dim_item.select("item_id", "name", "kind", "units", "score", "members")
    out = (skew_join(_only(g.recommendations, user_ids), items, ["item_id"],
                     dim_rows=g.rows.get("dim_item"))
           .select("user_id", "rank", "item_id", "name", "kind", "units",
                   round2("score").alias("score"), "members",
                   round2("predicted_rating").alias("predicted_score")))
    return _ordered(out, user_ids, "rank")


def _tag_counts(g: Gold, listed: DataFrame, rows: int | None, most: int) -> list[DataFrame]:
    """(user_id, tag_name, nb) of the pairs ``listed`` (``rows`` of them, None:
    few or unknown), in frames that share no user. Up to ``most`` rows with a
    tag for each shuffle partition, a partial aggregate counts them. With more
    there are as many partitions as these rows need, so that a task's memory
    does not grow with the table: rows are dealt out by user once, which
    serves the count and what follows by user; users with more rows than a
    partition holds on average are counted with a partial aggregate."""
    parts = int(listed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tagged, items = g.rows.get("bridge_item_tag"), g.rows.get("dim_item")
    need = -(-rows * max(tagged, items) // (max(items, 1) * most)) \
        if rows and tagged and items else 0

    def counts(pairs, by_user: bool) -> DataFrame:
        met = skew_join(pairs, g.bridge, ["item_id"], dim_rows=tagged,
                        max_rows=config.BROADCAST_MAX_KEY_ROWS,
                        partitions=need if need > parts else None)
        if by_user:
            met = met.repartition(need, "user_id")
        return met.groupBy("user_id", "tag_id").agg(F.count(F.lit(1)).alias("nb")) \
            .join(g.tags(), "tag_id").select("user_id", "tag_name", "nb")

    if need <= parts:
        return [counts(listed, False)]
    hot = hot_keys(listed, ["user_id"], need)
    if hot.isEmpty():
        return [counts(listed, True)]
    few = F.broadcast(hot)
    return [counts(listed.join(few, "user_id", "left_anti"), True),
            counts(listed.join(few, "user_id", "left_semi"), False)]


def user_tag_histogram(g: Gold, n: int = config.USER_TAG_TOP,
                       user_ids: Sequence[int] | None = None,
                       most: int = config.TASK_ROWS) -> DataFrame:
    """D23 (history): tag counts over each user's list -- rated or not --,
    first ``n`` by (count desc, name): counted per (user, tag), then a
    per-user group limit."""
    listed = _only(g.fact, user_ids).select("user_id", "item_id")
    w = Window.partitionBy("user_id").orderBy(F.desc("nb"), "tag_name")
    out = reduce(DataFrame.unionByName, [
        counts.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= n).drop("_r")
        for counts in _tag_counts(g, listed, None if user_ids else g.rows.get("fact_ratings"),
                                  most)])
    return _ordered(out, user_ids, F.desc("nb"), "tag_name")


def reco_tag_histogram(g: Gold, user_ids: Sequence[int] | None = None,
                       most: int = config.TASK_ROWS) -> DataFrame:
    """D23 (recommendations): tag counts over each user's recommendations."""
    listed = _only(g.recommendations, user_ids).select("user_id", "item_id")
    out = reduce(DataFrame.unionByName, _tag_counts(
        g, listed, None if user_ids else g.rows.get("recommendations"), most))
    return _ordered(out, user_ids, F.desc("nb"), "tag_name")


def one_user_page(g: Gold, user_id: int) -> dict[str, DataFrame]:
    """D19-D23 for one user, as the page asks them: each a lookup of the id
    (files and row groups of other users are skipped), with ``position`` for
    the display order."""
    def placed(df: DataFrame, *order) -> DataFrame:
        return df.withColumn("position", F.row_number().over(
            Window.partitionBy("user_id").orderBy(*order)))

    only = [user_id]
    return {
        "user_profile": user_profile(g, only),
        "user_reco_count": user_reco_count(g, only),
        "user_history_top": placed(user_history_top(g, user_ids=only), "rank"),
        "user_recommendations": placed(user_recommendations(g, only), "rank"),
        "user_tag_histogram": placed(user_tag_histogram(g, user_ids=only), F.desc("nb"),
                                     "tag_name"),
        "reco_tag_histogram": placed(reco_tag_histogram(g, only), F.desc("nb"), "tag_name"),
    }


def sql_over_gold(spark: SparkSession, g: Gold, sql: str, args: dict | None = None):
    """Parameterised SQL over the gold tables (named parameters, never
    string interpolation)."""
    g.views(spark)
    return spark.sql(sql, args=args or {})
