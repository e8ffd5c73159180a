"""A key holding a third of the rows: validation stays correct, counts are
pre-aggregated map-side, hot join keys stay out of the shuffle, and AQE splits
the hot partition of the uniqueness rule."""

from pyspark.sql import functions as F

import contextlib

import pytest

from orrery.operators.cleaning import first_row_per_key, max_per_key
from orrery.operators.joins import hot_keys, skew_join
from orrery.operators.quality import REASON, ForeignKey, Unique, validate

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@contextlib.contextmanager
def skew_settings(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    try:
        for k, v in SKEW_CONF.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def hot_frame(spark, n=300_000):
    """Key 7 holds a third of the rows."""
    return spark.range(0, n, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("k"),
        F.col("id").alias("v"))


def partition_rows(df):
    """Rows of each task of the frame's last stage."""
    return sorted(r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect())


def test_hot_key_in_foreign_key_rule(spark):
    with skew_settings(spark):
        df = hot_frame(spark)
        ref = spark.range(0, 300_000, 2).select(F.col("id").alias("k"))
        flagged = validate(df, [ForeignKey(("k",), ref, "missing")])
        rows = flagged.filter(F.col(REASON).isNull()).count()
        assert rows == df.join(ref, "k", "left_semi").count()
        assert flagged.count() == 300_000 and flagged.columns == ["k", "v", REASON]
        sizes = partition_rows(flagged)
        assert sizes[-1] <= 4 * sizes[len(sizes) // 2]


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("max_rows", [10, 0])
def test_skew_join_is_the_plain_join(spark, how, max_rows):
    with skew_settings(spark):
        df = hot_frame(spark, 30_000).select(
            F.when(F.col("v") % 10 == 1, None).otherwise(F.col("k")).alias("k"),
            (F.col("v") % 3).alias("j"), "v")
        dim = spark.range(0, 30_000, 2).unionByName(spark.range(7, 8)).unionByName(
            spark.range(7, 8)).select(F.col("id").alias("k"), (F.col("id") % 3).alias("j"),
                                      (F.col("id") * 2).alias("x"))
        for on in (["k"], ["k", "j"]):
            facts = dim.select(*on, "x")
            got = skew_join(df, facts, on, how, max_rows=max_rows)
            want = df.join(facts, on, how)
            assert got.columns == want.columns
            assert got.exceptAll(want).count() == 0 and got.count() == want.count()
            sizes = partition_rows(got)
            assert sizes[-1] <= 4 * sizes[len(sizes) // 2]
            assert "skew=true" not in got._jdf.queryExecution().executedPlan().toString()
    assert hot_keys(df.filter("k is null"), ["k"], 8).count() == 0
    assert skew_join(df.limit(0), facts, on, how).count() == 0


def test_recommendations_of_few_items_are_not_shuffled_by_item(spark, sf_small):
    """Popular items are in every user's list: hot keys that stay in place."""
    from dataclasses import replace

    from orrery.plans import analytics
    from orrery.plans.warehouse import gold

    g = gold(spark, sf_small)
    with skew_settings(spark):
        unknown = replace(g, rows={})  # no table is known to be small
        for fn in (analytics.user_recommendations, analytics.reco_tag_histogram,
                   analytics.user_history_top, analytics.user_tag_histogram):
            assert sorted(map(tuple, fn(unknown).collect()), key=str) == sorted(
                map(tuple, fn(g).collect()), key=str)
        sizes = partition_rows(analytics.user_recommendations(unknown))
        assert sizes[-1] <= 4 * sizes[len(sizes) // 2]


def test_dedup_collapses_hot_key_map_side(spark):
    df = hot_frame(spark)
    first = first_row_per_key(df, ["k"], ["v"])
    assert first.filter("k = 7").first().v == 0
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan
    best = max_per_key(df, ["k"], "v")
    assert best.filter("k = 7").first().v == 299_997
    assert "partial_max" in best._jdf.queryExecution().executedPlan().toString()


def test_hot_key_in_uniqueness_rule(spark):
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        n = 300_000
        df = spark.range(0, n, 1, 8).select(
            F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("k"),
            F.col("id").alias("v"))
        flagged = validate(df, [Unique(("k",))])
        out = flagged.groupBy(F.col(REASON).isNull().alias("ok")).count().collect()
        counts = {r.ok: r["count"] for r in out}
        hot = n // 3  # ids 0, 3, 6, ... -> key 7, plus id 7 itself
        assert counts == {False: hot + 1, True: n - hot - 1}
        flagged.collect()
        plan = flagged._jdf.queryExecution().executedPlan().toString()
        assert "partial_count" in plan
        assert "skew=true" in plan
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_hot_user_in_top_n_is_limited_before_the_shuffle(spark):
    from orrery.plans.recommend import top_n_per_user

    cands = spark.range(0, 300_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 1000).cast("int")
        .alias("user_id"),
        F.col("id").cast("int").alias("item_id"),
        (F.col("id") % 97).cast("float").alias("predicted_rating"))
    top = top_n_per_user(cands)
    hot = top.filter("user_id = 7").orderBy("rank").collect()
    assert [r["rank"] for r in hot] == list(range(1, 11))
    assert all(r.predicted_rating == 96.0 for r in hot)
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


@pytest.mark.parametrize("hot", [False, True])
def test_tag_histograms_deal_rows_to_as_many_tasks_as_they_need(spark, sf_small, hot):
    """More rows than the shuffle partitions hold: more partitions, the same
    counts, and no task that counts more than its share."""
    from dataclasses import replace

    from orrery.plans import analytics
    from orrery.plans.warehouse import gold

    g = gold(spark, sf_small)
    if hot:  # one user lists half of the rows
        half = F.when(F.col("item_id") % 2 == 0, F.lit(7)).otherwise(F.col("user_id"))
        g = replace(g, fact=g.fact.withColumn("user_id", half.cast("int")),
                    recommendations=g.recommendations.withColumn("user_id", half.cast("int")))
    for fn, table in ((analytics.user_tag_histogram, "fact_ratings"),
                      (analytics.reco_tag_histogram, "recommendations")):
        want = sorted(map(tuple, fn(g).collect()))
        rows = g.rows[table] * g.rows["bridge_item_tag"] // g.rows["dim_item"]
        with skew_settings(spark):
            got = fn(g, most=rows // 40)
            assert got.rdd.getNumPartitions() >= 40
            assert sorted(map(tuple, got.collect())) == want
            shuffled = replace(g, rows={**g.rows, "bridge_item_tag": 3_000_000})
            assert sorted(map(tuple, fn(shuffled, most=10**6).collect())) == want
