"""Recommender chain properties (ALS output cannot be reproduced in SQL)."""

import re
import time

import numpy as np
from pyspark.sql import functions as F

from orrery.plans import recommend as R
from orrery.registry import QUERIES, als_model
from orrery.plans.warehouse import gold


def test_als_recommendations_properties(spark, sf_small):
    g = gold(spark, sf_small)
    recos = QUERIES["als_recommendations"](spark, sf_small)
    rows = recos.collect()
    assert rows
    rated = {(r.user_id, r.item_id) for r in R.rated_pairs(g.fact).collect()}
    by_user = {}
    for r in rows:
        assert (r.user_id, r.item_id) not in rated
        by_user.setdefault(r.user_id, []).append(r)
    for recs in by_user.values():
        recs.sort(key=lambda r: r.rank)
        assert [r.rank for r in recs] == list(range(1, len(recs) + 1))
        assert len(recs) <= 10
        scores = [r.predicted_rating for r in recs]
        assert all(a >= b for a, b in zip(scores, scores[1:]))


def test_als_prediction_is_factor_dot_product(spark, sf_small):
    model = als_model(spark, sf_small)
    users = {r.id: np.array(r.features) for r in model.userFactors.collect()}
    items = {r.id: np.array(r.features) for r in model.itemFactors.collect()}
    assert len(next(iter(users.values()))) == 30
    cands = R.explode_candidates(R.als_candidates(model)).limit(50).collect()
    for c in cands:
        assert abs(float(users[c.user_id] @ items[c.item_id]) - c.predicted_rating) < 1e-3


def test_als_beats_global_mean_on_planted_low_rank(spark):
    rng = np.random.default_rng(7)
    u, v = rng.normal(size=(120, 2)), rng.normal(size=(80, 2))
    full = 3 + u @ v.T
    rows = [(int(i), int(j), float(full[i, j])) for i in range(120) for j in range(80)
            if rng.random() < 0.5]
    df = spark.createDataFrame(rows, "user_id int, item_id int, rating float")
    train, test = R.train_test(df)
    pred = R.train_als(train).transform(test)
    als = R.rmse_frame(pred).first().rmse
    mean = train.agg(F.avg("rating")).first()[0]
    base = test.agg(F.sqrt(F.avg(F.pow(F.col("rating") - mean, 2)))).first()[0]
    assert als < base


def test_popularity_chain_skips_rated_items(spark, sf_small):
    g = gold(spark, sf_small)
    recos = R.popularity_recommendations(g.dim_user, g.fact)
    seen = R.rated_pairs(g.fact)
    assert recos.join(seen, ["user_id", "item_id"], "left_semi").count() == 0
    assert recos.groupBy("user_id").agg(F.max("rank").alias("m")).filter("m > 10").count() == 0


def test_full_pipeline_with_als(spark, sf_small):
    from orrery.plans.warehouse import Warehouse
    from orrery.session import unique_name, work_root

    wh = Warehouse(spark, sf_small, work_root(spark, unique_name("test-wh")))
    counts = wh.run("als")
    assert counts["als"]["n_test"] > 0 and counts["als"]["rmse"] > 0
    g = wh.gold_tables()
    recos = g.recommendations
    assert recos.count() == counts["recommendations"]["written"] > 0
    assert recos.join(g.dim_item, "item_id", "left_anti").count() == 0
    assert counts["dim_item"] == {"written": 134, "rejected": 0}
    assert counts["bridge_item_tag"]["written"] == 378


def test_exclude_unrated_flag(spark, sf_small):
    g = gold(spark, sf_small)
    listed = R.rated_pairs(g.fact, exclude_unrated=True)
    recos = R.popularity_recommendations(g.dim_user, g.fact, exclude_unrated=True)
    assert recos.join(listed, ["user_id", "item_id"], "left_semi").count() == 0
    default = R.popularity_recommendations(g.dim_user, g.fact)
    unrated = g.fact.filter(F.col("rating").isNull()).select("user_id", "item_id")
    assert default.join(unrated, ["user_id", "item_id"], "left_semi").count() >= 0


def test_point_lookup_is_ordered(spark, sf_small):
    from orrery.plans import analytics as A

    g = gold(spark, sf_small)
    uid = g.recommendations.first().user_id
    ranks = [r["rank"] for r in A.user_recommendations(g, [uid]).collect()]
    assert ranks == sorted(ranks) and ranks[0] == 1


def test_candidate_rules_count_what_is_broken(spark):
    """Each rule on planted lists; only products go through the join."""
    kind = "user_id int, recommendations array<struct<item_id int, rating float>>"
    a = spark.createDataFrame([(1, [(1, 3.0), (2, 1.0)]), (2, [(1, 2.0), (1, 1.0)]),
                               (3, [(4, 1.0)]), (4, []), (5, [(7, 1.0), (8, 0.5)]),
                               (7, [(1, 1.0), (2, -2.0)])], kind)
    b = spark.createDataFrame([(1, [(1, 3.0), (9, 1.0)]), (2, [(1, 2.0), (3, 1.0)]),
                               (3, [(4, 1.5)]), (4, [(5, 1.0)]), (6, [(1, 1.0)]),
                               (7, [(1, 1.0), (2, -2.1)])], kind)
    rules = R.candidate_rules(a, b)
    assert {r.rule: r.violations for r in rules.collect()} == {
        "user missing": 2, "length": 1, "product": 2, "item twice": 1}
    plan = rules._jdf.queryExecution().analyzed().toString()
    assert "Join FullOuter" in plan and not re.search(r"recommendations#\d+ AS", plan)


def _shuffles(spark):
    """Numbers of the shuffles that have files."""
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager() \
        .getAllFiles().mkString(" ")
    return set(re.findall(r"shuffle_(\d+)_", files))


def _left(spark, before, most, seconds=20):
    """The new shuffles that have files, once they are ``most`` or the time is over."""
    until = time.time() + seconds
    while len(_shuffles(spark) - before) > most and time.time() < until:
        time.sleep(0.2)
    return len(_shuffles(spark) - before)


def test_training_leaves_the_shuffles_of_an_iteration(spark):
    """Each iteration shuffles the factors twice; the files of earlier ones go
    while the model trains."""
    from orrery.session import release

    rng = np.random.default_rng(1)
    df = spark.createDataFrame([(int(i), int(j), float(i % 5 + j % 3)) for i in range(40)
                                for j in range(30) if rng.random() < 0.5],
                               "user_id int, item_id int, rating float")
    release(spark)
    time.sleep(1)
    before = _shuffles(spark)
    model = R.train_als(df, blocks=2)
    assert _left(spark, before, 6) <= 6
    assert model.userFactors.count() == 40


def test_released_shuffles_are_deleted(spark):
    from orrery.session import release

    release(spark)
    time.sleep(1)
    before = _shuffles(spark)
    for _ in range(5):
        assert spark.range(100).groupBy((F.col("id") % 7).alias("k")).count().count() == 7
    assert len(_shuffles(spark) - before) > 0
    release(spark)
    assert _left(spark, before, 2) <= 2  # those of the last job
