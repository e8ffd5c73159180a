"""Numbering, quantile bins, histograms, analytics edge cases."""

import math

import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from orrery.operators.histogram import equal_width_histogram
from orrery.operators.numbering import global_row_number, quantile_bins
from orrery.plans import analytics as A
from orrery.plans.analytics import Gold


def test_global_row_number_matches_window(spark):
    df = spark.range(0, 5000, 1, 7).select(((F.col("id") * 7919) % 5000).alias("k"),
                                           (F.col("id") % 13).alias("g"))
    mine = global_row_number(df, ["g", "k"], "rn", num_partitions=6)
    ref = df.withColumn("rn2", F.row_number().over(Window.orderBy("g", "k")))
    joined = mine.join(ref, ["g", "k"])
    assert joined.count() == 5000
    assert joined.filter(F.col("rn") != F.col("rn2")).count() == 0


def test_global_row_number_has_no_single_partition_exchange(spark):
    df = spark.range(0, 1000, 1, 4).select(F.col("id").alias("k"))
    plan = global_row_number(df, ["k"], "rn")._jdf.queryExecution().executedPlan().toString()
    # The only single-partition step is the offsets window over the
    # per-partition counts (one row per partition), never over the rows.
    lines = plan.splitlines()
    singles = [i for i, line in enumerate(lines) if "Exchange SinglePartition" in line]
    assert len(singles) == 1
    assert "HashAggregate(keys=[_pid" in lines[singles[0] + 1]


@pytest.mark.parametrize("n", [2, 10, 11, 95])
def test_quantile_bins_match_formula_and_qcut(spark, n):
    df = spark.createDataFrame([(i, (i * 37) % 11) for i in range(n)], "user_id int, size int")
    got = {r.user_id: r.bin for r in quantile_bins(df, ["size", "user_id"], 10).collect()}
    order = sorted(range(n), key=lambda i: ((i * 37) % 11, i))
    q = min(10, n)
    for r, uid in enumerate(order, start=1):
        assert got[uid] == max(1, math.ceil((r - 1) * q / (n - 1)))
    ranks = pd.Series(range(1, n + 1), dtype=float)
    codes = pd.qcut(ranks, q=q, duplicates="drop", labels=False) + 1
    assert [got[order[r]] for r in range(n)] == list(codes)


def test_quantile_bins_need_two_rows(spark):
    df = spark.createDataFrame([(1, 3)], "user_id int, size int")
    assert quantile_bins(df, ["size", "user_id"], 10).count() == 0


def test_histogram_bins_and_single_value(spark):
    df = spark.createDataFrame([(float(x),) for x in [0, 1, 2, 3, 4, 10]], "x double")
    rows = equal_width_histogram(df, "x", 5).orderBy("bin").collect()
    assert [r.n for r in rows] == [2, 2, 1, 0, 1]
    assert rows[-1].bin_end == 10.0
    one = equal_width_histogram(spark.createDataFrame([(3.0,), (3.0,)], "x double"), "x", 40)
    assert [(r.bin, r.n) for r in one.collect()] == [(0, 2)]
    empty = equal_width_histogram(spark.createDataFrame([], "x double"), "x", 40)
    assert empty.count() == 0


def _gold(spark, items=None, tags=None, bridge=None, fact=None, users=None, recos=None):
    mk = spark.createDataFrame
    return Gold(
        dim_item=items or mk([], "item_id int, name string, kind string, units int, "
                                 "is_open boolean, score float, members int"),
        dim_tag=tags or mk([], "tag_id int, tag_name string"),
        bridge=bridge or mk([], "item_id int, tag_id int"),
        fact=fact or mk([], "user_id int, item_id int, rating int"),
        dim_user=users or mk([], "user_id int, user_total_reviews int, "
                                 "user_average_given_rating float"),
        recommendations=recos or mk([], "user_id int, item_id int, predicted_rating float, "
                                        "rank int"),
    )


def test_all_tags_division(spark):
    items = spark.createDataFrame([(1, "a", "k", 1, False, 5.0, 20000),
                                   (2, "b", "k", 1, False, 6.0, 20000)],
                                  "item_id int, name string, kind string, units int, "
                                  "is_open boolean, score float, members int")
    tags = spark.createDataFrame([(1, "x"), (2, "y")], "tag_id int, tag_name string")
    bridge = spark.createDataFrame([(1, 1), (1, 2), (2, 1)], "item_id int, tag_id int")
    g = _gold(spark, items=items, tags=tags, bridge=bridge)
    assert [r.item_id for r in A.catalog_filter(g, tags=["x", "y"]).collect()] == [1]
    assert sorted(r.item_id for r in A.catalog_filter(g, tags=["x"]).collect()) == [1, 2]
    assert A.catalog_filter(g, kinds=[]).count() == 2


def test_band_edges(spark):
    users = spark.createDataFrame([(1, 20, 5.99), (2, 20, 6.0), (3, 20, 8.0), (4, 20, 8.01)],
                                  "user_id int, user_total_reviews int, "
                                  "user_average_given_rating float")
    g = _gold(spark, users=users)
    got = {r.user_id for r in A.user_band_filter(g, 10, "moderate", (6.0, 8.0)).collect()}
    assert got == {2, 3}
    bands = {r.band: r.n_users for r in A.user_band_counts(g, 10, (6.0, 8.0)).collect()}
    assert bands == {"severe": 1, "moderate": 2, "lenient": 1}


def test_empty_input_gives_schema_and_no_rows(spark):
    g = _gold(spark)
    assert A.kpi_overview(g).collect()[0].asDict() == {
        "n_items": 0, "n_users": 0, "n_ratings": 0, "n_tags": 0}
    for frame in [A.score_histogram(g), A.kind_distribution(g), A.top_items_by_score(g),
                  A.activity_trend(A.user_band_filter(g)), A.user_history_top(g),
                  A.user_tag_histogram(g), A.tag_score_ranking(g, A.catalog_filter(g)),
                  A.active_users_with_recos(g), A.user_sample(A.user_band_filter(g))]:
        assert frame.count() == 0
        assert frame.columns
    bounds = A.user_activity_bounds(g).first()
    assert bounds.min_reviews is None and bounds.max_reviews is None
    assert A.user_group_summary(A.user_band_filter(g)).first().n_users == 0


def test_group_medians_match_pandas(spark):
    from orrery.operators.numbering import group_medians

    data = [(g, float((i * 7) % 13), i) for g in range(4) for i in range(g * 3 + 1)]
    df = spark.createDataFrame(data, "g int, v double, id int")
    got = {r.g: r.v for r in group_medians(df, "g", ["v"], "id").collect()}
    ref = pd.DataFrame(data, columns=["g", "v", "id"]).groupby("g")["v"].median().to_dict()
    assert got == ref


def test_global_row_number_with_coalesced_range_partitions(spark):
    keys = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes",
            "spark.sql.adaptive.coalescePartitions.minPartitionSize")
    old = {k: spark.conf.get(k) for k in keys}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "64")
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16k")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionSize", "1k")
        df = spark.range(0, 20000, 1, 5).select(((F.col("id") * 7919) % 20000).alias("k"))
        mine = global_row_number(df, ["k"], "rn")
        assert 1 < mine.rdd.getNumPartitions() < 64  # coalesced, not collapsed
        assert mine.filter(F.col("rn") != F.col("k") + 1).count() == 0
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_histogram_leaves_out_nan(spark):
    from orrery.operators.histogram import equal_width_histogram

    df = spark.createDataFrame([(1.0,), (2.0,), (float("nan"),), (None,)], "x double")
    rows = equal_width_histogram(df, "x", 2).orderBy("bin").collect()
    assert [(r.bin_start, r.bin_end, r.n) for r in rows] == [(1.0, 1.5, 1), (1.5, 2.0, 1)]
