"""Order statistics against sorting, and the activity trend against ranks."""

import random

import pytest
from pyspark.sql import functions as F

from orrery.operators.numbering import group_medians, medians_at_positions, quantile_bins
from orrery.operators.selection import middle_ranks, order_statistics
from orrery.plans.analytics import activity_trend


@pytest.mark.parametrize("kind", ["int", "long", "float", "double"])
def test_ranks_of_groups(spark, kind):
    rng = random.Random(kind)
    if kind in ("int", "long"):
        top = 10 ** 4 if kind == "int" else 10 ** 15
        values = [rng.choice([0, 1, -5, rng.randint(-top, top)]) for _ in range(3000)]
    else:
        values = [rng.choice([0.5, rng.random(), rng.random() * 1e-9, rng.gauss(0, 1e9)])
                  for _ in range(3000)]
    rows = [(rng.choice([1, 1, 1, 2, None]), v) for v in values] + [(1, None), (3, None)]
    df = spark.createDataFrame(rows, f"g int, v {kind}").repartition(5)
    for group in (None, "g"):
        want = {}
        for g in ([None] if group is None else [1, 2, 3]):
            own = sorted(r.v for r in df.collect()
                         if r.v is not None and (group is None or r.g == g))
            for k in {1, 2, 3, len(own) // 3, len(own) // 2, len(own) - 1, len(own)}:
                if 1 <= k <= len(own):
                    want[g, k] = (own[k - 1], sum(x < own[k - 1] for x in own))
        got = order_statistics(df, "v", [*want, (next(iter(want))[0], 10 ** 6)], group)
        assert {t: (f.value, f.below) for t, f in got.items()} == want


def test_middle_ranks():
    assert [middle_ranks(n) for n in (1, 2, 3, 4)] == [(1, 1), (1, 2), (2, 2), (2, 3)]


def test_no_rows_and_too_many_ranks(spark):
    df = spark.createDataFrame([], "v int")
    assert order_statistics(df, "v", [(None, 1)]) == {}
    assert order_statistics(df, "v", []) == {}
    with pytest.raises(ValueError):
        order_statistics(df, "v", [(None, k) for k in range(1000)])


@pytest.mark.parametrize("n", [0, 1, 2, 3, 9, 10, 11, 37, 1000])
def test_trend_is_that_of_sorted_users(spark, n):
    rng = random.Random(n)
    users = spark.createDataFrame(
        [(i * 7 % 1009, rng.choice([1, 1, 2, 3, rng.randint(1, 5000)]),
          rng.choice([None, 5.0, rng.random() * 10])) for i in range(n)],
        "user_id int, user_total_reviews long, user_average_given_rating float")
    binned = quantile_bins(users, ["user_total_reviews", "user_id"], 10, "bin", "_rank")
    sizes = medians_at_positions(binned, "bin", "_rank", "user_total_reviews", 10)
    averages = group_medians(binned, "bin", ["user_average_given_rating"], "user_id", 10)
    want = {r.bin: (r.user_total_reviews, None if r.user_average_given_rating is None
                    else round(r.user_average_given_rating, 3))
            for r in sizes.join(averages, "bin", "full").collect()}
    got = {r.bin: (r.median_reviews, None if r.median_average is None
                   else round(r.median_average, 3)) for r in activity_trend(users).collect()}
    assert got.keys() == want.keys()
    for b, (size, average) in got.items():
        assert size == want[b][0]
        assert (average is None) == (want[b][1] is None)
        assert average is None or abs(average - want[b][1]) < 2e-3


def test_trend_sorts_and_shuffles_no_users(spark, monkeypatch):
    plans = []
    users = spark.range(5000).select(
        F.col("id").cast("int").alias("user_id"), (F.col("id") % 97).alias("user_total_reviews"),
        (F.col("id") % 89 / 9).cast("float").alias("user_average_given_rating"))
    kind = type(users)
    collect = kind.collect

    def seen(self):
        out = collect(self)
        plans.append(self._jdf.queryExecution().executedPlan().toString())
        return out

    monkeypatch.setattr(kind, "collect", seen)
    activity_trend(users)
    assert len(plans) >= 5
    for plan in plans:
        assert "rangepartitioning" not in plan and "Window" not in plan
        # Every exchange stands above a partial aggregate.
        assert plan.count("partial_count") + plan.count("partial_min") >= plan.count("Exchange hash")
