"""The fixture counts of FIXTURES.md §2, reproduced through the Spark code."""

import pytest
from pyspark.sql import functions as F

from orrery import config
from orrery.operators.cleaning import exclude_by_pattern, required_fields
from orrery.functions.columns import literal_alternation
from orrery.plans import silver as S
from orrery.sources import fixtures

EXPECTED = {
    "/root/testdata/sf0.001": dict(
        raw_items=200, null_id=3, extra_copies=5, null_name=3, blank_tags=9, unknown=20,
        raw_ratings=6000, null_user=44, minus_one=2070, dup_keys=561, orphans=2012,
        clean_items=134, with_tags=126, with_score=127, scored_members=109, pairs=378,
        tags=20, clean_ratings=3542, rated=2407, users=150, items=134,
        per_user=(2, 15.5, 31), bands=(33, 75, 42)),
    "/root/testdata/sf0.01": dict(
        raw_items=2000, null_id=21, extra_copies=48, null_name=23, blank_tags=87, unknown=201,
        raw_ratings=60000, null_user=295, minus_one=19926, dup_keys=600, orphans=17093,
        clean_items=1429, with_tags=1345, with_score=1347, scored_members=1072, pairs=4035,
        tags=20, clean_ratings=42275, rated=28353, users=1500, items=1429,
        per_user=(0, 18, 50), bands=(353, 828, 318)),
}


@pytest.mark.parametrize("sf", sorted(EXPECTED))
def test_fixture_counts(spark, sf):
    e = EXPECTED[sf]
    raw_i, raw_r = fixtures.raw_items(spark, sf), fixtures.raw_ratings(spark, sf)
    c = raw_i.agg(
        F.count(F.lit(1)).alias("n"),
        F.count(F.when(F.col("item_id").isNull(), 1)).alias("null_id"),
        (F.count("item_id") - F.count_distinct("item_id")).alias("extra"),
        F.count(F.when(F.col("name").isNull(), 1)).alias("null_name"),
        F.count(F.when(F.trim("tags") == "", 1)).alias("blank"),
        F.count(F.when(F.col("units") == "Unknown", 1)).alias("unknown")).first()
    assert (c.n, c.null_id, c.extra, c.null_name, c.blank, c.unknown) == (
        e["raw_items"], e["null_id"], e["extra_copies"], e["null_name"], e["blank_tags"],
        e["unknown"])
    r = raw_r.agg(F.count(F.lit(1)).alias("n"),
                  F.count(F.when(F.col("user_id").isNull(), 1)).alias("null_user"),
                  F.count(F.when(F.col("rating") == "-1", 1)).alias("m1")).first()
    assert (r.n, r.null_user, r.m1) == (e["raw_ratings"], e["null_user"], e["minus_one"])
    keyed = raw_r.filter(F.col("user_id").isNotNull())
    dup_keys = keyed.groupBy("user_id", "item_id").count().filter("count > 1").count()
    assert dup_keys == e["dup_keys"]

    items = S.silver_items(raw_i)
    assert items.count() == e["clean_items"]
    assert raw_r.join(items.select(F.col("item_id").cast("string").alias("item_id")), "item_id",
                      "left_anti").count() == e["orphans"]
    ic = items.agg(F.count("tags").alias("t"), F.count("score").alias("s"),
                   F.count(F.when(F.col("score").isNotNull() & (F.col("members") > 10000), 1))
                   .alias("sm")).first()
    assert (ic.t, ic.s, ic.sm) == (e["with_tags"], e["with_score"], e["scored_members"])
    pairs = S.item_tags(items)
    assert (pairs.count(), pairs.select("tag_name").distinct().count()) == (e["pairs"], e["tags"])

    ratings = S.silver_ratings(raw_r, items)
    rc = ratings.agg(F.count(F.lit(1)).alias("n"), F.count("rating").alias("rated"),
                     F.count_distinct("user_id").alias("u"),
                     F.count_distinct("item_id").alias("i")).first()
    assert (rc.n, rc.rated, rc.u, rc.i) == (e["clean_ratings"], e["rated"], e["users"],
                                            e["items"])
    per_user = ratings.groupBy("user_id").agg(F.count("rating").alias("k"),
                                              F.avg("rating").alias("a"))
    stats = per_user.agg(F.min("k"), F.median("k"), F.max("k")).first()
    assert tuple(stats) == e["per_user"]
    lo, hi = config.BAND_LIMITS
    b = per_user.agg(F.count(F.when(F.col("a") < lo, 1)),
                     F.count(F.when(F.col("a").between(lo, hi), 1)),
                     F.count(F.when(F.col("a") > hi, 1))).first()
    assert tuple(b) == e["bands"]


def test_exclusion_counts_follow_pattern(spark, sf_small):
    typed = required_fields(S.typed_items(fixtures.raw_items(spark, sf_small)),
                            ["item_id", "name"])
    kept = exclude_by_pattern(typed, "tags", literal_alternation(config.EXCLUDED_TAGS))
    assert kept.filter(F.col("tags").rlike("anvil|PROMO")).count() == 0
