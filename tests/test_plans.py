"""Physical plan shape: the scale properties the design relies on."""

from orrery.plans import analytics as A
from orrery.plans import silver as S
from orrery.plans.warehouse import gold
from orrery.registry import QUERIES
from orrery.session import unique_name
from orrery.sources import fixtures


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_dedup_aggregates_map_side(spark, sf_small):
    p = plan(S.dedup_ratings(fixtures.raw_ratings(spark, sf_small)))
    assert "partial_max" in p


def test_gold_scans_push_filters_and_prune_columns(spark, sf_small):
    g = gold(spark, sf_small)
    p = plan(A.top_items_by_score(g))
    assert "GreaterThan(members,10000)]" in p and "PushedFilters: [" in p
    assert "ReadSchema: struct<item_id:int,name:string,kind:string,score:float,members:int>" in p


def test_tag_dimension_is_broadcast(spark, sf_small):
    p = plan(A.user_tag_histogram(gold(spark, sf_small)))
    assert "BroadcastExchange" in p or "BroadcastHashJoin" in p


def test_top_n_per_user_limits_before_shuffle(spark, sf_small):
    p = plan(A.user_history_top(gold(spark, sf_small)))
    assert "WindowGroupLimit" in p


def test_no_cartesian_products(spark, sf_small):
    for name in ["popularity_recommendations", "kpi_overview", "score_histogram",
                 "activity_trend", "baseline_rmse", "validate_fact"]:
        p = plan(QUERIES[name](spark, sf_small))
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, name


def test_point_lookup_pushes_user_filter(spark, sf_small):
    g = gold(spark, sf_small)
    p = plan(A.user_profile(g, user_ids=[5]))
    assert "PushedFilters: [IsNotNull(user_id), In(user_id, [5])]" in p or \
        "EqualTo(user_id,5)" in p or "In(user_id" in p


def test_clean_fact_validation_drops_the_duplicate_join(spark, sf_small):
    from orrery.plans import star
    from orrery.plans.warehouse import warehouse

    wh = warehouse(spark, sf_small)
    g = wh.gold_tables()
    df = star.validate_fact(wh.silver_table("ratings"), g.dim_item, g.rows["dim_item"])
    df.collect()
    final = plan(df).split("== Initial Plan ==")[0]
    # Only the broadcast FK join remains; the empty duplicate list was
    # propagated away by AQE.
    assert final.count("Join") == 1 and "BroadcastHashJoin" in final


def test_clean_input_of_a_uniqueness_rule_is_joined_with_nothing(spark, tmp_path):
    """Both sides of the bound on duplicated keys, and no duplicates at all."""
    from orrery import config
    from orrery.operators import quality

    def store(frame):
        path = str(tmp_path / unique_name("s"))
        frame.write.parquet(path)
        return spark.read.schema(frame.schema).parquet(path)

    rows = spark.range(100).selectExpr("cast(id as int) as k", "cast(id % 7 as int) as v")
    clean = quality.validate(rows, [quality.Unique(("k",))], store)
    assert "Join" not in plan(clean) and "Exchange" not in plan(clean)
    assert clean.filter("error_reason is not null").count() == 0
    twice = rows.unionByName(rows.filter("k < 10"))
    few = quality.validate(twice, [quality.Unique(("k",))], store)
    assert few.filter("error_reason is not null").count() == 20
    few_rows = quality.bounded_broadcast(rows, config.BROADCAST_MAX_ROWS)
    many_rows = quality.bounded_broadcast(rows, config.BROADCAST_MAX_ROWS + 1)
    hints = [x._jdf.queryExecution().analyzed().toString() for x in (few_rows, many_rows)]
    assert "ResolvedHint" in hints[0] and "ResolvedHint" not in hints[1]


def test_one_user_reads_only_matching_row_groups(spark, sf_small):
    from orrery.plans import analytics
    from orrery.plans.warehouse import gold

    g = gold(spark, sf_small)
    page = analytics.one_user_page(g, 7)
    text = plan(page["user_profile"])
    assert "EqualTo(user_id,7)" in text
    # The fact is dealt out by ranges of the user: few files can hold one.
    files = g.fact.selectExpr("_metadata.file_path as f", "user_id").groupBy("f").agg(
        {"user_id": "min"}).count()
    holding = g.fact.filter("user_id = 7").selectExpr("_metadata.file_path as f").distinct().count()
    assert holding <= 2 and files >= holding


def test_audit_scans_each_gold_table_once(spark, sf_small):
    p = plan(QUERIES["constraint_audit"](spark, sf_small))
    assert p.count("FileScan parquet") == 6
    assert "Join" not in p
    assert p.count("Exchange hashpartitioning") == 1 and "partial_count" in p


def test_audit_counts_planted_violations(spark):
    from orrery.plans.star import constraint_audit

    def frame(rows, schema):
        return spark.createDataFrame(rows, schema)

    got = {(r.table_name, r.constraint_name): r.violations for r in constraint_audit(
        frame([(1, "a"), (1, "b"), (2, None), (None, "c")], "item_id int, name string"),
        frame([(1, "x"), (2, "x"), (2, None)], "tag_id int, tag_name string"),
        frame([(1, 1), (1, 1), (1, 1), (7, 2), (None, 9)], "item_id int, tag_id int"),
        frame([(1, 1, 5), (1, 1, 6), (1, 8, 7), (2, 8, None), (None, 1, 1)],
              "user_id int, item_id int, rating int"),
        frame([(1,), (2,)], "user_id int"),
        frame([], "user_id int, item_id int, rank int")).collect()}
    assert len(got) == 17
    assert {k: v for k, v in got.items() if v} == {
        ("dim_item", "not_null"): 2, ("dim_item", "primary_key"): 2,
        ("dim_tag", "not_null"): 1, ("dim_tag", "primary_key"): 2, ("dim_tag", "unique_name"): 2,
        ("bridge_item_tag", "not_null"): 1, ("bridge_item_tag", "primary_key"): 3,
        ("bridge_item_tag", "fk_item"): 1, ("bridge_item_tag", "fk_tag"): 1,
        ("fact_ratings", "not_null"): 1, ("fact_ratings", "primary_key"): 2,
        ("fact_ratings", "fk_item"): 2}
