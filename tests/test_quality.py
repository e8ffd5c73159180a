"""Validation rules, reject records and publication."""

import pytest
from pyspark.sql import functions as F

from orrery import config
from orrery.operators.quality import (REASON, ForeignKey, NotNull, Unique, key_counts,
                                      reject_missing_reference, reject_records,
                                      split_duplicate_rejects, split_null_rejects,
                                      union_rejects, validate)
from orrery.session import unique_name, work_root
from orrery.sources.catalog import Catalog, PublishError


def test_null_split_reason_names_all_columns(spark):
    df = spark.createDataFrame([(1, None), (None, 2), (3, 4)], "a int, b int")
    valid, bad = split_null_rejects(df, ["a", "b"])
    assert [tuple(r) for r in valid.collect()] == [(3, 4)]
    assert {r[REASON] for r in bad.collect()} == {"missing required column(s): a, b"}


def test_fk_null_key_is_rejected(spark):
    df = spark.createDataFrame([(None,), (1,), (2,)], "k int")
    ref = spark.createDataFrame([(1,), (None,)], "k int")
    valid, bad = reject_missing_reference(df, ref, ["k"], "k not found")
    assert [r.k for r in valid.collect()] == [1]
    assert sorted((r.k is None, r.k) for r in bad.collect()) == [(False, 2), (True, None)]


def test_duplicates_reject_every_copy(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",)], "k string")
    valid, bad = split_duplicate_rejects(df, ["k"])
    assert [r.k for r in valid.collect()] == ["b"]
    assert sorted(r.k for r in bad.collect()) == ["a", "a"]


def test_null_keys_form_one_group(spark):
    df = spark.createDataFrame([(None,), (None,), (1,)], "k int")
    valid, bad = split_duplicate_rejects(df, ["k"])
    assert [r.k for r in valid.collect()] == [1]
    assert bad.count() == 2
    counts = sorted((r.k is None, r.key_count) for r in key_counts(df, ["k"]).collect())
    assert counts == [(False, 1), (True, 2), (True, 2)]


def test_rule_chain_first_failure_wins_and_counts_only_live_rows(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (None, 1), (2, 9), (2, 9), (3, 1)],
                               "u int, i int")
    ref = spark.createDataFrame([(1,)], "i int")
    flagged = validate(df, [NotNull(("u", "i")), ForeignKey(("i",), ref, "missing i"),
                            Unique(("u", "i"))])
    out = sorted(((r.u or 0), r.i, r[REASON] or "") for r in flagged.collect())
    assert out == [(0, 1, "missing required column(s): u, i"),
                   (1, 1, "duplicate key: u, i"), (1, 1, "duplicate key: u, i"),
                   (2, 9, "missing i"), (2, 9, "missing i"), (3, 1, "")]


def test_union_with_missing_columns_and_payload(spark):
    a = spark.createDataFrame([(1, 2, "r1")], f"a int, b int, {REASON} string")
    b = spark.createDataFrame([(3, "r2")], f"a int, {REASON} string")
    u = union_rejects(a, b)
    rec = {r.error_reason: r.payload for r in reject_records(u, "job", "t").collect()}
    assert rec == {"r1": '{"a":1,"b":2}', "r2": '{"a":3}'}


def test_publish_failure_keeps_old_version(spark):
    cat = Catalog(spark, work_root(spark, unique_name("test-cat"))).create()
    v1 = spark.createDataFrame([(1,), (2,)], "x int")
    cat.publish({"t": v1})
    with pytest.raises(PublishError):
        cat.publish({"t": spark.createDataFrame([(9,)], "x int")}, fail_before_swap=True)
    assert sorted(r.x for r in cat.read("t").collect()) == [1, 2]
    cat.publish({"t": spark.createDataFrame([(9,)], "x int")})
    assert [r.x for r in cat.read("t").collect()] == [9]


def test_cascade_empties_dependants_in_same_manifest(spark):
    cat = Catalog(spark, work_root(spark, unique_name("test-cat"))).create()
    cat.publish({"dim": spark.createDataFrame([(1,)], "k int"),
                 "child": spark.createDataFrame([(1, 5)], "k int, v int")})
    counts = cat.publish({"dim": spark.createDataFrame([(2,)], "k int")}, cascade=["child"])
    assert counts == {"dim": 1, "child": 0}
    assert cat.read("child").count() == 0
    assert cat.read("child").columns == ["k", "v"]


def test_reject_log_is_append_only(spark):
    cat = Catalog(spark, work_root(spark, unique_name("test-cat"))).create()
    recs = reject_records(spark.createDataFrame([(1, "bad")], f"a int, {REASON} string"),
                          "job", "t")
    assert cat.append_rejects(recs, "run1") == 1
    assert cat.append_rejects(recs.filter(F.lit(False)), "run2") == 0
    assert cat.append_rejects(recs, "run3") == 1
    rows = cat.rejects().collect()
    assert len(rows) == 2 and len({r.reject_id for r in rows}) == 2


def test_raw_ingest_fails_fast_on_missing_source(spark):
    from orrery.sources.files import raw_ingest

    root = work_root(spark, unique_name("test-missing"))
    with pytest.raises(FileNotFoundError):
        raw_ingest(spark, f"{root}/nothing-here", ["a"], f"{root}/out")


def test_raw_ingest_keeps_text_and_source(spark, tmp_path):
    from orrery.sources.files import raw_ingest

    (tmp_path / "in.csv").write_text("a,b\n 1 ,\nUnknown,x\n")
    root = work_root(spark, unique_name("test-ingest"))
    assert raw_ingest(spark, str(tmp_path / "in.csv"), ["a", "b"], f"{root}/out") == 2
    rows = spark.read.parquet(f"{root}/out").orderBy("a").collect()
    assert [(r.a, r.b) for r in rows] == [(" 1 ", None), ("Unknown", "x")]
    assert all(r.source_file.endswith("in.csv") and r.ingested_at for r in rows)


def test_concurrent_publisher_with_same_sequence_fails(spark, monkeypatch):
    a = Catalog(spark, work_root(spark, unique_name("test-cat"))).create()
    b = Catalog(spark, a.root)
    a.publish({"t": spark.createDataFrame([(1,)], "x int")})
    # b read the state before a's switch: it takes the same sequence number.
    monkeypatch.setattr(b, "state", lambda refresh=False: (0, {}))
    with pytest.raises(Exception, match="already exists|PATH_ALREADY_EXISTS"):
        b.publish({"t": spark.createDataFrame([(2,)], "x int")})
    seq, tables = Catalog(spark, a.root).state()
    assert seq == 1 and [r.x for r in Catalog(spark, a.root).read("t").collect()] == [1]


def test_sql_over_gold_is_parameterised(spark):
    from orrery.plans.analytics import Gold, sql_over_gold

    mk = spark.createDataFrame
    g = Gold(dim_item=mk([(1, "a", "k", None, None, 5.0, 10)],
                         "item_id int, name string, kind string, units int, is_open boolean, "
                         "score float, members int"),
             dim_tag=mk([], "tag_id int, tag_name string"),
             bridge=mk([], "item_id int, tag_id int"),
             fact=mk([(1, 1, 7), (2, 1, 3)], "user_id int, item_id int, rating int"),
             dim_user=mk([], "user_id int, user_total_reviews int, "
                             "user_average_given_rating float"),
             recommendations=mk([], "user_id int, item_id int, predicted_rating float, "
                                    "rank int"))
    out = sql_over_gold(spark, g, "SELECT count(*) AS n FROM fact_ratings WHERE rating >= :r",
                        {"r": 5})
    assert out.first().n == 1
    evil = sql_over_gold(spark, g, "SELECT count(*) AS n FROM dim_item WHERE kind = :k",
                         {"k": "k' OR '1'='1"})
    assert evil.first().n == 0


def test_empty_reject_log_has_schema(spark):
    cat = Catalog(spark, work_root(spark, unique_name("test-cat"))).create()
    empty = cat.rejects()
    assert empty.count() == 0 and "payload" in empty.columns


def test_pipeline_balances_and_audit_is_clean(spark, sf_small):
    from orrery.plans import silver as S
    from orrery.plans import star
    from orrery.plans.warehouse import warehouse
    from orrery.registry import QUERIES

    wh = warehouse(spark, sf_small)
    g = wh.gold_tables()
    # input = written + rejected, per job, recomputed from the silver layer
    items, ratings = wh.silver_table("items"), wh.silver_table("ratings")
    for flagged, n_in in [(star.validate_dim_item(items), items.count()),
                          (star.validate_fact(ratings, g.dim_item), ratings.count()),
                          (star.validate_dim_user(g.fact), g.fact.select("user_id").distinct()
                           .count())]:
        c = flagged.agg(F.count(F.when(F.col(REASON).isNull(), 1)).alias("ok"),
                        F.count(REASON).alias("bad")).first()
        assert c.ok + c.bad == n_in
    pairs = S.item_tags(items).count()
    bridge = wh.catalog.version("bridge_item_tag")
    bridge_rejects = wh.catalog.rejects().filter(
        (F.col("run_id") == bridge.run_id) & (F.col("target_table") == "bridge_item_tag")).count()
    assert bridge.rows + bridge_rejects == pairs
    audit = QUERIES["constraint_audit"](spark, sf_small).collect()
    assert len(audit) == 17 and all(r.violations == 0 for r in audit)


def test_not_null_can_report_the_missing_columns(spark):
    df = spark.createDataFrame([(1, None, 3), (None, None, 1), (1, 2, 3)], "a int, b int, c int")
    flagged = validate(df, [NotNull(("a", "b"), report_missing=True)])
    got = sorted((r.missing_columns or "", r[REASON] or "") for r in flagged.collect())
    assert got == [("", ""), ("a, b", "missing required column(s): a, b"),
                   ("b", "missing required column(s): a, b")]


def test_large_reference_reads_its_input_once(spark):
    """A reference too large to broadcast: the rows are stored first, since
    the join reads them several times."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    def store(frame):
        rows = frame.toArrow()
        return spark.createDataFrame(rows, frame.schema)

    df = spark.range(0, 3000, 1, 2).selectExpr("id % 100 as k").mapInArrow(count, "k bigint")
    ref = spark.range(0, 90).selectExpr("id as k")
    rule = ForeignKey(("k",), ref, "missing", ref_rows=config.BROADCAST_MAX_KEY_ROWS + 1)
    flagged = validate(df, [rule], store)
    assert flagged.filter("error_reason is not null").count() == 300
    assert seen.value == 3000
