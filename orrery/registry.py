"""Registered queries: one callable (spark, sf_dir) -> DataFrame per
operator of the inventory. Gold-level queries read the published gold
tables of a pipeline run over ``sf_dir``; layer queries derive their input
from the raw tables of ``sf_dir`` directly."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orrery import config
from orrery.operators import quality
from orrery.operators.cleaning import (exclude_by_pattern, first_row_per_key, required_fields)
from orrery.functions.columns import (blank_to_null, lenient_cast, literal_alternation,
                                      sentinel_flag, sentinel_to_null, trimmed)
from orrery.plans import analytics as A
from orrery.plans import recommend as R
from orrery.plans import silver as S
from orrery.plans import star as G
from orrery.plans.warehouse import Warehouse, fingerprint, gold, in_parallel, warehouse
from orrery.session import release, unique_name, work_root
from orrery.sources import files, fixtures
from orrery.sources.catalog import Catalog, PublishError, run_validated_job

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return register


def _raw_items(spark, sf):
    return fixtures.raw_items(spark, sf)


def _raw_ratings(spark, sf):
    return fixtures.raw_ratings(spark, sf)


def _store(spark):
    """Write a frame to the scratch folder and read it back."""
    def stored(frame):
        path = _scratch(spark, "stage")
        frame.write.parquet(path)
        return spark.read.schema(frame.schema).parquet(path)
    return stored


def _valid_typed_ratings(spark, sf):
    return quality.split_null_rejects(S.typed_ratings(_raw_ratings(spark, sf)),
                                      ["user_id", "item_id"])


def _scratch(spark, name):
    return work_root(spark, "scratch", unique_name(name))


# ---- sources and sinks -------------------------------------------------------

def _landed(spark, sf, frame, columns, name):
    landing = _scratch(spark, f"landing-{name}")
    files.write_text_csv(frame(spark, sf), f"{landing}/csv")
    files.raw_ingest(spark, f"{landing}/csv", columns, f"{landing}/bronze")
    return spark.read.parquet(f"{landing}/bronze").select(*columns)


@query("raw_ingest_items")
def raw_ingest_items(spark, sf):
    return _landed(spark, sf, fixtures.raw_items, fixtures.RAW_ITEM_COLUMNS, "items")


@query("raw_ingest_ratings")
def raw_ingest_ratings(spark, sf):
    return _landed(spark, sf, fixtures.raw_ratings, fixtures.RAW_RATING_COLUMNS, "ratings")


@query("raw_ingest_items_stream")
def raw_ingest_items_stream(spark, sf):
    """S1 incrementally: the catalogue lands in two file batches through an
    availableNow stream; the target holds each row exactly once."""
    from orrery.streaming import land_new_files

    root = _scratch(spark, "stream")
    items = _raw_items(spark, sf).withColumn("_half", F.col("item_id").isNull()
                                             | (F.hash("item_id") % 2 == 0))
    cols = fixtures.RAW_ITEM_COLUMNS
    for i, part in enumerate([items.filter("_half"), items.filter("NOT _half")]):
        files.write_text_csv(part.select(*cols), f"{root}/landing/batch={i}")
        land_new_files(spark, f"{root}/landing/*/part-*", cols, f"{root}/bronze",
                       f"{root}/checkpoint")
    return spark.read.parquet(f"{root}/bronze").select(*cols)


@query("dim_user_from_stream")
def dim_user_from_stream(spark, sf):
    """S1 -> A1, B7 incrementally: ratings land in two file batches, each taken
    into the user dimension; the second comes again and changes nothing."""
    from orrery.streaming import UserMaintenance, land_new_files, maintain_users

    root = _scratch(spark, "upkeep")
    cols = fixtures.RAW_RATING_COLUMNS
    upkeep = UserMaintenance(Catalog(spark, f"{root}/catalog").create(),
                             gold(spark, sf).dim_item, f"{root}/checkpoint-users")
    ratings = _raw_ratings(spark, sf).withColumn("_half", F.hash(*cols) % 2 == 0)
    for i, part in enumerate([ratings.filter("_half"), ratings.filter("NOT _half")]):
        files.write_text_csv(part.select(*cols), f"{root}/landing/batch={i}")
        land_new_files(spark, f"{root}/landing/*/part-*", cols, f"{root}/bronze",
                       f"{root}/checkpoint-landing")
        maintain_users(f"{root}/bronze", upkeep, f"{root}/checkpoint-users")
    upkeep.apply(spark.read.parquet(f"{root}/bronze"), 1)
    return upkeep.dim_user()


@query("csv_scan_roundtrip")
def csv_scan_roundtrip(spark, sf):
    path = _scratch(spark, "csv")
    files.write_text_csv(_raw_items(spark, sf), path)
    return S.silver_items(files.read_text_csv(spark, path, fixtures.RAW_ITEM_COLUMNS))


def _reordered_csv(spark, sf, frame, name):
    """The fixture as CSV with its columns in reverse order, and one more."""
    path = _scratch(spark, f"reordered-{name}")
    raw = frame(spark, sf)
    files.write_text_csv(raw.select(F.lit("x").alias("note"), *reversed(raw.columns)), path)
    return path


@query("csv_reordered_header")
def csv_reordered_header(spark, sf):
    """Columns come by header name, whatever their order in the file."""
    path = _reordered_csv(spark, sf, fixtures.raw_ratings, "ratings")
    return files.read_text_csv(spark, path, fixtures.RAW_RATING_COLUMNS)


@query("pipeline_from_files")
def pipeline_from_files(spark, sf):
    """B10 over CSV files with other header orders and an extra column."""
    wh = Warehouse(spark, None, _scratch(spark, "from-files"),
                   items_path=_reordered_csv(spark, sf, fixtures.raw_items, "items"),
                   ratings_path=_reordered_csv(spark, sf, fixtures.raw_ratings, "ratings"))
    wh.run()
    return wh.gold_tables().recommendations.select(*G.RECO_COLUMNS)


@query("silver_publish_roundtrip")
def silver_publish_roundtrip(spark, sf):
    return warehouse(spark, sf).silver_table("items")


# ---- projections, filters, cleaning -------------------------------------------

@query("lenient_cast")
def q_lenient_cast(spark, sf):
    return _raw_items(spark, sf).select(
        F.col("item_id").alias("item_id_text"), lenient_cast("item_id", "int").alias("item_id"),
        F.col("units").alias("units_text"), lenient_cast("units", "int").alias("units"),
        lenient_cast("score", "double").alias("score"),
        lenient_cast("members", "int").alias("members"))


@query("lenient_cast_decimal")
def q_lenient_cast_decimal(spark, sf):
    """P1 on decimal text, as nullable whole columns of other tools hold it."""
    text = fixtures.decimal_texts(spark, sf)
    return text.select("p_partkey", "raw", lenient_cast("raw", "int").alias("as_int"),
                       lenient_cast("raw", "bigint").alias("as_bigint"))


@query("sentinel_flag")
def q_sentinel_flag(spark, sf):
    return _raw_items(spark, sf).select(
        F.col("item_id").alias("item_id_text"), F.col("units").alias("units_text"),
        sentinel_flag("units", config.UNITS_SENTINEL).alias("is_open"),
        sentinel_to_null("units", config.UNITS_SENTINEL, "int").alias("units"))


@query("sentinel_to_null")
def q_sentinel_to_null(spark, sf):
    return _raw_ratings(spark, sf).select(
        F.col("user_id").alias("user_id_text"), F.col("item_id").alias("item_id_text"),
        F.col("rating").alias("rating_text"),
        sentinel_to_null("rating", config.RATING_SENTINEL, "int").alias("rating"))


@query("trim_blank_to_null")
def q_trim_blank_to_null(spark, sf):
    return _raw_items(spark, sf).select(
        F.col("item_id").alias("item_id_text"), trimmed("name").alias("name"),
        blank_to_null("tags").alias("tags"), trimmed("kind").alias("kind"))


@query("required_fields")
def q_required_fields(spark, sf):
    return required_fields(S.typed_items(_raw_items(spark, sf)), ["item_id", "name"])


@query("exclude_by_pattern")
def q_exclude_by_pattern(spark, sf):
    items = required_fields(S.typed_items(_raw_items(spark, sf)), ["item_id", "name"])
    return exclude_by_pattern(items, "tags", literal_alternation(config.EXCLUDED_TAGS))


@query("dedup_items")
def q_dedup_items(spark, sf):
    items = required_fields(S.typed_items(_raw_items(spark, sf)), ["item_id", "name"])
    return first_row_per_key(items, ["item_id"], S.ITEM_ORDER)


@query("dedup_ratings")
def q_dedup_ratings(spark, sf):
    return S.dedup_ratings(_raw_ratings(spark, sf))


@query("silver_items")
def q_silver_items(spark, sf):
    return S.silver_items(_raw_items(spark, sf))


@query("silver_ratings")
def q_silver_ratings(spark, sf):
    return S.silver_ratings(_raw_ratings(spark, sf), S.silver_items(_raw_items(spark, sf)))


@query("tag_explode")
def q_tag_explode(spark, sf):
    return S.item_tags(S.silver_items(_raw_items(spark, sf)))


# ---- gold tables ------------------------------------------------------------------

@query("gold_dim_item")
def q_gold_dim_item(spark, sf):
    return gold(spark, sf).dim_item


@query("gold_dim_tag")
def q_gold_dim_tag(spark, sf):
    return gold(spark, sf).dim_tag


@query("gold_bridge_item_tag")
def q_gold_bridge(spark, sf):
    return gold(spark, sf).bridge


@query("gold_fact_ratings")
def q_gold_fact(spark, sf):
    return gold(spark, sf).fact


@query("gold_dim_user")
def q_gold_dim_user(spark, sf):
    return gold(spark, sf).dim_user


# ---- data quality ------------------------------------------------------------------

@query("null_valid")
def q_null_valid(spark, sf):
    return _valid_typed_ratings(spark, sf)[0]


@query("null_reject")
def q_null_reject(spark, sf):
    return _valid_typed_ratings(spark, sf)[1]


@query("duplicate_key_split")
def q_duplicate_key_split(spark, sf):
    valid = _store(spark)(_valid_typed_ratings(spark, sf)[0])
    return quality.key_counts(valid, ["user_id", "item_id"], "key_count")


@query("duplicate_valid")
def q_duplicate_valid(spark, sf):
    return quality.split_duplicate_rejects(_valid_typed_ratings(spark, sf)[0],
                                           ["user_id", "item_id"], _store(spark))[0]


@query("duplicate_reject")
def q_duplicate_reject(spark, sf):
    return quality.split_duplicate_rejects(_valid_typed_ratings(spark, sf)[0],
                                           ["user_id", "item_id"], _store(spark))[1]


def _fk_split(spark, sf):
    g = gold(spark, sf)
    return quality.reject_missing_reference(_valid_typed_ratings(spark, sf)[0], g.dim_item,
                                            ["item_id"], G.ITEM_NOT_FOUND, g.rows["dim_item"])


@query("fk_valid_ratings")
def q_fk_valid(spark, sf):
    return _fk_split(spark, sf)[0]


@query("fk_reject_ratings")
def q_fk_reject(spark, sf):
    return _fk_split(spark, sf)[1]


def _validated_fact(spark, sf):
    g = gold(spark, sf)
    return G.validate_fact(S.typed_ratings(_raw_ratings(spark, sf)), g.dim_item,
                           g.rows["dim_item"], _store(spark))


@query("validate_fact")
def q_validate_fact(spark, sf):
    return _validated_fact(spark, sf)


def _bridge_stages(spark, sf):
    g = gold(spark, sf)
    items = required_fields(S.typed_items(_raw_items(spark, sf)), ["item_id", "name"])
    return G.bridge_stages(items, g.dim_tag, g.dim_item, tag_rows=g.rows.get("dim_tag"),
                           item_rows=g.rows.get("dim_item"), store=_store(spark))


@query("validate_bridge")
def q_validate_bridge(spark, sf):
    stage1, stage2 = _bridge_stages(spark, sf)
    return stage2.unionByName(
        stage1.filter(F.col(quality.REASON).isNotNull()).select("item_id", "tag_name",
                                                                quality.REASON),
        allowMissingColumns=True)


@query("reject_union_bridge")
def q_reject_union_bridge(spark, sf):
    return G.bridge_rejects(*_bridge_stages(spark, sf))


@query("validate_recos")
def q_validate_recos(spark, sf):
    g = gold(spark, sf)
    return R.validate_recommendations(R.popularity_recommendations(g.dim_user, g.fact),
                                      g.dim_item, g.rows["dim_item"], _store(spark))


@query("reject_log")
def q_reject_log(spark, sf):
    rejects = quality.split(_validated_fact(spark, sf))[1]
    return quality.reject_records(rejects, "gold_fact_ratings", "fact_ratings")


@query("reject_log_summary")
def q_reject_log_summary(spark, sf):
    cat = Catalog(spark, _scratch(spark, "rejects"))
    run = unique_name("run")
    fact_rejects = quality.split(_validated_fact(spark, sf))[1]
    cat.append_rejects(quality.reject_records(fact_rejects, "gold_fact_ratings",
                                              "fact_ratings"), run)
    cat.append_rejects(quality.reject_records(q_reject_union_bridge(spark, sf),
                                              "gold_bridge_item_tag", "bridge_item_tag"), run)
    return (cat.rejects().groupBy("job_name", "target_table", "error_reason")
            .agg(F.count(F.lit(1)).alias("n_rejects")))


@query("reject_log_retry")
def q_reject_log_retry(spark, sf):
    """A job that fails after logging its rejects and runs again under
    the same run id leaves each reject once."""
    cat = Catalog(spark, _scratch(spark, "rejects")).create()
    run = unique_name("run")
    for fails in (True, False):
        try:
            run_validated_job(cat, _validated_fact(spark, sf), "gold_fact_ratings",
                              "fact_ratings", G.FACT_COLUMNS, run_id=run, fail_before_swap=fails)
        except PublishError:
            pass
    logged = cat.rejects().groupBy("job_name", "target_table", "error_reason", "payload") \
        .agg(F.count(F.lit(1)).alias("times"), F.countDistinct("run_id").alias("runs"))
    return logged.groupBy("job_name", "target_table", "error_reason").agg(
        F.sum("times").alias("n_rejects"), F.max("runs").alias("runs"))


@query("racing_publishers")
def q_racing_publishers(spark, sf):
    """Publishers of different tables at the same time; none is lost."""
    g = gold(spark, sf)
    root = _scratch(spark, "catalog")
    Catalog(spark, root).create()
    frames = {f"part_{k}": g.dim_user.filter(F.pmod("user_id", F.lit(8)) == k) for k in range(8)}
    in_parallel(*[lambda n=n, f=f: Catalog(spark, root).publish({n: f})
                  for n, f in frames.items()])
    cat = Catalog(spark, root)
    return reduce(DataFrame.unionByName, [cat.read(name) for name in frames])


@query("constraint_audit")
def q_constraint_audit(spark, sf):
    g = gold(spark, sf)
    return G.constraint_audit(g.dim_item, g.dim_tag, g.bridge, g.fact, g.dim_user,
                              g.recommendations)


@query("pipeline_run_counts")
def q_pipeline_run_counts(spark, sf):
    """Rows written and rejected per job of a pipeline run, read back from
    what the run wrote: each current table version (row count from the
    Parquet footers) and the reject log rows of that version's run."""
    wh = warehouse(spark, sf)
    _, versions = wh.catalog.state()
    rejects = wh.catalog.rejects()
    out = None
    for v in sorted(versions.values(), key=lambda v: v.table):
        if not v.job:
            continue
        rejected = rejects.filter((F.col("run_id") == v.run_id)
                                  & (F.col("target_table") == v.table)).agg(F.count(F.lit(1)))
        counts = wh.catalog.read(v.table, v).agg(F.count(F.lit(1)).alias("written")).select(
            F.lit(v.job).alias("job_name"), F.lit(v.table).alias("target_table"), "written",
            rejected.scalar().alias("rejected"))
        out = counts if out is None else out.unionByName(counts)
    return out


# ---- publication ----------------------------------------------------------------------

@query("staged_replace")
def q_staged_replace(spark, sf):
    g = gold(spark, sf)
    cat = Catalog(spark, _scratch(spark, "catalog")).create()
    cat.publish({"dim_user": g.dim_user.filter(F.col("user_total_reviews") > 10)})
    cat.publish({"dim_user": g.dim_user})
    return cat.read("dim_user")


@query("staged_replace_failure_keeps_old")
def q_staged_replace_failure(spark, sf):
    g = gold(spark, sf)
    cat = Catalog(spark, _scratch(spark, "catalog")).create()
    cat.publish({"dim_user": g.dim_user})
    try:
        cat.publish({"dim_user": g.dim_user.filter(F.col("user_total_reviews") > 10)},
                    fail_before_swap=True)
    except PublishError:
        pass
    return cat.read("dim_user")


@query("cascade_replace")
def q_cascade_replace(spark, sf):
    g = gold(spark, sf)
    cat = Catalog(spark, _scratch(spark, "catalog")).create()
    cat.publish({"dim_item": g.dim_item, "bridge_item_tag": g.bridge, "fact_ratings": g.fact})
    cat.publish({"dim_item": g.dim_item}, cascade=["bridge_item_tag", "fact_ratings"])
    out = None
    for t in ("dim_item", "bridge_item_tag", "fact_ratings"):
        n = cat.read(t).agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(t).alias("table_name"), "n_rows")
        out = n if out is None else out.unionByName(n)
    return out


@query("sql_over_gold")
def q_sql_over_gold(spark, sf):
    return A.sql_over_gold(spark, gold(spark, sf), """
        SELECT i.kind, COUNT(*) AS n_ratings, COUNT(DISTINCT f.user_id) AS n_users
        FROM fact_ratings f JOIN dim_item i ON i.item_id = f.item_id
        WHERE f.rating >= :min_rating AND i.members >= :min_members
        GROUP BY i.kind""", {"min_rating": 5, "min_members": 1000})


# ---- dashboard ----------------------------------------------------------------------

def _catalog(spark, sf):
    return A.catalog_filter(gold(spark, sf))


def _users(spark, sf):
    return A.user_band_filter(gold(spark, sf))


_DASH = {
    "kpi_overview": lambda s, d: A.kpi_overview(gold(s, d)),
    "score_histogram": lambda s, d: A.score_histogram(gold(s, d)),
    "kind_distribution": lambda s, d: A.kind_distribution(gold(s, d)),
    "top_items_by_score": lambda s, d: A.top_items_by_score(gold(s, d)),
    "kind_list": lambda s, d: A.kind_list(gold(s, d)),
    "tag_list": lambda s, d: A.tag_list(gold(s, d)),
    "catalog_filter": lambda s, d: A.catalog_filter(gold(s, d), kinds=config.CATALOG_KINDS),
    "catalog_filter_tags": lambda s, d: A.catalog_filter(gold(s, d), tags=config.CATALOG_TAGS),
    "catalog_top20": lambda s, d: A.catalog_top(_catalog(s, d)),
    "catalog_score_histogram": lambda s, d: A.catalog_score_histogram(_catalog(s, d)),
    "catalog_points": lambda s, d: A.catalog_points(_catalog(s, d)),
    "tag_score_ranking": lambda s, d: A.tag_score_ranking(gold(s, d), _catalog(s, d)),
    "item_tag_map": lambda s, d: A.item_tag_map(gold(s, d)),
    "user_activity_bounds": lambda s, d: A.user_activity_bounds(gold(s, d)),
    "user_band_filter": lambda s, d: A.user_band_filter(gold(s, d), which="moderate"),
    "user_band_counts": lambda s, d: A.user_band_counts(gold(s, d)),
    "user_group_summary": lambda s, d: A.user_group_summary(_users(s, d)),
    "user_activity_histogram": lambda s, d: A.user_activity_histogram(_users(s, d)),
    "user_avg_histogram": lambda s, d: A.user_avg_histogram(_users(s, d)),
    "seeded_sample": lambda s, d: A.user_sample(_users(s, d)),
    "activity_trend": lambda s, d: A.activity_trend(_users(s, d)),
    "top_active_users": lambda s, d: A.top_active_users(_users(s, d)),
    "active_users_with_recos": lambda s, d: A.active_users_with_recos(gold(s, d)),
    "user_profile": lambda s, d: A.user_profile(gold(s, d)),
    "user_reco_count": lambda s, d: A.user_reco_count(gold(s, d)),
    "user_history_top": lambda s, d: A.user_history_top(gold(s, d)),
    "user_recommendations": lambda s, d: A.user_recommendations(gold(s, d)),
    "user_tag_histogram": lambda s, d: A.user_tag_histogram(gold(s, d)),
    "reco_tag_histogram": lambda s, d: A.reco_tag_histogram(gold(s, d)),
}
QUERIES.update(_DASH)


def _one_user(page):
    return lambda s, d: A.one_user_page(gold(s, d), config.ONE_USER)[page]


QUERIES.update({f"{page}_one_user": _one_user(page) for page in (
    "user_profile", "user_reco_count", "user_history_top", "user_recommendations",
    "user_tag_histogram", "reco_tag_histogram")})


# ---- recommender ------------------------------------------------------------------------

def _popularity_flat(spark, sf):
    g = gold(spark, sf)
    return R.explode_candidates(R.popularity_candidates(g.dim_user, g.fact))


@query("explode_candidates")
def q_explode_candidates(spark, sf):
    return _popularity_flat(spark, sf)


@query("exclude_seen")
def q_exclude_seen(spark, sf):
    g = gold(spark, sf)
    return R.exclude_seen(_popularity_flat(spark, sf), R.rated_pairs(g.fact))


@query("topn_per_user")
def q_topn_per_user(spark, sf):
    return R.top_n_per_user(q_exclude_seen(spark, sf))


@query("popularity_recommendations")
def q_popularity_recommendations(spark, sf):
    g = gold(spark, sf)
    return R.popularity_recommendations(g.dim_user, g.fact)


@query("als_training_set")
def q_als_training_set(spark, sf):
    return R.training_set(gold(spark, sf).fact)


@query("train_test_split")
def q_train_test_split(spark, sf):
    return R.split_flagged(R.training_set(gold(spark, sf).fact))


@query("baseline_rmse")
def q_baseline_rmse(spark, sf):
    return R.baseline_rmse(gold(spark, sf).fact)


_MODELS: dict = {}


def als_model(spark, sf):
    """ALS trained once per process and input folder, saved to the shared
    folder (S9) and loaded back."""
    from pyspark.ml.recommendation import ALSModel

    key = (work_root(spark), sf, fingerprint(spark, sf))
    if key not in _MODELS:
        train, _ = R.train_test(R.training_set(gold(spark, sf).fact))
        path = work_root(spark, "models", unique_name("als"))
        R.train_als(train).write().overwrite().save(path)
        _MODELS[key] = path
        model = ALSModel.load(path)
        release(spark)  # the last iteration's shuffles and the trained blocks
        return model
    return ALSModel.load(_MODELS[key])


@query("als_model_roundtrip")
def q_als_model_roundtrip(spark, sf):
    model = als_model(spark, sf)
    return model.itemFactors.select(F.col("id").alias("item_id"),
                                    F.size("features").alias("rank"))


@query("als_candidates")
def q_als_candidates(spark, sf):
    return R.explode_candidates(R.als_candidates(als_model(spark, sf)))


@query("als_candidate_rules")
def q_als_candidate_rules(spark, sf):
    """M5: broken rules of the pruned search against all pairs, each to be 0."""
    model = als_model(spark, sf)
    return R.candidate_rules(R.als_candidates(model), R.als_candidates(model, every=True))


@query("als_recommendations")
def q_als_recommendations(spark, sf):
    g = gold(spark, sf)
    recos = R.recommendation_chain(R.als_candidates(als_model(spark, sf)), g.fact)
    return quality.split(R.validate_recommendations(recos, g.dim_item, g.rows["dim_item"],
                                                    _store(spark)))[0]


@query("als_evaluation")
def q_als_evaluation(spark, sf):
    _, test = R.train_test(R.training_set(gold(spark, sf).fact))
    return R.rmse_frame(als_model(spark, sf).transform(test))


@query("als_candidate_counts")
def q_als_candidate_counts(spark, sf):
    """M5: how many candidates each training user has."""
    return q_als_candidates(spark, sf).groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n_candidates"))


@query("als_test_size")
def q_als_test_size(spark, sf):
    """M3: held-out pairs that get a prediction (user and item are trained),
    and whether the model beats the global mean on them."""
    _, test = R.train_test(R.training_set(gold(spark, sf).fact))
    return R.rmse_frame(als_model(spark, sf).transform(test)).select("n_test")


@query("als_recommendation_rules")
def q_als_recommendation_rules(spark, sf):
    """Broken rules of the ALS recommendations, each to be 0."""
    g, model = gold(spark, sf), als_model(spark, sf)
    recos = _store(spark)(q_als_recommendations(spark, sf))  # each rule reads them
    return R.recommendation_rules(recos, g.fact, model.userFactors, model.itemFactors)
