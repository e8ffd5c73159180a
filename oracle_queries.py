"""DuckDB oracle statements for the registered queries.

Each statement recomputes its answer from the driver's tables with plain
SQL (shared CTEs below), independently of the Spark code: row_number
windows where Spark uses aggregates, NOT EXISTS where it uses anti joins,
CROSS JOIN where it attaches a scalar list. Conventions shared with the
Spark side: explicit NULLS FIRST/LAST, a key as the last tie-break of every
top-k, decimal(18,6) before rounding, hash buckets from md5.
"""

from __future__ import annotations

_BASE = r"""
raw_items AS (
  SELECT
    CASE WHEN p_partkey % 97 = 5 THEN NULL
         WHEN p_partkey % 41 = 7 THEN CAST(p_partkey - 1 AS VARCHAR)
         ELSE CAST(p_partkey AS VARCHAR) END AS item_id,
    CASE WHEN p_partkey % 89 = 3 THEN NULL ELSE ' ' || p_name || ' ' END AS name,
    CASE WHEN p_partkey % 23 = 0 THEN '  '
         ELSE replace(p_name, ' ', ', ') || ', ' || p_type END AS tags,
    CASE WHEN p_partkey % 53 = 11 THEN NULL ELSE p_brand END AS kind,
    CASE WHEN p_size % 10 = 0 THEN 'Unknown' ELSE CAST(p_size AS VARCHAR) END AS units,
    CASE WHEN p_partkey % 17 = 0 THEN NULL
         ELSE CAST(round((p_retailprice - 900) / 10, 2) AS VARCHAR) END AS score,
    CAST((p_partkey * 7919) % 50000 AS VARCHAR) AS members
  FROM part),
raw_ratings AS (
  SELECT
    CASE WHEN l_orderkey % 211 = 0 THEN NULL ELSE CAST(o_custkey AS VARCHAR) END AS user_id,
    CAST(l_partkey AS VARCHAR) AS item_id,
    CASE WHEN l_returnflag = 'N' THEN '-1'
         ELSE CAST(CAST(ceil(l_quantity / 5) AS INTEGER) AS VARCHAR) END AS rating
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
typed_items AS (
  SELECT TRY_CAST(item_id AS INTEGER) AS item_id,
         trim(name) AS name,
         nullif(trim(tags), '') AS tags,
         trim(kind) AS kind,
         CASE WHEN units = 'Unknown' THEN NULL ELSE TRY_CAST(units AS INTEGER) END AS units,
         units = 'Unknown' AS is_open,
         TRY_CAST(score AS DOUBLE) AS score,
         TRY_CAST(members AS INTEGER) AS members
  FROM raw_items),
required_items AS (
  SELECT * FROM typed_items WHERE item_id IS NOT NULL AND name IS NOT NULL),
kept_items AS (
  SELECT * FROM required_items WHERE tags IS NULL OR NOT regexp_matches(tags, 'anvil|PROMO')),
silver_items AS (
  SELECT item_id, name, tags, kind, units, is_open, score, members FROM (
    SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY
      name ASC NULLS LAST, tags ASC NULLS LAST, kind ASC NULLS LAST, units ASC NULLS LAST,
      is_open ASC NULLS LAST, score ASC NULLS LAST, members ASC NULLS LAST) AS rn
    FROM kept_items) WHERE rn = 1),
typed_ratings AS (
  SELECT TRY_CAST(user_id AS INTEGER) AS user_id, TRY_CAST(item_id AS INTEGER) AS item_id,
         nullif(TRY_CAST(rating AS INTEGER), -1) AS rating
  FROM raw_ratings),
dedup_ratings AS (
  SELECT user_id, item_id, max(rating) AS rating FROM typed_ratings
  WHERE user_id IS NOT NULL AND item_id IS NOT NULL GROUP BY user_id, item_id),
silver_ratings AS (
  SELECT user_id, item_id, rating FROM dedup_ratings
  WHERE item_id IN (SELECT item_id FROM silver_items)),
dim_item AS (
  SELECT item_id, name, kind, units, is_open, CAST(score AS FLOAT) AS score, members
  FROM silver_items),
item_tags AS (
  SELECT item_id, tag_name FROM (
    SELECT item_id, trim(unnest(string_split(tags, ', '))) AS tag_name
    FROM silver_items WHERE tags IS NOT NULL) WHERE tag_name <> ''),
dim_tag AS (
  SELECT CAST(row_number() OVER (ORDER BY tag_name) AS INTEGER) AS tag_id, tag_name
  FROM (SELECT DISTINCT tag_name FROM item_tags)),
bridge AS (
  SELECT item_id, tag_id FROM (
    SELECT t.item_id, d.tag_id,
           count(*) OVER (PARTITION BY t.item_id, d.tag_id) AS c
    FROM item_tags t JOIN dim_tag d ON d.tag_name = t.tag_name
    WHERE t.item_id IN (SELECT item_id FROM dim_item)) WHERE c = 1),
fact AS (SELECT user_id, item_id, rating FROM silver_ratings),
dim_user AS (
  SELECT user_id, CAST(count(*) AS INTEGER) AS user_total_reviews,
         CAST(avg(rating) AS FLOAT) AS user_average_given_rating
  FROM fact GROUP BY user_id),
item_scores AS (
  SELECT item_id, CAST(avg(rating) AS FLOAT) AS score FROM fact
  WHERE rating IS NOT NULL GROUP BY item_id),
top_items AS (
  SELECT item_id, score FROM item_scores ORDER BY score DESC, item_id LIMIT 50),
candidates AS (
  SELECT u.user_id, t.item_id, t.score AS predicted_rating
  FROM dim_user u CROSS JOIN top_items t),
unseen AS (
  SELECT c.* FROM candidates c WHERE NOT EXISTS (
    SELECT 1 FROM fact f WHERE f.user_id = c.user_id AND f.item_id = c.item_id
      AND f.rating IS NOT NULL)),
recommendations AS (
  SELECT user_id, item_id, predicted_rating, rank FROM (
    SELECT *, CAST(row_number() OVER (PARTITION BY user_id
                   ORDER BY predicted_rating DESC, item_id) AS INTEGER) AS rank
    FROM unseen) WHERE rank <= 10),
item_tag_map AS (
  SELECT b.item_id, d.tag_name FROM bridge b JOIN dim_tag d ON d.tag_id = b.tag_id),
catalog AS (
  SELECT item_id, name, kind, units, score, members FROM dim_item
  WHERE score IS NOT NULL AND members >= 10000 AND score >= 0.0 AND kind IS NOT NULL),
users AS (
  SELECT user_id, user_total_reviews, user_average_given_rating FROM dim_user
  WHERE user_total_reviews >= 10 AND user_average_given_rating IS NOT NULL),
valid_typed_ratings AS (
  SELECT * FROM typed_ratings WHERE user_id IS NOT NULL AND item_id IS NOT NULL),
fact_flagged AS (
  SELECT user_id, item_id, rating,
    CASE WHEN NOT has_keys THEN 'missing required column(s): user_id, item_id'
         WHEN NOT known THEN 'item_id not found in dim_item'
         WHEN sum(CASE WHEN has_keys AND known THEN 1 ELSE 0 END)
              OVER (PARTITION BY user_id, item_id) > 1
           THEN 'duplicate key: user_id, item_id'
    END AS error_reason
  FROM (SELECT *, user_id IS NOT NULL AND item_id IS NOT NULL AS has_keys,
               coalesce(item_id IN (SELECT item_id FROM dim_item), false) AS known
        FROM typed_ratings)),
bridge_input AS (
  SELECT item_id, tag_name FROM (
    SELECT item_id, trim(unnest(string_split(tags, ', '))) AS tag_name
    FROM required_items WHERE tags IS NOT NULL) WHERE tag_name <> ''),
bridge_lookup AS (
  SELECT i.item_id, i.tag_name, d.tag_id FROM bridge_input i
  LEFT JOIN dim_tag d ON d.tag_name = i.tag_name),
bridge_stage2 AS (
  SELECT item_id, tag_id,
    CASE WHEN NOT has_keys THEN 'missing required column(s): item_id, tag_id'
         WHEN NOT known THEN 'item_id not found in dim_item'
         WHEN sum(CASE WHEN has_keys AND known THEN 1 ELSE 0 END)
              OVER (PARTITION BY item_id, tag_id) > 1
           THEN 'duplicate key: item_id, tag_id'
    END AS error_reason
  FROM (SELECT item_id, tag_id, item_id IS NOT NULL AND tag_id IS NOT NULL AS has_keys,
               coalesce(item_id IN (SELECT item_id FROM dim_item), false) AS known
        FROM bridge_lookup WHERE tag_id IS NOT NULL)),
bridge_stage1_rejects AS (
  SELECT item_id, tag_name, 'tag_name not found in dim_tag' AS error_reason
  FROM bridge_lookup WHERE tag_id IS NULL),
bridge_rejects AS (
  SELECT item_id, tag_name, error_reason, CAST(NULL AS INTEGER) AS tag_id
  FROM bridge_stage1_rejects
  UNION ALL
  SELECT item_id, CAST(NULL AS VARCHAR), error_reason, tag_id
  FROM bridge_stage2 WHERE error_reason IS NOT NULL),
train_test AS (
  SELECT user_id, item_id, CAST(rating AS FLOAT) AS rating,
    CASE WHEN ('0x' || substr(md5('42:' || user_id || ':' || item_id), 1, 8))::BIGINT % 100 < 80
         THEN 'train' ELSE 'test' END AS split
  FROM fact WHERE rating IS NOT NULL)
"""


def _hist(source: str, column: str, bins: int) -> str:
    return f"""
, vals AS (SELECT CAST({column} AS DOUBLE) AS x FROM {source} WHERE {column} IS NOT NULL),
b AS (SELECT min(x) AS lo, max(x) AS hi FROM vals),
grid AS (SELECT unnest(range(0, CASE WHEN hi = lo THEN 1 ELSE {bins} END)) AS bin
         FROM b WHERE lo IS NOT NULL),
counted AS (
  SELECT CAST(CASE WHEN b.hi = b.lo THEN 0
              ELSE least(floor((x - b.lo) * {bins} / (b.hi - b.lo)), {bins} - 1) END AS INTEGER)
         AS bin, count(*) AS n
  FROM vals, b GROUP BY 1)
SELECT CAST(g.bin AS INTEGER) AS bin,
       b.lo + g.bin * (CASE WHEN b.hi = b.lo THEN 0.0 ELSE (b.hi - b.lo) / {bins} END)
         AS bin_start,
       CASE WHEN b.hi = b.lo THEN b.hi
            ELSE b.lo + (g.bin + 1) * ((b.hi - b.lo) / {bins}) END AS bin_end,
       coalesce(c.n, 0) AS n
FROM grid g CROSS JOIN b LEFT JOIN counted c ON c.bin = g.bin
"""


def _r2(expr: str, digits: int = 2) -> str:
    return f"CAST(round(CAST({expr} AS DECIMAL(18,6)), {digits}) AS DOUBLE)"


def _json(cols: list[str]) -> str:
    pieces = []
    for c in cols:
        pieces.append(f"""CASE WHEN {c} IS NOT NULL THEN '"{c}":' || {c} END""")
    return "'{' || concat_ws(',', " + ", ".join(pieces) + ") || '}'"


_TYPED_ITEM_COLS = "item_id, name, tags, kind, units, is_open, score, members"

_FINAL = {
    "raw_ingest_items": "SELECT * FROM raw_items",
    "raw_ingest_ratings": "SELECT * FROM raw_ratings",
    "raw_ingest_items_stream": "SELECT * FROM raw_items",
    "csv_scan_roundtrip": "SELECT * FROM silver_items",
    "silver_publish_roundtrip": "SELECT * FROM silver_items",
    "lenient_cast": """SELECT item_id AS item_id_text, TRY_CAST(item_id AS INTEGER) AS item_id,
        units AS units_text, TRY_CAST(units AS INTEGER) AS units,
        TRY_CAST(score AS DOUBLE) AS score, TRY_CAST(members AS INTEGER) AS members
        FROM raw_items""",
    "sentinel_flag": """SELECT item_id AS item_id_text, units AS units_text,
        units = 'Unknown' AS is_open,
        CASE WHEN units = 'Unknown' THEN NULL ELSE TRY_CAST(units AS INTEGER) END AS units
        FROM raw_items""",
    "sentinel_to_null": """SELECT user_id AS user_id_text, item_id AS item_id_text,
        rating AS rating_text, nullif(TRY_CAST(rating AS INTEGER), -1) AS rating
        FROM raw_ratings""",
    "trim_blank_to_null": """SELECT item_id AS item_id_text, trim(name) AS name,
        nullif(trim(tags), '') AS tags, trim(kind) AS kind FROM raw_items""",
    "required_fields": f"SELECT {_TYPED_ITEM_COLS} FROM required_items",
    "exclude_by_pattern": f"SELECT {_TYPED_ITEM_COLS} FROM kept_items",
    "dedup_items": f"""SELECT {_TYPED_ITEM_COLS} FROM (
        SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY
          name ASC NULLS LAST, tags ASC NULLS LAST, kind ASC NULLS LAST, units ASC NULLS LAST,
          is_open ASC NULLS LAST, score ASC NULLS LAST, members ASC NULLS LAST) AS rn
        FROM required_items) WHERE rn = 1""",
    "dedup_ratings": "SELECT * FROM dedup_ratings",
    "silver_items": "SELECT * FROM silver_items",
    "silver_ratings": "SELECT * FROM silver_ratings",
    "tag_explode": "SELECT item_id, tag_name FROM item_tags",
    "gold_dim_item": "SELECT * FROM dim_item",
    "gold_dim_tag": "SELECT * FROM dim_tag",
    "gold_bridge_item_tag": "SELECT * FROM bridge",
    "gold_fact_ratings": "SELECT * FROM fact",
    "gold_dim_user": "SELECT * FROM dim_user",
    "dim_user_from_stream": "SELECT * FROM dim_user",
    "null_valid": "SELECT user_id, item_id, rating FROM valid_typed_ratings",
    "null_reject": """SELECT user_id, item_id, rating,
        'missing required column(s): user_id, item_id' AS error_reason
        FROM typed_ratings WHERE user_id IS NULL OR item_id IS NULL""",
    "duplicate_key_split": """SELECT user_id, item_id, rating,
        count(*) OVER (PARTITION BY user_id, item_id) AS key_count FROM valid_typed_ratings""",
    "duplicate_valid": """SELECT user_id, item_id, rating FROM (
        SELECT *, count(*) OVER (PARTITION BY user_id, item_id) AS c FROM valid_typed_ratings)
        WHERE c = 1""",
    "duplicate_reject": """SELECT user_id, item_id, rating,
        'duplicate key: user_id, item_id' AS error_reason FROM (
        SELECT *, count(*) OVER (PARTITION BY user_id, item_id) AS c FROM valid_typed_ratings)
        WHERE c > 1""",
    "fk_valid_ratings": """SELECT user_id, item_id, rating FROM valid_typed_ratings
        WHERE item_id IN (SELECT item_id FROM dim_item)""",
    "fk_reject_ratings": """SELECT user_id, item_id, rating,
        'item_id not found in dim_item' AS error_reason FROM valid_typed_ratings
        WHERE item_id NOT IN (SELECT item_id FROM dim_item)""",
    "validate_fact": "SELECT * FROM fact_flagged",
    "validate_bridge": """SELECT item_id, tag_id, error_reason, CAST(NULL AS VARCHAR) AS tag_name
        FROM bridge_stage2
        UNION ALL
        SELECT item_id, CAST(NULL AS INTEGER), error_reason, tag_name FROM bridge_stage1_rejects""",
    "reject_union_bridge": "SELECT * FROM bridge_rejects",
    "validate_recos": """SELECT user_id, item_id, predicted_rating, rank,
        CAST(NULL AS VARCHAR) AS error_reason FROM recommendations""",
    "reject_log": f"""SELECT 'gold_fact_ratings' AS job_name, 'fact_ratings' AS target_table,
        error_reason, {_json(['user_id', 'item_id', 'rating'])} AS payload
        FROM fact_flagged WHERE error_reason IS NOT NULL""",
    "reject_log_summary": """SELECT 'gold_fact_ratings' AS job_name, 'fact_ratings' AS target_table,
        error_reason, count(*) AS n_rejects FROM fact_flagged WHERE error_reason IS NOT NULL
        GROUP BY error_reason
        UNION ALL
        SELECT 'gold_bridge_item_tag', 'bridge_item_tag', error_reason, count(*)
        FROM bridge_rejects GROUP BY error_reason""",
    "reject_log_retry": """SELECT 'gold_fact_ratings' AS job_name,
        'fact_ratings' AS target_table, error_reason, count(*) AS n_rejects,
        CAST(1 AS BIGINT) AS runs FROM fact_flagged
        WHERE error_reason IS NOT NULL GROUP BY error_reason""",
    "constraint_audit": """
        SELECT 'dim_item' AS table_name, 'not_null' AS constraint_name,
          CAST(count(*) FILTER (WHERE item_id IS NULL OR name IS NULL) AS BIGINT) AS violations
          FROM dim_item
        UNION ALL SELECT 'dim_item', 'primary_key', CAST(coalesce(sum(c), 0) AS BIGINT)
          FROM (SELECT count(*) c FROM dim_item GROUP BY item_id HAVING count(*) > 1)
        UNION ALL SELECT 'dim_tag', 'not_null',
          count(*) FILTER (WHERE tag_id IS NULL OR tag_name IS NULL) FROM dim_tag
        UNION ALL SELECT 'dim_tag', 'primary_key', CAST(coalesce(sum(c), 0) AS BIGINT)
          FROM (SELECT count(*) c FROM dim_tag GROUP BY tag_id HAVING count(*) > 1)
        UNION ALL SELECT 'dim_tag', 'unique_name', CAST(coalesce(sum(c), 0) AS BIGINT)
          FROM (SELECT count(*) c FROM dim_tag GROUP BY tag_name HAVING count(*) > 1)
        UNION ALL SELECT 'bridge_item_tag', 'not_null',
          count(*) FILTER (WHERE item_id IS NULL OR tag_id IS NULL) FROM bridge
        UNION ALL SELECT 'bridge_item_tag', 'primary_key', CAST(coalesce(sum(c), 0) AS BIGINT)
          FROM (SELECT count(*) c FROM bridge GROUP BY item_id, tag_id HAVING count(*) > 1)
        UNION ALL SELECT 'bridge_item_tag', 'fk_item', count(*) FROM bridge
          WHERE item_id NOT IN (SELECT item_id FROM dim_item)
        UNION ALL SELECT 'bridge_item_tag', 'fk_tag', count(*) FROM bridge
          WHERE tag_id NOT IN (SELECT tag_id FROM dim_tag)
        UNION ALL SELECT 'fact_ratings', 'not_null',
          count(*) FILTER (WHERE user_id IS NULL OR item_id IS NULL) FROM fact
        UNION ALL SELECT 'fact_ratings', 'primary_key', CAST(coalesce(sum(c), 0) AS BIGINT)
          FROM (SELECT count(*) c FROM fact GROUP BY user_id, item_id HAVING count(*) > 1)
        UNION ALL SELECT 'fact_ratings', 'fk_item', count(*) FROM fact
          WHERE item_id NOT IN (SELECT item_id FROM dim_item)
        UNION ALL SELECT 'dim_user', 'not_null',
          count(*) FILTER (WHERE user_id IS NULL) FROM dim_user
        UNION ALL SELECT 'dim_user', 'primary_key', CAST(coalesce(sum(c), 0) AS BIGINT)
          FROM (SELECT count(*) c FROM dim_user GROUP BY user_id HAVING count(*) > 1)
        UNION ALL SELECT 'recommendations', 'not_null',
          count(*) FILTER (WHERE user_id IS NULL OR item_id IS NULL OR rank IS NULL)
          FROM recommendations
        UNION ALL SELECT 'recommendations', 'primary_key', CAST(coalesce(sum(c), 0) AS BIGINT)
          FROM (SELECT count(*) c FROM recommendations GROUP BY user_id, rank
                HAVING count(*) > 1)
        UNION ALL SELECT 'recommendations', 'fk_item', count(*) FROM recommendations
          WHERE item_id NOT IN (SELECT item_id FROM dim_item)""",
    "pipeline_run_counts": """
        SELECT 'gold_dim_item' AS job_name, 'dim_item' AS target_table,
               count(*) AS written, CAST(0 AS BIGINT) AS rejected FROM dim_item
        UNION ALL SELECT 'gold_dim_tag', 'dim_tag', count(*), 0 FROM dim_tag
        UNION ALL SELECT 'gold_bridge_item_tag', 'bridge_item_tag', count(*),
          (SELECT count(*) FROM item_tags) - count(*) FROM bridge
        UNION ALL SELECT 'gold_fact_ratings', 'fact_ratings', count(*), 0 FROM fact
        UNION ALL SELECT 'gold_dim_user', 'dim_user', count(*), 0 FROM dim_user
        UNION ALL SELECT 'recommend_popularity', 'recommendations', count(*), 0
          FROM recommendations""",
    "staged_replace": "SELECT * FROM dim_user",
    "racing_publishers": "SELECT * FROM dim_user",
    "staged_replace_failure_keeps_old": "SELECT * FROM dim_user",
    "cascade_replace": """SELECT 'dim_item' AS table_name, count(*) AS n_rows FROM dim_item
        UNION ALL SELECT 'bridge_item_tag', 0 UNION ALL SELECT 'fact_ratings', 0""",
    "sql_over_gold": """SELECT i.kind, count(*) AS n_ratings, count(DISTINCT f.user_id) AS n_users
        FROM fact f JOIN dim_item i ON i.item_id = f.item_id
        WHERE f.rating >= 5 AND i.members >= 1000 GROUP BY i.kind""",
    "kpi_overview": """SELECT (SELECT count(*) FROM dim_item) AS n_items,
        (SELECT count(*) FROM dim_user) AS n_users,
        (SELECT count(*) FROM fact WHERE rating IS NOT NULL) AS n_ratings,
        (SELECT count(*) FROM dim_tag) AS n_tags""",
    "score_histogram": _hist("dim_item", "score", 40),
    "kind_distribution": """SELECT kind, count(*) AS nb FROM dim_item WHERE kind IS NOT NULL
        GROUP BY kind ORDER BY nb DESC, kind""",
    "top_items_by_score": """SELECT item_id, name, kind, score, members FROM dim_item
        WHERE score IS NOT NULL AND members > 10000
        ORDER BY score DESC, members DESC, item_id LIMIT 10""",
    "kind_list": "SELECT DISTINCT kind FROM dim_item WHERE kind IS NOT NULL ORDER BY kind",
    "tag_list": "SELECT tag_name FROM dim_tag ORDER BY tag_name",
    "catalog_filter": """SELECT * FROM catalog
        WHERE kind IN ('Brand#1', 'Brand#2', 'Brand#3', 'Brand#4', 'Brand#5')""",
    "catalog_filter_tags": """SELECT c.item_id, c.name, c.kind, c.units, c.score, c.members
        FROM catalog c JOIN item_tag_map m ON m.item_id = c.item_id
        WHERE m.tag_name IN ('small', 'SMALL')
        GROUP BY c.item_id, c.name, c.kind, c.units, c.score, c.members
        HAVING count(DISTINCT m.tag_name) = 2""",
    "catalog_top20": """SELECT * FROM catalog
        ORDER BY score DESC, members DESC, item_id LIMIT 20""",
    "catalog_score_histogram": _hist("catalog", "score", 30),
    "catalog_points": "SELECT item_id, name, kind, members, score FROM catalog",
    "tag_score_ranking": f"""SELECT tag_name, {_r2('a')} AS avg_score, n_items FROM (
        SELECT m.tag_name, avg(CAST(c.score AS DOUBLE)) AS a,
               count(DISTINCT c.item_id) AS n_items
        FROM catalog c JOIN item_tag_map m ON m.item_id = c.item_id GROUP BY m.tag_name
        HAVING count(DISTINCT c.item_id) >= 5)
        ORDER BY a DESC, n_items DESC, tag_name LIMIT 20""",
    "item_tag_map": "SELECT * FROM item_tag_map",
    "user_activity_bounds": """SELECT min(user_total_reviews) AS min_reviews,
        max(user_total_reviews) AS max_reviews FROM dim_user""",
    "user_band_filter": """SELECT * FROM users
        WHERE user_average_given_rating BETWEEN 5.0 AND 6.0""",
    "user_band_counts": """SELECT CASE WHEN user_average_given_rating < 5.0 THEN 'severe'
          WHEN user_average_given_rating BETWEEN 5.0 AND 6.0 THEN 'moderate'
          WHEN user_average_given_rating > 6.0 THEN 'lenient' END AS band,
        count(*) AS n_users FROM users GROUP BY 1""",
    "user_group_summary": f"""SELECT count(*) AS n_users,
        {_r2('avg(CAST(user_average_given_rating AS DOUBLE))')} AS mean_average,
        {_r2('avg(user_total_reviews)')} AS mean_reviews FROM users""",
    "user_activity_histogram": _hist("users", "user_total_reviews", 50),
    "user_avg_histogram": _hist("users", "user_average_given_rating", 40),
    "seeded_sample": """SELECT * FROM users
        ORDER BY md5('42:' || CAST(user_id AS VARCHAR)) LIMIT 5000""",
    "activity_trend": f"""
        , ranked AS (SELECT *, row_number() OVER (ORDER BY user_total_reviews, user_id) AS r,
                            count(*) OVER () AS n FROM users),
        binned AS (SELECT *, CAST(greatest(1, CASE WHEN n > 1 THEN
                     ceil(CAST((r - 1) * least(10, n) AS DOUBLE) / (n - 1)) END) AS INTEGER) AS bin
                   FROM ranked WHERE n >= 2)
        SELECT bin,
          {_r2('median(CAST(user_total_reviews AS DOUBLE))', 4)} AS median_reviews,
          {_r2('median(CAST(user_average_given_rating AS DOUBLE))', 4)} AS median_average
        FROM binned GROUP BY bin ORDER BY median_reviews, bin""",
    "top_active_users": f"""SELECT user_id, user_total_reviews,
        {_r2('user_average_given_rating')} AS user_average_given_rating FROM users
        ORDER BY user_total_reviews DESC, user_id LIMIT 20""",
    "active_users_with_recos": f"""SELECT user_id, user_total_reviews,
        {_r2('user_average_given_rating')} AS avg_rating FROM dim_user
        WHERE user_id IN (SELECT user_id FROM recommendations)
        ORDER BY user_total_reviews DESC, user_id LIMIT 10""",
    "user_profile": """SELECT u.user_id, u.user_total_reviews, u.user_average_given_rating,
        coalesce(r.n, 0) AS n_recommendations FROM dim_user u
        LEFT JOIN (SELECT user_id, count(*) AS n FROM recommendations GROUP BY user_id) r
        ON r.user_id = u.user_id""",
    "user_reco_count": """SELECT user_id, count(*) AS n_recommendations FROM recommendations
        GROUP BY user_id""",
    "user_history_top": f"""SELECT user_id, rank, item_id, name, kind, {_r2('score')} AS score,
        user_rating FROM (
          SELECT f.user_id, f.item_id, i.name, i.kind, i.score, f.rating AS user_rating,
            CAST(row_number() OVER (PARTITION BY f.user_id ORDER BY f.rating DESC,
              i.members DESC NULLS FIRST, f.item_id) AS INTEGER) AS rank
          FROM fact f JOIN dim_item i ON i.item_id = f.item_id WHERE f.rating IS NOT NULL)
        WHERE rank <= 10""",
    "user_recommendations": f"""SELECT r.user_id, r.rank, r.item_id, i.name, i.kind, i.units,
        {_r2('i.score')} AS score, i.members, {_r2('r.predicted_rating')} AS predicted_score
        FROM recommendations r JOIN dim_item i ON i.item_id = r.item_id""",
    "user_tag_histogram": """SELECT user_id, tag_name, nb FROM (
          SELECT user_id, tag_name, nb,
            row_number() OVER (PARTITION BY user_id ORDER BY nb DESC, tag_name) AS r FROM (
              SELECT f.user_id, m.tag_name, count(*) AS nb
              FROM fact f JOIN item_tag_map m ON m.item_id = f.item_id
              GROUP BY f.user_id, m.tag_name))
        WHERE r <= 15""",
    "reco_tag_histogram": """SELECT r.user_id, m.tag_name, count(*) AS nb
        FROM recommendations r JOIN item_tag_map m ON m.item_id = r.item_id
        GROUP BY r.user_id, m.tag_name""",
    "explode_candidates": "SELECT * FROM candidates",
    "exclude_seen": "SELECT * FROM unseen",
    "topn_per_user": "SELECT * FROM recommendations",
    "popularity_recommendations": "SELECT * FROM recommendations",
    "als_training_set": """SELECT user_id, item_id, CAST(rating AS FLOAT) AS rating FROM fact
        WHERE rating IS NOT NULL""",
    "train_test_split": "SELECT * FROM train_test",
    "baseline_rmse": """SELECT count(*) AS n_test,
        CAST(round(CAST(sqrt(avg(power(rating - (SELECT avg(rating) FROM train_test
          WHERE split = 'train'), 2))) AS DECIMAL(18,9)), 6) AS DOUBLE) AS rmse
        FROM train_test WHERE split = 'test'""",
    "csv_reordered_header": "SELECT * FROM raw_ratings",
    "pipeline_from_files": "SELECT * FROM recommendations",
    "lenient_cast_decimal": """,
        texts AS (
          SELECT p_partkey, replace(['{k}', '{k}.0', '{k}.7', '-{k}.9', '.5', '.', '+{k}',
            ' {k}.2 ', '1e3', '{k}.x', '', '2147483648.5', '99999999999', '5.'
            ][p_partkey % 14 + 1], '{k}', CAST(p_partkey AS VARCHAR)) AS raw FROM part),
        whole AS (
          SELECT p_partkey, raw, CASE WHEN regexp_full_match(trim(raw),
              '[+-]?([0-9]+(\\.[0-9]*)?|\\.[0-9]*)')
            THEN regexp_extract(trim(raw), '^([+-]?)', 1) || '0'
              || regexp_extract(trim(raw), '^[+-]?([0-9]*)', 1) END AS digits FROM texts)
        SELECT p_partkey, raw, TRY_CAST(digits AS INTEGER) AS as_int,
          TRY_CAST(digits AS BIGINT) AS as_bigint FROM whole""",
    "als_model_roundtrip": """SELECT DISTINCT item_id, 30 AS rank FROM train_test
        WHERE split = 'train'""",
    "als_candidate_counts": """SELECT DISTINCT user_id, least(50,
        (SELECT count(DISTINCT item_id) FROM train_test WHERE split = 'train')) AS n_candidates
        FROM train_test WHERE split = 'train'""",
    "als_test_size": """SELECT count(*) AS n_test FROM train_test WHERE split = 'test'
        AND user_id IN (SELECT user_id FROM train_test WHERE split = 'train')
        AND item_id IN (SELECT item_id FROM train_test WHERE split = 'train')""",
    "als_candidate_rules": """SELECT rule, CAST(0 AS BIGINT) AS violations FROM (VALUES
        ('user missing'), ('length'), ('product'), ('item twice')) t(rule)""",
    "als_recommendation_rules": """SELECT rule, CAST(0 AS BIGINT) AS violations FROM (VALUES
        ('rated pair'), ('rank gap'), ('rising score'), ('not the product')) t(rule)""",
}

#: The page of one user (id 7): the all-users answers, filtered, in place.
_ONE_USER = {
    "user_profile": None, "user_reco_count": None, "user_history_top": "rank",
    "user_recommendations": "rank", "user_tag_histogram": "nb DESC, tag_name",
    "reco_tag_histogram": "nb DESC, tag_name",
}
for _page, _order in _ONE_USER.items():
    _place = f", CAST(row_number() OVER (ORDER BY {_order}) AS INTEGER) AS position" \
        if _order else ""
    _FINAL[f"{_page}_one_user"] = \
        f"SELECT *{_place} FROM ({_FINAL[_page]}) WHERE user_id = 7"


def oracle_sql() -> dict[str, str]:
    out = {}
    for name, final in _FINAL.items():
        out[name] = "WITH " + _BASE.strip() + "\n" + final.strip()
    return out
