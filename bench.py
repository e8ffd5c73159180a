"""Benchmark: full pipeline plus headline queries at $BENCH_SF_DIR.

Prints one JSON line. Each query is executed completely with a ``noop``
write (no collect); the pipeline time covers bronze -> silver -> gold ->
recommendations with all validation, reject logging and publication.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "silver_items", "silver_ratings", "validate_fact", "validate_bridge",
    "gold_dim_tag", "popularity_recommendations", "kpi_overview", "score_histogram",
    "top_items_by_score", "catalog_filter_tags", "tag_score_ranking", "user_band_counts",
    "activity_trend", "seeded_sample", "user_history_top", "user_recommendations",
    "user_tag_histogram", "reco_tag_histogram", "constraint_audit", "baseline_rmse",
    "als_evaluation", "als_recommendations",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from orrery.plans import warehouse as W
    from orrery.registry import QUERIES
    from orrery.session import build_session, unique_name, work_root

    spark = build_session(f"local[{cpus}]", int(cpus), extra={"spark.driver.memory": "16g"})
    times: dict[str, float] = {}

    wh = W.Warehouse(spark, sf_dir, work_root(spark, unique_name("bench")))
    layers = {}
    for layer in ("bronze", "silver", "gold", "recommend"):
        t = time.time()
        if layer == "bronze":
            wh.catalog.create()
        getattr(wh, layer)()
        layers[f"pipeline_{layer}"] = round(time.time() - t, 3)
    times["pipeline"] = round(sum(layers.values()), 3)
    base = work_root(spark, "warehouses", W.fingerprint(spark, sf_dir))
    W._BUILT[(base, sf_dir)] = wh  # queries reuse this run

    for name in HEADLINE:
        t = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t, 3)

    sf_name = os.path.basename(sf_dir).replace("sf", "")
    total = round(sum(times.values()), 3)
    times.update(layers)  # breakdown of "pipeline", not added to the total
    try:
        sf: float | str = float(sf_name)
    except ValueError:
        sf = sf_name
    print(json.dumps({"metric": "total_time", "value": total,
                      "unit": "sec", "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
