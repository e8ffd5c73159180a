"""Full pipeline (B10): bronze -> silver -> gold -> recommendations.

Each layer is a function of the previous layer's *published* files, so the
state between layers is always a written table in the shared folder (lineage
is cut, a lost executor costs a task, not the pipeline). Layers run in
foreign-key order; each job logs its rejects and publishes through the
catalogue.
"""

from __future__ import annotations

import hashlib
import logging
import threading
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orrery import config
from orrery.plans import recommend, silver, star
from orrery.plans.analytics import Gold
from orrery.session import release, unique_name, work_root
from orrery.sources import files, fixtures
from orrery.sources.catalog import Catalog, run_validated_job, stage_validated_job


log = logging.getLogger("orrery")


def in_parallel(*steps):
    """Run independent steps on threads (each submits its own Spark jobs,
    which the scheduler interleaves); returns their results in order and
    re-raises the first failure."""
    if len(steps) == 1:
        return [steps[0]()]
    with ThreadPoolExecutor(max_workers=len(steps)) as pool:
        futures = [pool.submit(step) for step in steps]
        return [f.result() for f in futures]


_RAW = {"items": fixtures.RAW_ITEM_COLUMNS, "ratings": fixtures.RAW_RATING_COLUMNS}


@dataclass
class Warehouse:
    """``items_path`` and ``ratings_path`` name header CSV files or folders;
    without them the fixtures derived from ``sf_dir`` are written as such
    files first. ``header`` maps our column names to those of the files."""
    spark: SparkSession
    sf_dir: str | None
    root: str
    counts: dict = field(default_factory=dict)
    items_path: str | None = None
    ratings_path: str | None = None
    header: dict = field(default_factory=dict)

    def __post_init__(self):
        self.catalog = Catalog(self.spark, f"{self.root}/gold")

    def path(self, *parts: str) -> str:
        return "/".join([self.root, *parts])

    def stored(self, frame: DataFrame) -> DataFrame:
        """The frame written under the root and read back."""
        path = self.path("stages", unique_name("s"))
        frame.write.parquet(path)
        return self.spark.read.schema(frame.schema).parquet(path)

    # ---- layers --------------------------------------------------------
    def bronze(self) -> None:
        """Raw copy of the CSV files, all text, columns found by header name,
        plus source file and ingest time; a missing file or column fails."""
        def land(name, source, frame):
            if source is None:
                source = self.path("landing", name)
                files.write_text_csv(
                    frame(self.spark, self.sf_dir).withColumnsRenamed(self.header), source)
            names = [self.header.get(c, c) for c in _RAW[name]]
            files.raw_ingest(self.spark, source, names, self.path("bronze", name))

        in_parallel(lambda: land("items", self.items_path, fixtures.raw_items),
                    lambda: land("ratings", self.ratings_path, fixtures.raw_ratings))

    def bronze_table(self, name: str) -> DataFrame:
        raw = self.spark.read.parquet(self.path("bronze", name))
        return raw.select(*[F.col(f"`{self.header.get(c, c)}`").alias(c) for c in _RAW[name]])

    def silver(self) -> None:
        """B1 and B2 written concurrently: the ratings' catalogue semi join
        takes the item ids from the same cleaning plan over bronze (a small
        recompute of the catalogue) instead of waiting for its write."""
        items = silver.silver_items(self.bronze_table("items"))
        ratings = silver.silver_ratings(self.bronze_table("ratings"), items)
        in_parallel(
            lambda: items.write.mode("overwrite").parquet(self.path("silver", "items")),
            lambda: ratings.write.mode("overwrite").parquet(self.path("silver", "ratings")))

    def silver_table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path("silver", name))

    def gold(self) -> None:
        """B3-B7 staged one after the other (each reads its predecessors'
        staged versions), then switched in one manifest: dashboards see the
        old star schema or the new one, never a mix. Recommendations built on
        the old item dimension are emptied in the same switch."""
        cat = self.catalog
        items = self.silver_table("items")
        run_id = unique_name("gold")
        staged: dict = {}

        def job(name, target, build, columns):
            version, counts = stage_validated_job(cat, build, name, target, columns, run_id,
                                                  sort_by=star.SORT_KEYS[target],
                                                  clustered=target in star.CLUSTERED)
            staged[target] = version
            self.counts[target] = counts
            return cat.read(target, version), version.rows

        # Independent jobs run concurrently (one thread each submits its
        # Spark jobs); dependants wait for what they read.
        (dim_item, item_rows), (dim_tag, tag_rows) = in_parallel(
            lambda: job("gold_dim_item", "dim_item", star.validate_dim_item(items),
                        star.DIM_ITEM_COLUMNS),
            lambda: job("gold_dim_tag", "dim_tag", star.validate_dim_tag(items),
                        star.DIM_TAG_COLUMNS))

        def bridge():
            stage1, stage2 = star.bridge_stages(items, dim_tag, dim_item, tag_rows=tag_rows,
                                                item_rows=item_rows, store=self.stored)
            return stage2.unionByName(
                stage1.filter(F.col("error_reason").isNotNull())
                .select("item_id", "tag_name", "error_reason"), allowMissingColumns=True)

        _, (fact, _) = in_parallel(
            lambda: job("gold_bridge_item_tag", "bridge_item_tag", bridge(),
                        star.BRIDGE_COLUMNS),
            lambda: job("gold_fact_ratings", "fact_ratings",
                        star.validate_fact(self.silver_table("ratings"), dim_item, item_rows,
                                           self.stored), star.FACT_COLUMNS))
        job("gold_dim_user", "dim_user", star.validate_dim_user(fact, self.stored),
            star.DIM_USER_COLUMNS)
        cat.commit(staged, cascade=["recommendations"])

    def train(self) -> str:
        """Rated rows -> key-hash 80/20 split -> ALS on the 80 % -> RMSE
        on the 20 % -> model saved (S9). Returns the model folder."""
        fact = self.catalog.read("fact_ratings")
        train, test = recommend.train_test(recommend.training_set(fact))
        model = recommend.train_als(train)
        path = self.path("models", unique_name("als"))
        model.write().overwrite().save(path)
        metrics = recommend.rmse_frame(model.transform(test)).first()
        self.counts["als"] = {"model": path, "n_test": metrics["n_test"],
                              "rmse": metrics["rmse"]}
        return path

    def recommend(self, source: str = "popularity", model_path: str | None = None) -> None:
        """Candidates (popularity list, or the saved ALS model's top 50)
        -> exclude rated -> top 10 -> validate -> publish."""
        cat = self.catalog
        fact, dim_item = cat.read("fact_ratings"), cat.read("dim_item")
        if source == "popularity":
            recos = recommend.popularity_recommendations(cat.read("dim_user"), fact)
        else:
            from pyspark.ml.recommendation import ALSModel

            model = ALSModel.load(model_path or self.train())
            recos = recommend.recommendation_chain(recommend.als_candidates(model), fact)
        flagged = recommend.validate_recommendations(recos, dim_item, cat.rows("dim_item"),
                                                     self.stored)
        self.counts["recommendations"] = run_validated_job(
            cat, flagged, f"recommend_{source}", "recommendations", star.RECO_COLUMNS,
            sort_by=star.SORT_KEYS["recommendations"], clustered=True,
            defaults={"generated_at": F.current_timestamp()})
        self._log_short_users()

    def _log_short_users(self) -> None:
        """Users with fewer than TOP_N recommendations: a user who rated most
        of the candidates keeps few (the candidate count is a parameter)."""
        cat = self.catalog
        per_user = cat.read("recommendations").groupBy("user_id").count()
        short = cat.read("dim_user").join(
            per_user.filter(F.col("count") >= config.TOP_N), "user_id", "left_anti").count()
        log.info("%d users have fewer than %d recommendations", short, config.TOP_N)

    def run(self, source: str = "popularity") -> dict:
        self.catalog.create()
        self.bronze()
        self.silver()
        self.gold()
        self.recommend(source)
        return self.counts

    def gold_tables(self) -> Gold:
        cat = self.catalog
        _, versions = cat.state()
        return Gold(
            dim_item=cat.read("dim_item", versions["dim_item"]),
            dim_tag=cat.read("dim_tag", versions["dim_tag"]),
            bridge=cat.read("bridge_item_tag", versions["bridge_item_tag"]),
            fact=cat.read("fact_ratings", versions["fact_ratings"]),
            dim_user=cat.read("dim_user", versions["dim_user"]),
            recommendations=cat.read("recommendations", versions["recommendations"]),
            rows={k: v.rows for k, v in versions.items()},
        )


_BUILT: dict[tuple[str, str], Warehouse] = {}
_LOCK = threading.Lock()
_READY_SCHEMA = "root string"


def fingerprint(spark: SparkSession, sf_dir: str) -> str:
    """Key of a pipeline build: the input files (path, size, modification
    time, listed and summarised by Spark) and the source of this package
    (code and fixed values). A change to either gives a new key, hence a
    fresh build."""
    # One row however many files: count, bytes and an order-free XOR of
    # per-file hashes, aggregated by Spark over the listing.
    listing = (spark.read.format("binaryFile").load(f"{sf_dir}/*.parquet")
               .agg(F.count(F.lit(1)), F.sum("length"),
                    F.bit_xor(F.xxhash64("path", "length", "modificationTime")))
               .first())
    digest = hashlib.sha256(repr(tuple(listing)).encode())
    package = Path(__file__).resolve().parents[1]
    for source in sorted(package.rglob("*.py")):
        digest.update(source.read_bytes())
    return digest.hexdigest()[:20]


def _finished_build(spark: SparkSession, base: str) -> str | None:
    from orrery.sources.files import path_exists

    if not path_exists(spark, f"{base}/ready"):
        return None
    rows = spark.read.json(f"{base}/ready").orderBy("root").select("root").take(1)
    return rows[0]["root"] if rows else None


def warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """The pipeline over ``sf_dir``, built once and shared by the queries.

    Builds live under the session's shared checkpoint folder, keyed by
    ``fingerprint``; a finished build leaves a ``ready`` marker (written
    last), so later processes with the same inputs and code read its
    published tables instead of rebuilding. Concurrent builders write to
    their own folders; readers take the first finished one.
    """
    sf_dir = sf_dir.rstrip("/")
    base = work_root(spark, "warehouses", fingerprint(spark, sf_dir))
    key = (base, sf_dir)  # inputs that changed meanwhile have another key
    with _LOCK:
        wh = _BUILT.get(key)
        if wh is not None:
            wh.spark = wh.catalog.spark = spark
            return wh
        root = _finished_build(spark, base)
        if root is None:
            root = f"{base}/{unique_name('build')}"
            wh = Warehouse(spark, sf_dir, root)
            wh.run()
            (spark.createDataFrame([(root,)], _READY_SCHEMA).coalesce(1).write
             .json(f"{base}/ready/build={unique_name('r')}"))
            release(spark)  # the build's shuffles, before the queries' own
        else:
            wh = Warehouse(spark, sf_dir, root)
        _BUILT[key] = wh
    return wh


def gold(spark: SparkSession, sf_dir: str) -> Gold:
    return warehouse(spark, sf_dir).gold_tables()
