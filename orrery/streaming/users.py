"""The user dimension kept up to date from a stream of landed ratings.

Each micro-batch is cleaned and reduced to one row per (user, item), compared
with what is already known of those pairs, and leaves two increments: the
pairs whose rating is new or higher, and per user the change of three sums
(pairs, rated pairs, ratings). Sums of increments are the state, so
``dim_user`` is one partial aggregate and equals a full build.

An increment is a folder ``n=<number>`` that nobody reads until the manifest
names its number; pairs and users switch in one manifest, which also holds
the batch they came from. A batch that failed before the manifest writes its
folder again; one that comes again afterwards is known and changes nothing.
(A lost stream checkpoint does no harm either: pairs that are known already
leave no increment.)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from orrery.plans.silver import silver_ratings
from orrery.session import unique_name
from orrery.sources.catalog import Catalog, PublishError, TableVersion

PAIRS, USERS = "rating_increments", "user_increments"
PAIR_KEY = ["user_id", "item_id"]
#: Increments after which they are merged into one.
MERGE_AFTER = 64


class UserMaintenance:
    """``items`` are the clean catalogue items a rating may name; ``catalog``
    holds the increments. ``source`` names the stream (its checkpoint), which
    has one writer at a time.

    A version's path is ``folder#first-last``: the committed increments. It is
    no path that can be read as a whole, so nobody sees other increments."""

    def __init__(self, catalog: Catalog, items: DataFrame, source: str,
                 merge_after: int = MERGE_AFTER) -> None:
        self.catalog, self.items, self.source = catalog, items, source
        self.merge_after = merge_after

    # ---- state -----------------------------------------------------------
    def _state(self) -> dict[str, TableVersion]:
        return self.catalog.state(refresh=True)[1]

    @staticmethod
    def _numbers(version: TableVersion | None) -> tuple[int, int]:
        """First and last increment of a version (none: 0, -1)."""
        if version is None:
            return 0, -1
        first, last = version.path.rsplit("#", 1)[1].split("-")
        return int(first), int(last)

    def _folder(self, name: str) -> str:
        return f"{self.catalog.root}/tables/{name}"

    def _read(self, name: str, version: TableVersion) -> DataFrame:
        """The committed increments of a table: other folders are pruned."""
        first, last = self._numbers(version)
        return self.catalog.spark.read.parquet(self._folder(name)) \
            .filter(F.col("n").between(first, last)).drop("n")

    def dim_user(self) -> DataFrame:
        """Per user: list size (rated or not) and average of the given ratings."""
        version = self._state().get(USERS)
        if version is None:
            raise KeyError("no batch has been published")
        return self._read(USERS, version).groupBy("user_id").agg(
            F.sum("pairs").cast("int").alias("user_total_reviews"),
            F.when(F.sum("rated") > 0, F.sum("ratings") / F.sum("rated")).cast("float")
            .alias("user_average_given_rating"))

    # ---- batches ---------------------------------------------------------
    def apply(self, raw: DataFrame, batch_id: int) -> bool:
        """Take one batch of raw ratings (text columns) into the state; False
        if it had been taken before."""
        versions = self._state()
        known = versions.get(PAIRS)
        if known is not None:
            source, done = known.run_id.rsplit(":", 1)
            if source == self.source and batch_id <= int(done):
                return False
        first, last = self._numbers(known)
        number = last + 1
        path = f"{self.catalog.root}/batches/n={number}"  # read twice below
        silver_ratings(raw, self.items).write.mode("overwrite").parquet(path)
        batch = self.catalog.spark.read.parquet(path)
        if known is None:
            old = self.catalog.spark.createDataFrame([], "user_id int, item_id int, rating int")
        else:
            old = self._read(PAIRS, known)
        # Only the pairs of this batch are looked up: the batch's side is the
        # small one, and is broadcast when measured to be.
        seen = old.join(batch.select(*PAIR_KEY), PAIR_KEY, "left_semi") \
            .groupBy(*PAIR_KEY).agg(F.max("rating").alias("before"))
        changed = batch.join(seen.withColumn("known", F.lit(True)), PAIR_KEY, "left").filter(
            F.col("known").isNull()
            | (F.col("rating") > F.coalesce("before", F.col("rating") - 1)))
        written = self._write(PAIRS, number, changed.select(
            *PAIR_KEY, "rating", "before", F.col("known").isNotNull().alias("known")))
        pairs = self.catalog.spark.read.parquet(f"{self._folder(PAIRS)}/n={number}")
        users = self._write(USERS, number, pairs.groupBy("user_id").agg(
            F.count(F.when(~F.col("known"), 1)).alias("pairs"),
            F.count(F.when(F.col("rating").isNotNull() & F.col("before").isNull(), 1))
            .alias("rated"),
            F.sum(F.coalesce("rating", F.lit(0)).cast("bigint")
                  - F.coalesce("before", F.lit(0))).alias("ratings")))
        self._commit(versions, first, number, {PAIRS: written, USERS: users},
                     f"{self.source}:{batch_id}")
        if number - first + 1 >= self.merge_after:
            self.merge()
        return True

    def _write(self, name: str, number: int, frame: DataFrame) -> int:
        """Write one increment, in place of what a failed attempt left."""
        path = f"{self._folder(name)}/n={number}"
        rows = Observation(unique_name(name))
        frame.sortWithinPartitions("user_id").observe(rows, F.count(F.lit(1)).alias("rows")) \
            .write.mode("overwrite").parquet(path)
        written = self.catalog.spark.read.parquet(path).count()  # footers only
        if written != int(rows.get["rows"]):
            raise PublishError(f"{path}: wrote {written} rows, expected {rows.get['rows']}")
        return written

    def _commit(self, versions: dict[str, TableVersion], first: int, last: int,
                rows: dict[str, int], run_id: str) -> None:
        """Switch both tables in one manifest, unless another writer of this
        stream was faster."""
        now = self._state()
        if any(now.get(name) != versions.get(name) for name in rows):
            raise PublishError("another writer maintains these increments")
        staged = {}
        for name, count in rows.items():
            old = versions.get(name)
            if old is not None and self._numbers(old)[0] == first:
                count += old.rows
            schema = self.catalog.spark.read.parquet(f"{self._folder(name)}/n={last}").schema
            staged[name] = TableVersion(name, f"{self._folder(name)}#{first}-{last}", count,
                                        schema.json(), run_id)
        self.catalog.commit(staged)

    def merge(self) -> None:
        """One increment out of all: the highest rating per pair, the sums per
        user. Earlier folders stay for readers of earlier manifests."""
        versions = self._state()
        _, last = self._numbers(versions[PAIRS])
        pairs = self._read(PAIRS, versions[PAIRS]).groupBy(*PAIR_KEY).agg(
            F.max("rating").alias("rating"), F.lit(None).cast("int").alias("before"),
            F.lit(False).alias("known"))
        users = self._read(USERS, versions[USERS]).groupBy("user_id").agg(
            *[F.sum(c).alias(c) for c in ("pairs", "rated", "ratings")])
        self._commit(versions, last + 1, last + 1,
                     {PAIRS: self._write(PAIRS, last + 1, pairs),
                      USERS: self._write(USERS, last + 1, users)}, versions[PAIRS].run_id)


def maintain_users(bronze: str, upkeep: UserMaintenance, checkpoint: str,
                   max_files_per_trigger: int | None = None) -> int:
    """Bring the user dimension up to date with the files that arrived in
    ``bronze`` (as landed by ``land_new_files``) since the last run; returns
    the number of batches taken."""
    spark = upkeep.catalog.spark
    taken = []
    reader = spark.readStream.schema(spark.read.parquet(bronze).schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    query = (reader.parquet(bronze).writeStream
             .foreachBatch(lambda rows, batch: taken.append(upkeep.apply(rows, batch)))
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()
    return sum(taken)
