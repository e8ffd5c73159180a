"""Versioned Parquet tables with all-or-nothing publication.

Every publication writes each new table version into its own, still
unreferenced folder ``tables/<name>/v=<run>``, checks the written row count
against the count observed while writing, and only then creates the next
numbered manifest ``_manifests/seq=<n>`` that maps every table to its
current version. Readers resolve tables through the highest manifest, so
several tables -- including dependants emptied by a cascade -- switch
together, and a failure before the manifest leaves the previous state
readable and unchanged. Nothing is renamed, which also suits object stores.

Rejected rows go to an append-only ``reject_records`` table with a run id.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from urllib.parse import quote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orrery.session import unique_name
from orrery.sources.commitlog import delete, put_if_absent

KEEP_MANIFESTS = 100

MANIFEST_SCHEMA = T.StructType([
    T.StructField("table", T.StringType()),
    T.StructField("path", T.StringType()),
    T.StructField("rows", T.LongType()),
    T.StructField("schema", T.StringType()),
    T.StructField("run_id", T.StringType()),
    T.StructField("job", T.StringType()),
])


REJECT_SCHEMA = T.StructType([
    T.StructField("reject_id", T.StringType()),
    T.StructField("run_id", T.StringType()),
    T.StructField("job_name", T.StringType()),
    T.StructField("target_table", T.StringType()),
    T.StructField("error_reason", T.StringType()),
    T.StructField("payload", T.StringType()),
    T.StructField("rejected_at", T.TimestampType()),
])


class PublishError(RuntimeError):
    pass


@dataclass(frozen=True)
class TableVersion:
    table: str
    path: str
    rows: int
    schema: str
    run_id: str
    job: str | None = None  # the validated job that produced the version


class Catalog:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._known: tuple[int, dict[str, TableVersion]] | None = None

    def create(self) -> "Catalog":
        """Start an empty catalogue (manifest 0 lists no table)."""
        if not self._put(0, {}):
            raise PublishError(f"a catalogue already exists under {self.root}")
        self._known = (0, {})
        return self

    # ---- reading -------------------------------------------------------
    def _newest(self) -> tuple[int, str] | None:
        """(number, file) of the newest manifest, from the folder's listing
        alone."""
        files = self.spark.read.format("binaryFile").load(f"{self.root}/_manifests")
        row = files.select("seq", "path").orderBy(F.desc("seq"), "path").first()
        return None if row is None else (row["seq"], row["path"])

    def state(self, refresh: bool = False) -> tuple[int, dict[str, TableVersion]]:
        """(sequence number, table -> version) of the newest manifest.

        Remembered after the first read and after each own publication;
        ``refresh`` re-reads (another writer may have published)."""
        if self._known is not None and not refresh:
            return self._known
        newest = self._newest()
        rows = []
        if newest is not None:  # one row per table: bounded metadata
            rows = self.spark.read.schema(MANIFEST_SCHEMA).json(newest[1]).collect()
        if not rows:  # only the empty manifest 0 exists
            self._known = (0, {})
            return self._known
        self._known = (newest[0], {r["table"]: TableVersion(
            r["table"], r["path"], r["rows"], r["schema"], r["run_id"], r["job"])
            for r in rows})
        return self._known

    def version(self, name: str) -> TableVersion:
        _, tables = self.state()
        if name not in tables:
            raise KeyError(f"table {name!r} is not published under {self.root}")
        return tables[name]

    def read(self, name: str, version: TableVersion | None = None) -> DataFrame:
        v = version or self.version(name)
        schema = T.StructType.fromJson(json.loads(v.schema))
        return self.spark.read.schema(schema).parquet(v.path)

    def rows(self, name: str) -> int:
        return self.version(name).rows

    # ---- writing -------------------------------------------------------
    def _stage(self, name: str, df: DataFrame, run_id: str) -> TableVersion:
        path = f"{self.root}/tables/{name}/v={unique_name(run_id)}"
        obs = Observation(unique_name(f"stage_{name}"))
        df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("errorifexists").parquet(path)
        rows = int(obs.get["rows"])
        written = self.spark.read.parquet(path).count()  # footer metadata only
        if written != rows:
            raise PublishError(f"{name}: wrote {written} rows, expected {rows}")
        return TableVersion(name, path, rows, df.schema.json(), run_id)

    def stage(self, tables: Mapping[str, DataFrame], run_id: str | None = None
              ) -> dict[str, TableVersion]:
        """Write new, still unreferenced versions; readable through
        ``read(name, version)`` before (and without) a commit."""
        run_id = run_id or unique_name("run")
        return {name: self._stage(name, df, run_id) for name, df in tables.items()}

    def commit(self, staged: Mapping[str, TableVersion], cascade: Sequence[str] = (),
               fail_before_swap: bool = False) -> dict[str, int]:
        """Switch all ``staged`` versions -- plus empty versions of the
        ``cascade`` dependants -- in one new manifest. Returns row counts."""
        seq, current = self.state(refresh=True)
        staged, emptied = dict(staged), {}
        run_id = next(iter(staged.values())).run_id if staged else unique_name("run")
        own = set(staged) | set(cascade)
        while True:
            for name in cascade:
                if name not in staged and name in current and name not in emptied:
                    schema = T.StructType.fromJson(json.loads(current[name].schema))
                    emptied[name] = self._stage(
                        name, self.spark.createDataFrame([], schema), run_id)
            if fail_before_swap:
                raise PublishError("publication aborted before the manifest switch")
            switched = {**staged, **emptied}
            # Creating the manifest is the commit point.
            if self._put(seq + 1, {**current, **switched}):
                newest = self._newest()
                # A number that was free because it had been deleted is far
                # behind: nobody reads it.
                if newest is not None and newest[0] - seq - 1 < KEEP_MANIFESTS:
                    self._known = (seq + 1, {**current, **switched})
                    if (seq + 1) % KEEP_MANIFESTS == 0:
                        self.compact()
                    return {name: v.rows for name, v in switched.items()}
            latest, now = self.state(refresh=True)
            changed = {n for n in {*now, *current} if now.get(n) != current.get(n)}
            if latest <= seq or changed & own:
                raise PublishError(f"manifest {seq + 1} already exists: another writer "
                                   f"published {sorted(changed & own) or 'it'}")
            seq, current = latest, now

    def _put(self, seq: int, tables: Mapping[str, TableVersion]) -> bool:
        lines = [json.dumps({f.name: getattr(v, f.name) for f in MANIFEST_SCHEMA})
                 for v in tables.values()]
        return put_if_absent(self.spark, f"{self.root}/_manifests/seq={seq:012d}/manifest.json",
                             "\n".join(lines) + "\n")  # never an empty file: those are not listed

    def compact(self, keep: int = KEEP_MANIFESTS) -> int:
        """Delete all but the last ``keep`` manifests; returns how many.
        Readers and writers only look at the newest."""
        newest = self._newest()
        if newest is None:
            return 0
        old = self.spark.read.format("binaryFile").load(f"{self.root}/_manifests") \
            .filter(F.col("seq") <= newest[0] - max(keep, 1)).select("seq").distinct().collect()
        for row in old:  # at most what was published since the last time
            delete(self.spark, f"{self.root}/_manifests/seq={row['seq']:012d}")
        return len(old)

    def publish(self, tables: Mapping[str, DataFrame], cascade: Sequence[str] = (),
                fail_before_swap: bool = False) -> dict[str, int]:
        """Stage all ``tables``, then switch them (and the emptied cascade
        dependants) together."""
        return self.commit(self.stage(tables), cascade, fail_before_swap)

    # ---- reject log ----------------------------------------------------
    def append_rejects(self, records: DataFrame, run_id: str | None = None,
                       job: str | None = None) -> int:
        """Append reject-log rows; returns how many (0 writes nothing).

        With ``run_id`` and ``job`` (a scheduler's names) the rows replace
        what the same job logged in the same run before, so a job that failed
        after logging and runs again leaves each reject once. Without, every
        call appends."""
        again = run_id is not None and job is not None
        batch = f"{run_id}.{job}" if again else unique_name("b")
        path = f"{self.root}/reject_records/batch={quote(batch, safe='')}"
        if not again and records.isEmpty():
            return 0
        obs = Observation(unique_name("rejects"))
        out = records.select(
            F.expr("uuid()").alias("reject_id"),
            F.lit(run_id or unique_name("run")).alias("run_id"),
            "job_name", "target_table", "error_reason", "payload",
            F.current_timestamp().alias("rejected_at"),
        )
        # Each batch is its own folder: concurrent jobs never share a commit
        # area, and a batch is visible only once its job committed.
        out.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode(
            "overwrite" if again else "errorifexists").parquet(path)
        return int(obs.get["rows"])

    def rejects(self) -> DataFrame:
        """The reject log (empty, with its schema, before the first reject)."""
        from orrery.sources.files import path_exists

        path = f"{self.root}/reject_records"
        if not path_exists(self.spark, path):
            return self.spark.createDataFrame([], REJECT_SCHEMA)
        return self.spark.read.schema(REJECT_SCHEMA).parquet(path)


def stage_validated_job(catalog: Catalog, flagged: DataFrame, job_name: str, target: str,
                        columns: Sequence[str], run_id: str | None = None,
                        sort_by: Sequence[str] = (), clustered: bool = False,
                        defaults: Mapping[str, Column] | None = None) -> tuple[TableVersion, dict[str, int]]:
    """Stage the valid rows of a flagged frame and log its rejects.

    One pass: the flagged frame is written once, partitioned by
    ``dq_status``. The ``dq_status=valid`` folder is the new table version
    (read with the table schema, so the all-null reason/payload columns are
    pruned away); the rejected rows, with their JSON payload already built,
    are appended to the reject log right away -- they stay logged even if
    the later switch fails, as in the original job. ``sort_by`` sorts rows
    inside each written file (a local sort, no shuffle) so that Parquet
    min/max statistics let point lookups on those columns skip row groups;
    ``clustered`` also deals the rows out by ranges of those columns, so that
    a lookup skips whole files and a user's rows stand together.
    ``defaults`` are columns that the table fills itself (a write time); a
    reject's payload does not hold them.
    """
    from orrery.functions.columns import payload_json
    from orrery.operators.quality import REASON

    run_id = run_id or unique_name("run")
    path = f"{catalog.root}/tables/{target}/v={unique_name(run_id)}"
    payload = [c for c in flagged.columns if c != REASON]
    bad = F.col(REASON).isNotNull()
    filled = [value.alias(name) for name, value in (defaults or {}).items()]
    if clustered:  # before a text is added to each row
        flagged = flagged.repartitionByRange(*sort_by)
    out = flagged.select(
        *columns, *filled, REASON,
        F.when(bad, payload_json(payload)).alias("payload"),
        F.when(bad, F.lit("rejected")).otherwise(F.lit("valid")).alias("dq_status"))
    if sort_by:
        out = out.sortWithinPartitions(*sort_by)
    obs = Observation(unique_name(f"stage_{target}"))
    (out.observe(obs, F.count(F.when(F.col("dq_status") == "valid", 1)).alias("valid"),
                 F.count(F.when(F.col("dq_status") != "valid", 1)).alias("rejected"))
     .write.mode("errorifexists").partitionBy("dq_status").parquet(path))
    valid, rejected = int(obs.get["valid"]), int(obs.get["rejected"])
    schema = flagged.select(*columns, *filled).schema
    table_path = f"{path}/dq_status=valid"
    if valid == 0:
        catalog.spark.createDataFrame([], schema).write.mode("errorifexists").parquet(table_path)
    written = catalog.spark.read.schema(schema).parquet(table_path).count()
    if written != valid:
        raise PublishError(f"{target}: wrote {written} rows, expected {valid}")
    if rejected:
        records = catalog.spark.read.parquet(f"{path}/dq_status=rejected").select(
            F.lit(job_name).alias("job_name"), F.lit(target).alias("target_table"),
            REASON, "payload")
        catalog.append_rejects(records, run_id, job_name)
    version = TableVersion(target, table_path, valid, schema.json(), run_id, job_name)
    return version, {"written": valid, "rejected": rejected}


def run_validated_job(catalog: Catalog, flagged: DataFrame, job_name: str, target: str,
                      columns: Sequence[str], cascade: Sequence[str] = (),
                      sort_by: Sequence[str] = (), clustered: bool = False,
                      defaults: Mapping[str, Column] | None = None, run_id: str | None = None,
                      fail_before_swap: bool = False) -> dict[str, int]:
    """Stage, log rejects and switch one table (with its cascade). The same
    ``run_id`` makes it a retry: its rejects are logged once."""
    version, counts = stage_validated_job(catalog, flagged, job_name, target, columns, run_id,
                                          sort_by=sort_by, clustered=clustered,
                                          defaults=defaults)
    catalog.commit({target: version}, cascade, fail_before_swap)
    return counts
