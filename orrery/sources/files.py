"""File scans and sinks: header CSV read as text, by column name."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

log = logging.getLogger("orrery")

# CSV options that keep blanks and empty fields apart: an empty field reads
# as null, a field of blanks keeps its blanks. The header of every file is
# checked against the schema (names and order): a file with another header
# fails instead of giving swapped columns.
_CSV_WRITE = {"header": "true", "ignoreLeadingWhiteSpace": "false",
              "ignoreTrailingWhiteSpace": "false", "quoteAll": "false",
              "compression": "gzip"}
CSV_READ = {"header": "true", "ignoreLeadingWhiteSpace": "false",
            "ignoreTrailingWhiteSpace": "false", "mode": "PERMISSIVE",
            "enforceSchema": "false"}
#: The whole line, where a line has more or fewer fields than the header.
MALFORMED = "malformed_line"


def string_schema(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


def csv_header(spark: SparkSession, path: str, columns: Sequence[str]) -> list[str]:
    """The header's names; fails if one of ``columns`` is missing."""
    found = spark.read.options(**CSV_READ).csv(path).columns
    missing = [c for c in columns if c not in found]
    if missing:
        raise ValueError(f"{path}: no column {', '.join(missing)} in the header {found}")
    return found


def read_text_csv(spark: SparkSession, path: str, columns: Sequence[str],
                  keep_all: bool = False) -> DataFrame:
    """Header CSV as text, columns picked by their header names, whatever
    their order. ``keep_all`` adds the file's other columns and MALFORMED."""
    found = csv_header(spark, path, columns)
    schema = string_schema(found)
    if not keep_all:
        return spark.read.options(**CSV_READ).schema(schema).csv(path).select(*columns)
    schema = schema.add(MALFORMED, T.StringType())
    extra = [c for c in found if c not in columns]
    return spark.read.options(**CSV_READ, columnNameOfCorruptRecord=MALFORMED).schema(schema) \
        .csv(path).select(*columns, *[F.col(f"`{c}`") for c in extra], MALFORMED)


def write_text_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(**_CSV_WRITE).csv(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """True when the path holds at least one file that Spark would read,
    on whatever file system the path (or the cluster's default) names."""
    try:
        return bool(spark.read.format("binaryFile").option("recursiveFileLookup", "true")
                    .load(path).select("path").take(1))
    except AnalysisException as missing:
        if missing.getCondition() == "PATH_NOT_FOUND":
            return False
        raise


def raw_ingest(spark: SparkSession, source: str, columns: Sequence[str], target: str) -> int:
    """Bronze landing: copy a text CSV into Parquet untransformed.

    Fails fast when the source or one of ``columns`` is missing. Other columns
    of the file are kept, a line with too many or too few fields as a whole in
    MALFORMED. Each row keeps its source file and the ingest time; the target
    is replaced on every run. Returns rows written.
    """
    if not path_exists(spark, source):
        raise FileNotFoundError(source)
    from pyspark.sql import Observation

    size = (spark.read.format("binaryFile").load(source)
            .agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0])  # listing only

    obs = Observation("raw_ingest")
    df = read_text_csv(spark, source, columns, keep_all=True).select(
        "*",
        F.col("_metadata.file_path").alias("source_file"),
        F.current_timestamp().alias("ingested_at"),
    )
    df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(target)
    rows = int(obs.get["rows"])
    log.info("raw ingest %s -> %s: %d bytes, %d rows", source, target, size, rows)
    return rows
