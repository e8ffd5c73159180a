"""JDBC table scan and append (S5, S6) through Spark's JDBC source.

Not exercised against a database in this repository (none may be started
here); the Parquet catalogue is the tested publication path. The scan is
range-partitioned on a numeric column instead of one partition holding the
whole table; the append bounds the number of concurrent connections.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def partition_options(lower: int, upper: int, num_partitions: int) -> dict[str, str]:
    """Options splitting [lower, upper] of a numeric column into at most
    ``num_partitions`` range reads (never more ranges than values)."""
    parts = max(1, min(num_partitions, upper - lower + 1))
    return {"lowerBound": str(lower), "upperBound": str(upper), "numPartitions": str(parts)}


def read_table(spark: SparkSession, url: str, table: str, properties: dict,
               column: str | None = None, num_partitions: int = 64,
               bounds: tuple[int, int] | None = None) -> DataFrame:
    """Scan a table; with ``column`` the rows are read in parallel ranges of
    that numeric column (bounds from one MIN/MAX query unless given)."""
    reader = spark.read.format("jdbc").option("url", url).options(**properties)
    if column is None:
        return reader.option("dbtable", table).load()
    if bounds is None:
        row = (spark.read.format("jdbc").option("url", url).options(**properties)
               .option("query", f"SELECT MIN({column}) AS lo, MAX({column}) AS hi FROM {table}")
               .load().first())
        if row is None or row["lo"] is None:
            return reader.option("dbtable", table).load()
        bounds = (int(row["lo"]), int(row["hi"]))
    return (reader.option("dbtable", table).option("partitionColumn", column)
            .options(**partition_options(bounds[0], bounds[1], num_partitions)).load())


def append_table(df: DataFrame, url: str, table: str, properties: dict,
                 max_connections: int = 16, batch_size: int = 10_000) -> None:
    """Append rows; at most ``max_connections`` tasks write at once."""
    (df.write.format("jdbc").mode("append").option("url", url).option("dbtable", table)
     .option("numPartitions", str(max_connections)).option("batchsize", str(batch_size))
     .options(**properties).save())
