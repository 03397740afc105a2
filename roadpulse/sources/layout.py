"""Readings stored by segment: bucketed and sorted by ``xd_id``.

A bucket's file holds all readings of its segments, so aggregates by segment
and joins of two such tables need no exchange. Months stay partitions, so a
time range still prunes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS = 64
_SORT = ("xd_id", "measurement_tstamp")


def write_bucketed(readings: DataFrame, table: str, path: str, buckets: int = BUCKETS) -> None:
    """Write readings (with ``year`` and ``month``) as the bucketed ``table``
    under ``path``, replacing it: one file a month and bucket. A segment with
    very many readings makes one large file; readers split it by row groups
    only where they don't need the buckets."""
    (readings.repartition(int(buckets), "xd_id").sortWithinPartitions("year", "month", *_SORT).write.mode("overwrite")
     .partitionBy("year", "month").bucketBy(int(buckets), "xd_id").sortBy(*_SORT)
     .option("path", path).option("compression", "snappy").saveAsTable(table))


def register_bucketed(spark: SparkSession, table: str, path: str, buckets: int = BUCKETS) -> DataFrame:
    """Make a bucketed root known to a session whose catalog doesn't have it."""
    files = spark.read.parquet(path)
    parts = ("year", "month")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in files.schema.fields if f.name not in parts)
    location = path.replace("'", "\\'")
    spark.sql(f"CREATE TABLE {table} ({columns}, year INT, month INT) USING parquet PARTITIONED BY (year, month) "
              f"CLUSTERED BY (xd_id) SORTED BY ({', '.join(_SORT)}) INTO {int(buckets)} BUCKETS LOCATION '{location}'")
    spark.catalog.recoverPartitions(table)
    return read_bucketed(spark, table)


def read_bucketed(spark: SparkSession, table: str, year: int | None = None, months: list[int] | None = None) -> DataFrame:
    df = spark.table(table)
    df = df if year is None else df.where(F.col("year") == int(year))
    return df if months is None else df.where(F.col("month").isin([int(m) for m in months]))
